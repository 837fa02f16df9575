"""Text rules: configuration files, labels, logs, durations, number formats."""

from __future__ import annotations

import json
import math
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from lacuna.functions.numeric import isclose

TRUE, FALSE = ("true", "1", "yes", "on"), ("false", "0", "no", "off")


def strip_comments(text: str) -> str:
    """JSON text without // and # comments to the line's end and /* */ comments; marks within strings stay."""
    out, i, quoted = [], 0, False
    while i < len(text):
        if quoted:
            step = 2 if text[i] == "\\" else 1
            quoted = text[i] != '"'
            out.append(text[i : i + step])
            i += step
        elif text.startswith("/*", i):
            end = text.find("*/", i + 2)
            i = len(text) if end < 0 else end + 2
        elif text[i] == "#" or text.startswith("//", i):
            end = text.find("\n", i)
            i = len(text) if end < 0 else end
        else:
            quoted = text[i] == '"'
            out.append(text[i])
            i += 1
    return "".join(out)


def load_config(text: str, removed: tuple[str, ...] = ()) -> dict[str, Any]:
    """A commented JSON object; a key named in `removed` is an error."""
    config = json.loads(strip_comments(text))
    if not isinstance(config, dict):
        raise ValueError("a configuration must be an object")
    if gone := sorted(set(removed) & set(config)):
        raise ValueError(f"keys no longer supported: {', '.join(gone)}")
    return config


def to_bool(value: Any) -> bool:
    if isinstance(value, bool):
        return value
    word = str(value).strip().lower()
    if word in TRUE or word in FALSE:
        return word in TRUE
    raise ValueError(f"not a boolean: {value!r}")


def coerce(value: str) -> Any:
    """Text of a stored default to None, bool, int, float or text."""
    word = value.strip()
    if word.lower() in ("", "none", "null"):
        return None
    if word.lower() in ("true", "false", "yes", "no", "on", "off"):
        return to_bool(word)
    for kind in (int, float):
        try:
            return kind(word)
        except ValueError:
            continue
    return word


def trigger(value: Any, base: int, default: int = 10) -> int:
    """A positive count, or "p%" of base rounded up and at least 1; the default where nothing is given."""
    if value is None or value == "":
        return default
    word = str(value).strip()
    if word.endswith("%"):
        share = float(word[:-1])
        if not share > 0:
            raise ValueError("a share must be above 0")
        return max(1, math.ceil(base * share / 100))
    if isinstance(value, bool) or float(word) != int(float(word)) or int(float(word)) <= 0:
        raise ValueError("a trigger must be a positive whole number or a share")
    return int(float(word))


def repeats(value: str) -> tuple[int, int, int]:
    """"2", "2x2x1" or "2 2 1" to three positive counts."""
    parts = [int(x) for x in value.lower().replace("x", " ").replace(",", " ").split()]
    parts = parts * 3 if len(parts) == 1 else parts
    if len(parts) != 3 or min(parts) < 1:
        raise ValueError(f"not three positive counts: {value!r}")
    return parts[0], parts[1], parts[2]


def label_path(text: Column) -> Column:
    """`label=path` to both; without a sign of equality the label is the path's last part without its ending. An empty label
    before the sign is an error."""
    at = F.instr(text, "=")
    label, path = F.trim(F.substring(text, F.lit(1), at - 1)), F.trim(F.substring(text, at + 1, F.length(text)))
    named = F.when(label == "", F.raise_error(F.concat(F.lit("empty label: "), text)).cast("string")).otherwise(label)
    last = F.regexp_replace(F.regexp_replace(text, r"/+$", ""), r"^.*/", "")
    return F.struct(F.when(at > 0, named).otherwise(F.regexp_replace(last, r"(?<=.)\.[^.]*$", "")).alias("label"), F.when(at > 0, path).otherwise(text).alias("path"))


def label_values(items: list[str]) -> list[tuple[str, str]]:
    """Texts of `label=value`, several with commas between; a part without a label, a value or any is an error."""
    parts = [p.strip() for x in items for p in x.split(",") if p.strip()]
    pairs = [(a.strip(), z.strip()) for a, sign, z in (p.partition("=") for p in parts) if sign]
    if not parts or len(pairs) < len(parts) or any(not a or not z for a, z in pairs):
        raise ValueError(f"label=value is needed: {items}")
    return pairs


def safe_name(label: Column) -> Column:
    """Runs outside letters, digits, dot, dash and underscore become one underscore; `dataset` where nothing is left."""
    named = F.regexp_replace(F.regexp_replace(label, r"^\s+|\s+$", ""), r"[^A-Za-z0-9._-]+", "_")
    return F.when(named == "", F.lit("dataset")).otherwise(named)


def loop_label(main: Column) -> Column:
    """-1 is `init`, v is `loop-(v+1)`."""
    return F.when(main == -1, F.lit("init")).otherwise(F.concat(F.lit("loop-"), (main + 1).cast("string")))


def element_case(symbol: Column) -> Column:
    return F.initcap(F.lower(F.trim(symbol)))


def info_value(info: Column, key: str) -> Column:
    """Lookup in a map of texts: the key itself, else the first that differs in case alone."""
    return F.coalesce(F.try_element_at(info, F.lit(key)), F.get(F.map_values(F.map_filter(info, lambda k, v: F.lower(k) == key.lower())), F.lit(0)))


def info_matches(info: Column, key: str, wanted: Column) -> Column:
    """Equal as close numbers where both are numbers, else as trimmed text."""
    found = info_value(info, key)
    a, b = found.try_cast("double"), wanted.cast("string").try_cast("double")
    return F.coalesce(F.when(a.isNotNull() & b.isNotNull(), isclose(a, b)).otherwise(F.trim(found) == F.trim(wanted.cast("string"))), F.lit(False))


def wall_seconds(text: Column) -> Column:
    """[D-]HH:MM:SS to seconds."""
    part = lambda i: F.regexp_extract(text, r"(?:(\d+)-)?(\d+):(\d+):(\d+(?:\.\d+)?)", i)
    number = lambda i: F.coalesce(part(i).try_cast("double"), F.lit(0.0))
    return F.when(text.rlike(r"\d+:\d+:\d+"), number(1) * 86400 + number(2) * 3600 + number(3) * 60 + number(4))


def runtimes(log: Column) -> Column:
    """All seconds after `total_runtime`, with a plain, a full-width or no colon; what is no number is passed over."""
    found = F.regexp_extract_all(log, F.lit(r"total_runtime[:：]?\s*([0-9.+\-eE]+)\s*s"), F.lit(1))
    return F.array_compact(F.transform(found, lambda x: x.try_cast("double")))


def wall_times(log: Column) -> Column:
    return F.transform(F.regexp_extract_all(log, F.lit(r"Total wall time:\s*((?:\d+-)?\d+:\d+:\d+(?:\.\d+)?)"), F.lit(1)), wall_seconds)


def cores(script: Column) -> Column:
    """Cores asked for by a whole line of a job script, the one scheduler's before the other's; null if it asks for none."""
    line = lambda name: F.nullif(F.regexp_extract(script, rf"(?m)^#{name} -n (\d+)$", 1), F.lit("")).cast("int")
    return F.coalesce(line("BSUB"), line("SBATCH"))


#: The forms in which a training log tells its mean absolute errors.
TRAINING_FORMS = {"energy": r"Energy MAE \(meV/atom\):\s*", "force": r"Force MAE\s+\(meV/A\)\s*:\s*", "stress": r"Stress MAE\s+\(eV\)\s*:\s*"}


def training_errors(log: Column) -> Column:
    """First mean absolute errors of energy, force and stress in a training log; null where a log has none."""
    first = lambda form: F.nullif(F.regexp_extract(log, form + r"([0-9.+\-eE]+)", 1), F.lit("")).try_cast("double")
    return F.struct(*[first(form).alias(name) for name, form in TRAINING_FORMS.items()])


def last_error(log: Column, lines: int = 50) -> Column:
    """The last ERROR line of the last lines of a log; `Lost atoms` wins over others; null if there is none."""
    rows = F.split(log, "\n")
    tail = F.slice(rows, F.greatest(F.lit(1), F.size(rows) - lines + 1), lines)
    errors = F.filter(tail, lambda x: x.contains("ERROR"))
    lost = F.filter(errors, lambda x: x.contains("Lost atoms"))
    return F.try_element_at(F.when(F.size(lost) > 0, lost).otherwise(errors), F.lit(-1))


def potential_species(header: Column) -> Column:
    return F.nullif(F.regexp_extract(header, r"species_count\s*=\s*(\d+)", 1), F.lit("")).cast("int")


def potential_moments(header: Column) -> Column:
    inner = F.regexp_extract(header, r"alpha_moment_mapping\s*=\s*\{([^}]*)\}", 1)
    return F.transform(F.filter(F.split(inner, r"\s*,\s*"), lambda x: F.trim(x) != ""), lambda x: F.trim(x).cast("int"))


def fixed8(x: Column) -> Column:
    """A number with 8 decimals and a blank for a plus."""
    return F.format_string("% .8f", x)


def glob_to_regex(pattern: str) -> str:
    """A shell pattern (*, ?, [set], [!set]) as a regular expression over the whole text."""
    out, i = [], 0
    while i < len(pattern):
        c, end = pattern[i], pattern.find("]", i + 2)
        if c == "[" and end > 0:
            inner = pattern[i + 1 : end].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&").replace("^", "\\^")
            out.append("[^" + inner[1:] + "]" if inner[0] == "!" else "[" + inner + "]")
            i = end
        else:
            out.append({"*": ".*", "?": "."}.get(c, "\\" + c if c in ".^$+{}[]()|\\" else c))
        i += 1
    return "^(?s:" + "".join(out) + ")$"
