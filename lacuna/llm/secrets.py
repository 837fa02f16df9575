"""Secret scans with corpus-wide ownership frequency, in DataFrame functions alone.

Base candidates are assignments, access keys and long hexadecimal runs (BASE), leftmost non-overlapping for each kind.
Others (OWNED) are long tokens of mixed letters and digits, which often are credentials and as often identifiers from
examples that are copied around. The hash of every candidate's value is counted over the whole corpus by distinct
repositories (the source) and owners (the source up to its first slash): a value of few owners is live-looking, one of
many is a copied example. Other candidates are reported only if they are live-looking and overlap no base span; base
candidates are always reported, with that verdict beside them.

Each text is searched once; narrow candidate rows are checkpointed. Counting aggregates (value, repository, owner) before
the shuffle, so a value that a third of all rows hold is a few rows.

Defined results: null and empty texts have no spans; null sources are one repository of its own; repeated rows get equal
rows; an empty table gives no rows; `redact` keeps all other columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import cut

#: Kind, pattern, group that holds the value, least length of that group.
BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
OWNED = ("owned", r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])(?=[0-9_-]*[A-Za-z])[A-Za-z0-9_-]{20,}(?![A-Za-z0-9_-])", 0, 20)
KINDS = (*(k for k, *_ in BASE), OWNED[0])
#: Values of more owners or repositories than this are copied examples.
MOST_OWNERS = 2
SPAN = "struct<start:int,kind:int,stop:int,value:bigint>"
MARK = "__lacuna_"
#: Numbers that are summed in one go.
BLOCK = 256
#: Code points of a text that are walked through for one piece of it.
STRETCH = 4096


def spans(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Spans of all matches whose group is long enough. split() gives the stretches between the matches, so each match
    begins after the lengths of all stretches and matches before it, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    rows = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap"), found.alias("whole"), value.alias("value"))
    rows = F.transform(rows, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["whole"]).alias("whole"), x["value"].alias("value")))

    def span(x: Column, at: Column) -> Column:
        start = at + x["gap"]
        row = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x["whole"]).alias("stop"), F.xxhash64(x["value"]).alias("value"))
        keep = F.length(x["value"]) >= least
        if kind == len(BASE):
            keep &= x["value"].rlike("[A-Z]") & x["value"].rlike("[a-z]") & (F.size(F.array_distinct(F.split(x["value"], ""))) >= 12) & (F.regexp_count(x["value"], F.lit("[0-9]")) >= 3)
        return F.when(keep, row)

    every = let(rows, lambda x: F.zip_with(x, running(F.transform(x, lambda y: y["gap"] + y["whole"]), lambda a, b: a + b), span))
    return F.when(text.rlike(pattern), F.array_compact(every)).otherwise(F.array().cast(f"array<{SPAN}>"))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value computed once: within lambdas, an expression would be computed for each element."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def running(numbers: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each of an array of ints what those before it combine to, from 0. In blocks, so that arrays grow by concatenation
    only within a block or over the blocks: linear in practice, however many numbers there are."""
    zero, none = F.lit(0), F.array().cast("array<int>")

    def scan(x: Column, first: Column) -> Column:
        start = F.struct(first.alias("now"), none.alias("out"))
        step = lambda acc, y: F.struct(combine(acc["now"], y).alias("now"), F.concat(acc["out"], F.array(acc["now"])).alias("out"))
        return F.aggregate(x, start, step, lambda acc: acc["out"])

    def joined(x: Column) -> Column:
        places = F.when(F.size(x) > 0, F.sequence(F.lit(1), F.size(x), F.lit(BLOCK))).otherwise(none)
        return F.transform(places, lambda i: F.slice(x, i, BLOCK))

    total = lambda x: F.aggregate(x, zero, combine)
    return F.flatten(let(let(numbers, joined), lambda blocks: F.zip_with(blocks, scan(F.transform(blocks, total), zero), scan)))


def stretches(text: Column) -> Column:
    """A text in stretches of STRETCH code points; substring() counts from the text's beginning each time."""
    places = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(STRETCH))
    return F.transform(places, lambda i: F.substring(text, i + 1, F.lit(STRETCH)))


def between(parts: Column, start: Column, stop: Column) -> Column:
    """Code points [start, stop) of a text in stretches."""
    first = F.floor(start / STRETCH).cast("int")
    some = F.slice(parts, first + 1, F.floor(stop / STRETCH).cast("int") - first + 1)
    return F.substring(F.array_join(some, ""), start - first * STRETCH + 1, stop - start)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, source, base and other spans of docs(doc_id, text, source)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), text.alias("text"))
    base = F.array_sort(F.concat(*[spans(F.col("text"), i, *b[1:]) for i, b in enumerate(BASE)]))
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "source", base.alias("base"), spans(F.col("text"), len(BASE), *OWNED[1:]).alias("others"))


def ownership(found: DataFrame, most: int = MOST_OWNERS) -> DataFrame:
    """value, repositories, owners and live of all values in found(source, spans)."""
    used = found.select("source", F.explode("spans").alias("s")).select(F.col("s.value").alias("value"), F.coalesce("source", F.lit("")).alias("repository"), F.split_part(F.coalesce("source", F.lit("")), F.lit("/"), F.lit(1)).alias("owner"))
    by_owner = used.groupBy("value", "owner", "repository").count().groupBy("value", "owner").agg(F.count("*").alias("r"))
    out = by_owner.groupBy("value").agg(F.sum("r").alias("repositories"), F.count("*").alias("owners"))
    return out.withColumn("live", (F.col("owners") <= most) & (F.col("repositories") <= most))


def scan(docs: DataFrame, most: int = MOST_OWNERS) -> DataFrame:
    """doc_id, text_hash, base, all (base and added spans by start and kind) and live (the spans of live-looking values)."""
    rows = cut(candidates(docs))
    clear = F.filter("others", lambda x: ~F.exists("base", lambda b: (b["start"] < x["stop"]) & (x["start"] < b["stop"])))
    rows = rows.withColumn("others", clear)
    every = rows.withColumn("spans", F.concat("base", "others")).where(F.size("spans") > 0)
    live = ownership(every, most).where("live").select("value")
    at = every.select("doc_id", "text_hash", F.explode("spans").alias("s")).withColumn("value", F.col("s.value")).join(live, "value")
    at = at.groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).agg(F.collect_set("s").alias("found"))  # spans of one text
    out = rows.join(at, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    live_spans = F.array_sort(F.coalesce("found", F.array().cast(f"array<{SPAN}>")))
    added = F.filter(live_spans, lambda x: x["kind"] == len(BASE))
    return out.select("doc_id", "text_hash", "base", F.array_sort(F.concat("base", added)).alias("all"), live_spans.alias("live"))


def digest(spans_: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans_, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def redact(docs: DataFrame, most: int = MOST_OWNERS, put: str = "[secret]") -> DataFrame:
    """docs with every reported span of the text replaced."""
    found = scan(docs, most).where(F.size("all") > 0).select("doc_id", "text_hash", "all").dropDuplicates(["doc_id", "text_hash"])
    found = found.select(F.col("doc_id").alias(f"{MARK}id"), F.col("text_hash").alias(f"{MARK}hash"), F.col("all").alias(f"{MARK}spans"))
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col(f"{MARK}id")) & (F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col(f"{MARK}hash")), "left")
    # spans may overlap: one that begins before the furthest end so far only moves that end
    all_ = F.col(f"{MARK}spans")
    furthest = running(F.transform(all_, lambda x: x["stop"]), lambda a, b: F.greatest(a, b))
    pieces = let(stretches(F.col("text")), lambda parts: F.zip_with(all_, furthest, lambda x, at: F.when(x["start"] >= at, F.concat(between(parts, at, x["start"]), F.lit(put)))))
    last = F.array_max(F.transform(all_, lambda x: x["stop"]))
    clean = F.concat(F.array_join(F.array_compact(pieces), ""), F.substring(F.col("text"), last + 1, F.length("text")))
    text = F.when(F.col(f"{MARK}spans").isNotNull(), clean).otherwise(F.col("text"))
    return joined.withColumn("text", text).select(*[F.col(f"`{c}`") for c in docs.columns])
