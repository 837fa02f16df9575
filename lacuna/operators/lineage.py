"""Chunks, cumulative versions, loop labels, multiset subtraction."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.text import loop_label
from lacuna.operators import intervals
from lacuna.operators.stats import stored


def chunk_of(df: DataFrame, k: int, order: str) -> DataFrame:
    """Balanced contiguous chunks from 0, the first n % k one longer. Places come from counts of id ranges, so that no task
    sorts all rows; `order` must be unique."""
    return _placed(df, order).withColumn("chunk", _ntile(F.col("_at"), F.col("_total"), k)).drop("_at", "_total")


def _ntile(at: Column, total: Column, k: int) -> Column:
    small, longer = F.floor(total / k), F.pmod(total, F.lit(k))
    edge = longer * (small + 1)
    return F.when(at < edge, F.floor(at / (small + 1))).otherwise(longer + F.floor(F.try_divide(at - edge, small))).cast("int")


def _placed(df: DataFrame, order: str) -> DataFrame:
    """df with _at, its place by `order` from 0, and _total. Only the order's values are ranked; rows meet them by value."""
    places = ranked(df.select(F.col(order).alias("_o")), [F.col("_o")]).withColumnRenamed("rank", "_at")
    total = places.agg(F.count("*").alias("_total"))
    return df.join(places, F.col(order).eqNullSafe(F.col("_o"))).drop("_o").crossJoin(F.broadcast(total))  # one row


def ranked(df: DataFrame, order: list[Column]) -> DataFrame:
    """df with rank, its place from 0 by `order`: Spark's own range partitions are sorted, numbered within, and moved by the
    counts of the partitions before. Stored between, as the ranges come from a sample; one row a partition is gathered."""
    if "rank" in df.columns:
        raise ValueError("a column is named rank already")
    sort = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    ranged = stored(df.withColumn("_k", sort).repartitionByRange(F.col("_k")).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("_part").orderBy("_k")) - 1
    placed = ranged.withColumn("_within", within).join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part")
    return placed.select(*df.columns, (F.col("_within") + F.col("_before")).alias("rank"))


def reduce_chunks(df: DataFrame, n: int, chunk_size: int, order: str) -> DataFrame:
    """max(1, n // chunk_size) chunks: a chunk may have nearly twice chunk_size rows."""
    return chunk_of(df, max(1, n // chunk_size), order)


def ceil_split(df: DataFrame, k: int, order: str) -> DataFrame:
    """Parts of ceil(n / k) rows, the last shorter."""
    return _placed(df, order).withColumn("chunk", F.floor(F.col("_at") / F.ceil(F.col("_total") / k)).cast("int")).drop("_at", "_total")


def discover_labels(frames: DataFrame, main: str = "main") -> DataFrame:
    """main, label and label_pos, init first. A value that is no whole number is an error; null is left out."""
    value = F.col(main).cast("string").try_cast("double")
    whole = F.when(value == F.round(value), value.cast("long")).otherwise(F.raise_error(F.concat(F.lit("not a whole number: "), F.col(main).cast("string"))).cast("long"))
    found = frames.where(F.col(main).isNotNull()).select(whole.alias("main")).distinct()
    return found.select("main", loop_label(F.col("main")).alias("label"), (F.row_number().over(Window.orderBy("main")) - 1).alias("label_pos"))


def cumulative(frames: DataFrame, labels: DataFrame, main: str = "main") -> DataFrame:
    """frames once for their own label and for every later one; Spark broadcasts the labels if they are few."""
    places = labels.select(F.col("main").alias("_m"), "label_pos", "label", (F.row_number().over(Window.orderBy("label_pos")) - 1).alias("_k"))  # a row a label
    last = places.agg(F.max("_k")).first()[0]
    at = places.select("_m", F.col("label_pos").alias("frame_pos"), F.col("_k").alias("_own"))
    own = frames.join(at, F.col(main) == F.col("_m")).drop("_m").withColumn("_k", F.explode(F.sequence(F.col("_own"), F.lit(last if last is not None else 0)))).drop("_own")
    return own.join(places.select("_k", "label_pos", "label"), "_k").drop("_k")


def unmatched(frames: DataFrame, labels: DataFrame, main: str = "main") -> int:
    return frames.join(labels.select(F.col("main").alias("_m")), F.col(main) == F.col("_m"), "left_anti").count()


def parse_loops(text: str) -> list[int]:
    """"[-1, 0, loop-2, init]" to main values, each once, in order."""
    out: list[int] = []
    for word in text.strip().strip("[]").replace(",", " ").lower().split():
        digits = word.removeprefix("loop").lstrip("-_").removeprefix("n") if word.startswith("loop") else ""
        value = -1 if word == "init" else int(digits) - 1 if digits else int(word)
        if value not in out:
            out.append(value)
    if not out:
        raise ValueError("no loops named")
    return out


def select_loops(mains: list[int], how: str) -> list[int]:
    """Main values to report: all, the middle half, a uniform half, or those listed; -1 first, the last loop always, and
    all where there are at most 3."""
    if how not in ("all", "middle-half", "uniform-half"):
        wanted = parse_loops(how)
        if gone := [m for m in wanted if m not in mains]:
            raise ValueError(f"no such loops: {gone}")
        return wanted
    first, loops = [m for m in mains if m == -1], sorted(m for m in set(mains) if m >= 0)
    n = len(loops)
    if how == "all" or n <= 3:
        places = list(range(n))
    elif how == "middle-half":
        places = [*range(math.ceil(0.25 * (n - 1)), math.floor(0.75 * (n - 1)) + 1), n - 1]
    else:
        keep = math.ceil(n / 2)
        places = [*(round(i * (n - 1) / (keep - 1)) if keep > 1 else 0 for i in range(keep)), n - 1]
    return first + [loops[i] for i in dict.fromkeys(places)]


#: Marks that are broadcast and searched by halving; more are merged with the rows by ranges.
FEW = 10_000


def located(rows: DataFrame, marks: DataFrame, at: str, few: int = FEW) -> DataFrame:
    """rows with `mark`, the last of marks(start, mark) whose start is not above the row's `at`; null before the first. Starts
    are different. A few marks are searched by halving in one array; many are put in order among the rows, in ranges, and
    each range takes over the last mark of the ranges before it."""
    if marks.limit(few + 1).count() <= few:
        array = marks.agg(F.array_sort(F.collect_list(F.struct("start", "mark"))).alias("_marks"))
        starts = F.transform("_marks", lambda m: m["start"])
        placed = rows.crossJoin(F.broadcast(array.select("_marks", starts.alias("_starts"))))  # one row
        k = intervals.last_start(F.col(at), F.col("_starts"))
        return placed.withColumn("_k", k).withColumn("mark", F.when(F.col("_k") >= 0, F.get("_marks", F.col("_k"))["mark"])).drop("_marks", "_starts", "_k")
    kind, row = marks.schema["mark"].dataType, rows.schema
    # a row's columns are one struct; equal places are spread over ranges by a hash
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    left = rows.select(F.col(at).alias("_at"), F.lit(1).alias("_kind"), spread.alias("_h"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), F.lit(None).cast(kind).alias("_mark"))
    right = marks.select(F.col("start").alias("_at"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_h"), F.lit(None).cast(row).alias("_row"), F.col("mark").alias("_mark"))
    both = stored(left.union(right).repartitionByRange("_at", "_kind", "_h").withColumn("_part", F.spark_partition_id()))
    own = F.last("_mark", ignorenulls=True).over(Window.partitionBy("_part").orderBy("_at", "_kind", "_h"))
    lasts = both.where("_kind = 0").groupBy("_part").agg(F.max_by("_mark", "_at").alias("_last"))
    parts = both.select("_part").distinct().join(lasts, "_part", "left")
    before = F.last("_last", ignorenulls=True).over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # a row a range
    carried = parts.select("_part", before.alias("_carried"))
    out = both.withColumn("_own", own).where("_kind = 1").join(F.broadcast(carried), "_part")
    return out.select("_row.*", F.coalesce("_own", "_carried").alias("mark"))


def segment_labels(frames: DataFrame, counts: DataFrame, index: str = "frame_idx") -> DataFrame:
    """frames with main: -1 for the first segment, then 0, 1, ... by the segments' counts(main, cnt); null beyond them."""
    upto = F.sum("cnt").over(Window.orderBy("main"))  # one row a segment
    segments = counts.where("cnt > 0").select((upto - F.col("cnt")).alias("start"), F.struct("main", upto.alias("stop")).alias("mark"))
    found = located(frames.drop("main"), segments, index)
    return found.withColumn("main", F.when(F.col(index) < F.col("mark.stop"), F.col("mark.main"))).drop("mark")


def configuration_of(structures: DataFrame, spans: DataFrame, sid: str = "structure_id") -> DataFrame:
    """structures with config by spans(config, start, stop), half-open and disjoint; spans of one name are one group."""
    found = located(structures, spans.select("start", F.struct("config", "stop").alias("mark")), sid)
    return found.where(F.col(sid) < F.col("mark.stop")).withColumn("config", F.col("mark.config")).drop("mark")


def configurations_with(spans: DataFrame, selected: DataFrame, by_span: bool = False) -> DataFrame:
    """Names of configurations that hold a selected id; by_span: within the first and last id of the name, so that
    interleaved names match too often, as the reference does. Work grows with spans and ids, not with the spans' lengths."""
    ids = selected.select("structure_id").distinct()
    if not by_span:
        return configuration_of(ids, spans).select("config").distinct()
    whole = spans.groupBy("config").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    # the least selected id that is not below a start: the last mark not above it, both negated
    marks = ids.select((-F.col("structure_id")).alias("start"), F.col("structure_id").alias("mark"))
    first = located(whole.withColumn("_from", -F.col("start")), marks, "_from")
    return first.where(F.col("mark") < F.col("stop")).select("config")


def multiset_subtract(full: DataFrame, initial: DataFrame, key: list[str], order: str, hot: int = 1_000_000) -> DataFrame:
    """full without, for each fingerprint, as many rows as initial has: the earliest go. Exact equality, null equals null. A
    fingerprint of more than `hot` rows is ranked over many ranges, others by a window each; both ways are exact."""
    counts = initial.groupBy(*key).agg(F.count("*").alias("_n")).select(F.struct(*key).alias("_key"), "_n")
    rows = full.withColumn("_own", F.struct(*key))
    same = F.col("_own").eqNullSafe(F.col("_key"))
    large = rows.groupBy("_own").agg(F.count("*").alias("_m")).where(F.col("_m") > hot).select(F.col("_own").alias("_key"))
    some = bool(large.head(1))
    small = rows.join(large, same, "left_anti") if some else rows
    placed = small.withColumn("_r", F.row_number().over(Window.partitionBy("_own").orderBy(order)))
    out = placed.join(counts, same, "left").where(F.col("_r") > F.coalesce("_n", F.lit(0))).select(*full.columns)
    if not some:
        return out
    spread = ranked(rows.join(large, same, "left_semi"), [F.col("_own"), F.col(order)])
    first = spread.groupBy("_own").agg(F.min("rank").alias("_first")).withColumnRenamed("_own", "_of")
    cut = first.join(counts, F.col("_of").eqNullSafe(F.col("_key"))).select("_key", (F.col("_first") + F.col("_n")).alias("_cut"))
    kept = spread.join(cut, same, "left").where(F.col("_cut").isNull() | (F.col("rank") >= F.col("_cut")))
    return out.union(kept.select(*full.columns))


def relabel(df: DataFrame, main: int = -1) -> DataFrame:
    return df.withColumn("main", F.lit(main))
