"""Sources mixed to target weights by Pareto order sampling, in DataFrame functions alone.

Targets: sources, by code point with null last, weigh WEIGHTS in turn and share SHARE times all words; no source gets more
than MOST times its words, what it would get beyond goes to the others by weight. Within a source, a document's expected
copies grow with the logarithm of its size: they are min(MOST, rate * bits), bits being the binary digits of the size, and
the rate is such that all expected words make the target. Whole copies are certain. The rest of the expected copies is the
document's inclusion probability p, which differs between documents of different sizes, and a sample of a fixed size, counted in
words, is taken without replacement: documents are ranked by Pareto order, the random odds u / (1 - u) over the inclusion
odds p / (1 - p), and taken in that order if their words fit what is still missing; those that do not are passed over, until
no document of the rest fits. One more that does not fit is taken if it comes nearer to the target, so that a source misses
its target by at most half the words of the smallest document left. u is a hash of the id and the seed, so reruns agree.

A round takes documents no larger than what is missing up to the first that does not fit, where the next round starts with
less missing. Sums over ranges of the Pareto order, about RANGE_ROWS documents of the table each, tell in which range a
round ends, and only the rows of that range are ordered: a source with a third of all rows is never in one task. The plan
has a row for each source and binary digit of its sizes; it is broadcast only if counted to be small.

Defined results: null and empty texts have size 0 and take 0 words; repeated rows of one id and size are taken or left
together; sources without words have target 0; an empty table gives no rows; other columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.llm.common import SMALL_ROWS, SPACE, cut

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
SEED = 20
#: Rows of a range of the Pareto order, on average, and the least number of ranges.
RANGE_ROWS, RANGES = 10_000, 4096
#: One column added to a table whose other columns must pass through.
MIX = "__lacuna_mix"


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> dict[str | None, float]:
    """Words that each source shall give."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, left, open_ = {}, share * sum(sizes.values()), list(order)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in over)
        open_ = [s for s in open_ if s not in out]
    return out


def source_targets(by_source: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """source, source_size and target of by_source(source, source_size), as `targets` tells: sources stop at `most` times
    their words in order of words by weight, so that the first that does not stop tells the share of a weight of all others."""
    places = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = by_source.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(places, F.lit(len(weights))).cast("int") + 1))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())  # one row for each source
    before = F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    from_here = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    rows = rows.withColumn("level", (total * share - before * most) / from_here)
    rows = rows.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("source_size") * most, F.col("level"))).over(Window.partitionBy()))
    target = F.least(F.col("source_size") * float(most), F.coalesce(F.col("level"), F.lit(float("inf"))) * F.col("weight"))
    return rows.select("source", "source_size", F.when(F.col("source_size") > 0, target).otherwise(F.lit(0.0)).alias("target"))


def plan_table(rows: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """One row for each source and bits of rows(source, size, bits): source_size, target, need (the words to sample in the
    source), whole copies and p, the inclusion probability of the sample."""
    classes = cut(rows.groupBy("source", "bits").agg(F.sum("size").alias("n")))
    of = source_targets(classes.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, most)
    classes = classes.join(of.withColumnRenamed("source", "of_source"), F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    # longer documents reach `most` copies first; the first class that does not tells the rate of the others
    order = Window.partitionBy("source").orderBy(F.col("bits").desc())
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    from_here = F.sum(F.col("n") * F.col("bits")).over(order.rowsBetween(0, Window.unboundedFollowing))
    rate = F.try_divide(F.col("target") - before * float(most), from_here)
    classes = classes.withColumn("rate", rate)
    rate = F.max_by(F.when(F.col("rate") * F.col("bits") <= most, F.col("rate")), F.when(F.col("rate") * F.col("bits") <= most, F.col("bits"))).over(Window.partitionBy("source"))
    copies = F.when(F.col("bits") > 0, F.least(F.lit(float(most)), F.coalesce(rate, F.lit(float(most))) * F.col("bits"))).otherwise(F.lit(0.0))
    classes = classes.withColumn("copies", F.round(copies, 12)).withColumn("whole", F.floor("copies").cast("int"))
    need = F.greatest(F.col("target") - F.sum(F.col("whole") * F.col("n")).over(Window.partitionBy("source")), F.lit(0.0))
    return classes.select("source", "bits", "source_size", "target", "whole", (F.col("copies") - F.col("whole")).alias("p"), need.alias("need"))


def bits_of(size):
    """The binary digits of a size, 0 of 0."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(F.lit(0))


def measured(docs: DataFrame, seed: int) -> DataFrame:
    """MIX: what a row brings by itself: source, size, its bits and u."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 12).cast("double") + 0.5) / float(1 << 52)
    row = F.struct(F.col("source").cast("string").alias("source"), size.alias("size"), F.col("doc_id").alias("id"), u.alias("u"))
    return docs.withColumn(MIX, row)


def beside(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", few: bool = False) -> DataFrame:
    """left with the columns of right, which is broadcast if counted to have `few` rows; null equals null."""
    side = right.withColumnsRenamed({c: f"of_{c}" for c in on})
    side = F.broadcast(side) if few else side
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    return left.join(side, same, how).drop(*[f"of_{c}" for c in on])


def pareto_key(u, p, doc_id, size):
    """The Pareto order: random odds over inclusion odds, ties by id and size."""
    return F.when((p > 0) & (p < 1), F.struct((u / (1 - u) / F.try_divide(p, 1 - p)).alias("odds"), doc_id.alias("id"), size.alias("n")))


def sample_ends(rows: DataFrame, plan: DataFrame, few: bool = False) -> DataFrame:
    """For each source with words to sample: the stretches of the Pareto order that it takes (after, last, most: documents
    between these keys of at most so many words) and the key of a document taken beyond them (`extra`). rows: source, size,
    bits, id, u. few: the plan, and so any table of sources, is counted to be small enough to broadcast."""
    with_ = lambda left, right, on, how="inner": beside(left, right, on, how, few)
    ordered = with_(rows, plan.where("p > 0").select("source", "bits", "p"), ["source", "bits"])
    ordered = ordered.select("source", "size", pareto_key(F.col("u"), F.col("p"), F.col("id"), F.col("size")).alias("key"))
    ranges = max(RANGES, rows.count() // RANGE_ROWS)
    odds = F.col("key.odds")
    ordered = cut(ordered.withColumn("range", F.floor(odds / (1 + odds) * ranges)))  # odds from 0 up to 0 to 1, keeping their order
    key = ordered.schema["key"].dataType.simpleString()
    none = F.lit(None).cast(key)
    needs = plan.where("p > 0").groupBy("source").agg(F.max("need").alias("missing"))
    state = cut(needs.select("source", "missing", none.alias("after"), F.array().cast(f"array<struct<after:{key},last:{key},most:double>>").alias("stretches")))
    tail = ordered
    while True:
        fits = with_(tail, state.select("source", "missing"), ["source"])
        sums = fits.groupBy("source", "range", "missing").agg(F.sum("size").alias("n"))
        sums = sums.withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("range"))).where("upto > missing")
        ends = sums.groupBy("source").agg(F.min(F.struct(F.col("range").alias("end"), (F.col("upto") - F.col("n")).alias("before"))).alias("e"))
        marked = with_(fits, cut(ends.select("source", "e.*")), ["source"], "left")
        whole = marked.where("end is null or range < end").groupBy("source").agg(F.max("key").alias("last"), F.sum("size").alias("taken"))
        running = F.sum("size").over(Window.partitionBy("source").orderBy("key")) + F.col("before")
        part = marked.where("range = end").withColumn("taken", running).where("taken <= missing")
        part = part.groupBy("source").agg(F.max("key").alias("last"), F.max("taken").alias("taken"))
        last = whole.union(part).groupBy("source").agg(F.max("last").alias("last"), F.max("taken").alias("taken"))
        more = F.when(F.col("last").isNotNull(), F.array(F.struct("after", "last", F.col("missing").alias("most")))).otherwise(F.array())
        state = with_(state, cut(last), ["source"], "left")
        state = cut(state.select("source", (F.col("missing") - F.coalesce("taken", F.lit(0))).alias("missing"), F.coalesce("last", "after").alias("after"), F.concat("stretches", more).alias("stretches")))
        tail = with_(tail, state.select("source", "missing", "after"), ["source"]).where("size > 0 and size <= missing and (after is null or key > after)")
        tail = cut(tail.select("source", "size", "key", "range"))
        if tail.isEmpty():
            break
    left = with_(ordered, state, ["source"]).where("size < 2 * missing").where(~taken_in(F.col("stretches"), F.col("key"), F.col("size")))
    extra = left.groupBy("source").agg(F.min_by("key", F.struct(F.abs(F.col("size") - F.col("missing")), "key")).alias("extra"))
    return with_(state, cut(extra), ["source"], "left").select("source", "stretches", "extra")


def taken_in(stretches, key, size):
    """Whether a stretch has a document of this key and size."""
    within = lambda x: (x["after"].isNull() | (key > x["after"])) & (key <= x["last"]) & (size <= x["most"])
    return F.coalesce(F.exists(stretches, within), F.lit(False))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """docs(doc_id, text, source, ...) with a column MIX of size, source_size, target, copies and taken (copies times size)."""
    rows = measured(docs.select("doc_id", "text", "source"), seed).select(f"{MIX}.*")
    rows = cut(rows.withColumn("bits", bits_of(F.col("size"))))
    plan = cut(plan_table(rows, weights, share, most))
    few = plan.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
    by_class = cut(beside(plan, sample_ends(rows, plan, few), ["source"], "left", few))
    by_class = by_class.select(F.col("source").alias("__lacuna_source"), F.col("bits").alias("__lacuna_bits"), F.struct(*by_class.columns).alias("__lacuna_plan"))
    row, of = (lambda c: F.col(f"{MIX}.{c}")), (lambda c: F.col(f"__lacuna_plan.{c}"))
    same = row("source").eqNullSafe(F.col("__lacuna_source")) & (bits_of(row("size")) == F.col("__lacuna_bits"))
    out = measured(docs, seed).join(F.broadcast(by_class) if few else by_class, same).drop("__lacuna_source", "__lacuna_bits")
    key = pareto_key(row("u"), of("p"), row("id"), row("size"))
    within = taken_in(of("stretches"), key, row("size")) | F.coalesce(key == of("extra"), F.lit(False))
    copies = of("whole") + ((of("p") > 0) & within).cast("int")
    found = F.struct(row("size").alias("size"), of("source_size").alias("source_size"), of("target").alias("target"), copies.alias("copies"), (copies * row("size")).alias("taken"))
    return out.withColumn(MIX, found).drop("__lacuna_plan")


def repeat(docs: DataFrame, **options) -> DataFrame:
    """docs with each row as often as the mix takes it."""
    mixed = mix(docs, **options).where(f"{MIX}.copies > 0")
    return mixed.withColumn("__lacuna_copy", F.explode(F.array_repeat(F.lit(0), F.col(f"{MIX}.copies")))).select(*[F.col(f"`{c}`") for c in docs.columns])
