"""Deterministic greedy minimum set cover over classes of structures.

Structures are ranked by (memberships with repeats desc, first seen asc). Again and again the structure in most classes not
yet hit is taken, ties by rank, until all classes are hit. Two ways with equal results: one task with integer arrays and
a bucket queue, up to `local_pairs` distinct memberships (a bound of that task's memory), and beyond it a distributed loop
of one aggregation for each pick.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.operators import lineage
from lacuna.operators.stats import stored

LOCAL_PAIRS = 2_000_000


def frequencies(memberships: DataFrame) -> DataFrame:
    """structure_id and freq, repeats within a class counted."""
    return memberships.groupBy("structure_id").agg(F.count("*").alias("freq"))


def cover_rank(memberships: DataFrame) -> DataFrame:
    """structure_id, freq, first_seen and rank from 0. memberships: class_seq, structure_id, atom_idx. Ranks come from counts
    of ranges, no task sorts all structures."""
    seen = memberships.groupBy("structure_id").agg(F.count("*").alias("freq"), F.min(F.struct("class_seq", "atom_idx")).alias("first_seen"))
    return lineage.ranked(seen, [-F.col("freq"), F.col("first_seen"), F.col("structure_id")]).withColumn("rank", F.col("rank").cast("int"))


def summary(memberships: DataFrame) -> DataFrame:
    return memberships.agg(F.countDistinct("class_seq").alias("n_classes"), F.countDistinct("structure_id").alias("n_structures"), F.count("*").alias("n_memberships"))


def greedy(class_id: np.ndarray, rank: np.ndarray) -> list[int]:
    """Ranks picked, in order. Buckets by number of classes left; a structure moves down lazily when it is met with fewer."""
    import heapq

    classes, class_no = np.unique(class_id, return_inverse=True)
    ranks, rank_no = np.unique(rank, return_inverse=True)
    by_class, by_rank = np.argsort(class_no, kind="stable"), np.argsort(rank_no, kind="stable")
    of_class = np.split(rank_no[by_class], np.cumsum(np.bincount(class_no, minlength=len(classes)))[:-1])
    of_rank = np.split(class_no[by_rank], np.cumsum(np.bincount(rank_no, minlength=len(ranks)))[:-1])
    left, hit, picked = np.array([len(x) for x in of_rank]), np.zeros(len(classes), bool), []
    queue = [(-n, r) for r, n in enumerate(left.tolist())]
    heapq.heapify(queue)
    open_ = len(classes)
    while open_ and queue:
        n, r = heapq.heappop(queue)
        now = int(left[r])
        if now == 0:
            continue
        if -n != now:
            heapq.heappush(queue, (-now, r))
            continue
        picked.append(int(ranks[r]))
        for c in of_rank[r]:
            if not hit[c]:
                hit[c] = True
                open_ -= 1
                left[of_class[c]] -= 1
    return picked


def min_cover(memberships: DataFrame, local_pairs: int = LOCAL_PAIRS) -> DataFrame:
    """structure_id, freq and rank of the structures picked. memberships: class_seq, structure_id, atom_idx."""
    memberships = stored(memberships.select("class_seq", "structure_id", "atom_idx"))
    ranked = cover_rank(memberships).select("structure_id", "freq", "rank")
    pairs = memberships.select("class_seq", "structure_id").distinct().join(ranked, "structure_id").select("class_seq", "rank")
    return ranked.join(picks(pairs, local_pairs), "rank").select("structure_id", "freq", "rank")


def picks(pairs: DataFrame, local_pairs: int) -> DataFrame:
    """Ranks picked from pairs(class_seq, rank), all different. Counts of open classes only fall, so a structure that leads in
    each of its open classes (by count, then rank) keeps its count until the greedy order comes to it: all such structures of a
    round are picked at once, which closes every class of theirs. Of structures with equal open classes a round keeps the
    first, until that saves less than a fifth of the pairs. A round's pairs and picks are stored tables."""
    left, rounds, copies = stored(pairs.select("class_seq", F.col("rank").cast("int").alias("rank"))), [], True
    while (n := left.count()) > local_pairs:
        if copies:
            before, left = n, stored(first_of_equals(left))
            n = left.count()
            copies = n < 0.8 * before
            if n <= local_pairs:
                break
        keyed = left.join(left.groupBy("rank").agg(F.count("*").alias("n")), "rank").withColumn("key", F.struct((-F.col("n")).alias("n"), "rank"))
        led = keyed.groupBy("class_seq").agg(F.min("key").alias("best"))
        won = led.groupBy(F.col("best.rank").alias("rank"), (-F.col("best.n")).alias("n")).agg(F.count("*").alias("wins"))
        rounds.append(stored(won.where("wins = n").select("rank")))
        closed = left.join(rounds[-1], "rank", "left_semi").select("class_seq").distinct()
        left = stored(left.join(closed, "class_seq", "left_anti"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"rank": greedy(pdf["class_seq"].to_numpy(), pdf["rank"].to_numpy())})

    out = left.groupBy(F.lit(0).alias("all")).applyInPandas(solve, "rank int") if n else left.select("rank").limit(0)  # local_pairs at most
    for found in rounds:
        out = out.union(found)
    return out


def first_of_equals(pairs: DataFrame) -> DataFrame:
    """pairs(class_seq, rank) of the first structure by rank of each set of classes. The others with that set are never picked:
    they always have its count and come after it, and its pick closes all their classes."""
    sets = pairs.groupBy("rank").agg(F.array_sort(F.collect_list("class_seq")).alias("classes"))  # a structure's different classes
    return sets.groupBy("classes").agg(F.min("rank").alias("rank")).select(F.explode("classes").alias("class_seq"), "rank")


def uncovered_classes(memberships: DataFrame, picked: DataFrame) -> DataFrame:
    """Certificate: the classes that no picked structure hits."""
    return memberships.select("class_seq").distinct().join(memberships.join(picked.select("structure_id"), "structure_id", "left_semi").select("class_seq"), "class_seq", "left_anti")
