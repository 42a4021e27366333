"""Mixing sources to target weights by subset sums over exact document lengths.

Documents are counted by exact length.  A bounded-knapsack dynamic programme over these
counts decides how many documents of each length fill what a source still needs, and a
seeded order decides which ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbflow.llm.common import n_words, own_names, stored

OUTPUTS = ("size", "source_size", "target", "copies", "taken")
# Seeded order inside one (source, length): rows are ranked inside one of so many slices of
# the hash only, so a length that holds a third of all rows is not ranked in one task.
SLICES = 256
PICKS = "source string, size long, passes long, picked long"


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = 1 << 18) -> np.ndarray:
    """How many documents of each length add up to ``budget`` as nearly as can be.

    Most of a large budget is taken evenly from all lengths; the remaining ``window`` words
    are settled exactly: a bounded-knapsack programme over sums, which records for each sum
    the length and number of copies that reached it first.  Work is bounded by the window
    and the number of lengths, not by the number of documents.
    """
    lengths = np.asarray(lengths, dtype=np.int64)
    counts = np.asarray(counts, dtype=np.int64)
    take = np.zeros_like(counts)
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return counts.copy()
    left = int(budget)
    if left > window:
        take = np.floor(counts * ((left - window // 2) / total)).astype(np.int64)
        left -= int((take * lengths).sum())
        for i in np.argsort(-lengths, kind="stable"):
            if left <= window:
                break
            more = min(int(counts[i] - take[i]), (left - window // 2) // int(lengths[i]))
            if more > 0:
                take[i] += more
                left -= more * int(lengths[i])
    spare = counts - take
    usable = np.flatnonzero((spare > 0) & (lengths > 0))
    if left <= 0 or len(usable) == 0:
        return take
    # Sums above the budget count too; more than twice of it is never nearer than nothing.
    top = 2 * left
    reached = np.zeros(top + 1, dtype=bool)
    reached[0] = True
    by = np.full(top + 1, -1, dtype=np.int64)
    copies = np.zeros(top + 1, dtype=np.int64)
    for i in usable[np.argsort(-lengths[usable], kind="stable")]:
        size = int(lengths[i])
        fresh = np.flatnonzero(reached)
        for k in range(1, min(int(spare[i]), top // size) + 1):
            fresh = fresh + size
            fresh = fresh[fresh <= top]
            fresh = fresh[~reached[fresh]]
            if len(fresh) == 0:
                break
            reached[fresh] = True
            by[fresh], copies[fresh] = i, k
        if reached[left]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - left))])
    while at > 0:
        i, k = int(by[at]), int(copies[at])
        take[i] += k
        at -= k * int(lengths[i])
    return take


def source_targets(totals: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size) -> plus ``target``: the budget dealt by weight, capped.

    Sources get the weights in turn, by code point, null last.  A target stops at ``most``
    times its source; what is over goes to the others by weight.  That ends where each
    target is the smaller of its cap and one common level times its weight, so the sources
    fill up in the order of cap / weight, and running sums give the level.  One row per
    source passes here, never documents.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place + 1).cast("int"))
    ranked = (
        totals.withColumn("_w", weight)
        .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("_ratio", F.col("_cap") / F.col("_w"))
    )
    fill = W.orderBy("_ratio", F.col("source").asc_nulls_last())
    whole = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(
        F.sum("_cap").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)
    )
    levels = ranked.withColumn("_level", left / F.sum("_w").over(fill.rowsBetween(0, W.unboundedFollowing)))
    levels = levels.withColumn("_full", F.col("_ratio") <= F.col("_level"))
    level = F.min(F.when(~F.col("_full"), F.struct("_ratio", F.col("source").isNull(), "source", "_level"))).over(whole)
    return levels.withColumn("_common", level["_level"]).select(
        "source",
        "source_size",
        F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_common") * F.col("_w")).alias("target"),
    )


@own_names
def mix_sources(
    df: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How often the mix takes each document.

    Returns per input row: ``id_col``, ``source``, ``size`` (words), ``source_size``,
    ``target`` (of its source), ``copies`` and ``taken`` (= copies x size).  The budget is
    ``share`` times all words.  Each source gives whole passes over all its documents as
    far as the target holds them, and the rest by ``fit_budget``; no document is taken more
    than ``most`` times.  Null texts have size 0 and are taken in whole passes only; null
    sources form one source; repeated rows are separate rows; an empty table gives none.
    Choice depends on id, length and seed only, so reruns agree.
    """
    base = stored(
        df.select(
            F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size")
        ).withColumn("order", F.xxhash64(F.lit(seed), F.col("id").cast("string"))),
        "mix",
    ).withColumn("slice", F.pmod(F.col("order"), F.lit(SLICES)).cast("int"))
    counts = base.groupBy("source", "size", "slice").agg(F.count("*").alias("n"))
    by_length = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    totals = by_length.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = stored(source_targets(totals, weights, share, most), "targets")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size")
        total, target = int(pdf.source_size.iloc[0]), float(pdf.target.iloc[0])
        passes = int(target // total) if total else 0
        picked = fit_budget(pdf["size"].to_numpy(), pdf["n"].to_numpy(), round(target) - passes * total)
        return pd.DataFrame({"source": pdf.source, "size": pdf["size"], "passes": passes, "picked": picked})

    same_source = F.col("a.source").eqNullSafe(F.col("b.source"))
    lengths = by_length.alias("a").join(targets.alias("b"), same_source).select("a.*", "source_size", "target")
    picks = stored(lengths.groupBy("source").applyInPandas(choose, PICKS), "picks")

    before = F.sum("n").over(W.partitionBy("source", "size").orderBy("slice").rowsBetween(W.unboundedPreceding, -1))
    slices = counts.withColumn("before", F.coalesce(before, F.lit(0)))
    both = same_source & (F.col("a.size") == F.col("b.size"))
    limits = (
        slices.alias("a")
        .join(picks.alias("b"), both)
        .select("a.source", "a.size", "slice", "passes", (F.col("picked") - F.col("before")).alias("still"), "n")
    )
    # Only the slice in which the number runs out needs ranks.
    rank = F.row_number().over(W.partitionBy("source", "size", "slice").orderBy("order", "id"))
    rows = base.alias("a").join(limits.alias("b"), both & (F.col("a.slice") == F.col("b.slice"))).select("a.*", "passes", "still")
    copies = F.col("passes") + (rank <= F.col("still")).cast("long")
    return (
        rows.withColumn("copies", copies)
        .alias("a")
        .join(targets.alias("b"), same_source)
        .select(
            F.col("id").alias(id_col), "a.source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
        )
    )


@own_names
def mixed_documents(df: DataFrame, **options) -> DataFrame:
    """The mix itself: the input's rows, each as often as the mix takes it.

    Rows that share an id share its number of copies; a repeated id keeps all its rows.
    """
    id_col = options.get("id_col", "doc_id")
    copies = mix_sources(df, **options).groupBy(F.col(id_col).alias("_id")).agg(F.max("copies").alias("_copies"))
    return (
        df.join(copies, F.col(id_col).eqNullSafe(F.col("_id")))
        .where("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .drop("_id", "_copies", "_copy")
    )
