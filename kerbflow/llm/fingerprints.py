"""I-Match fingerprints, with DataFrame functions only.

Terms get a slot of a hashed lexicon of fixed size; slots whose inverse document frequency
lies in a band are kept.  A text's distinct kept terms, sorted, are hashed once as a whole
and once for each of several randomised subsets of the lexicon.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbflow.llm.common import n_bytes, stored

OUTPUTS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
SLOT_BITS = 18
BREAKS = ("\n", "\r", "\t", ",", ".")  # end terms, as the space does
BITMAP_BITS = 32_768  # of Spark's bitmap functions
EMPTY_HASH = 42  # xxhash64 of an empty array
BUCKET_BYTES = 32_000_000
# A subset keeps a term with a chance of one in so many.  There are three series of
# subsets, each drawn by bits of the term's hash of its own; the finer ones of a series lie
# within its coarser ones, so each is found among few terms.  The fine ones tell only of
# texts with about as many terms.
SERIES = tuple(tuple(2**k for k in range(first, 11)) for first in (1, 2, 2))
SERIES_BITS = 20
SUBSETS = 1 + sum(map(len, SERIES))


def terms(text: Column) -> Column:
    """Distinct lower-case runs of anything but space and ``BREAKS``.

    The text is split at one plain character, which Spark does several times faster than
    at a pattern.
    """
    spaced = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), BREAKS, F.lower(text))
    return F.array_remove(F.array_distinct(F.split(spaced, " ")), "")


def _slot(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit((1 << SLOT_BITS) - 1))


def lexicon(df: DataFrame, text_col: str = "text", low: float = 2.0, high: float = 9.0) -> list[int]:
    """One bit per slot, in words of 64, set where ln(documents / documents with the slot)
    is in the band.

    Documents are counted over the whole table, with partial counts before the shuffle; the
    driver gets a bitmap of 2**SLOT_BITS bits, whatever the table's size.
    """
    total = df.count()
    slots = df.select(F.explode(F.array_distinct(F.transform(terms(F.col(text_col)), lambda t: _slot(F.xxhash64(t))))).alias("slot"))
    counts = slots.groupBy("slot").agg(F.count("*").alias("n"))
    band = counts.where(F.col("n").between(total * math.exp(-high), total * math.exp(-low))).withColumn("bit", F.col("slot") + 1)
    rows = band.groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = bytearray((1 << SLOT_BITS) // 8)
    for part, bits in rows.collect():
        at = (part - 1) * BITMAP_BITS // 8
        out[at : at + len(bits)] = bits
    return [int.from_bytes(out[i : i + 8], "little", signed=True) for i in range(0, len(out), 8)]


def with_parts(df: DataFrame, text_col: str, held: list[int], out: str) -> DataFrame:
    """Add ``out``: one hash per lexicon subset, ``EMPTY_HASH`` where no term is in it.

    A text without terms in the band uses all its terms.  Terms stand for themselves by a
    64-bit hash, and that is their order.  Each step is a column of its own, so that texts
    are split once.
    """
    # One literal of text, which Spark folds into an array: thousands of literals would
    # slow down each step of planning.
    words = F.split(F.lit(",".join(map(str, held))), ",").cast("array<bigint>")

    def in_band(h: Column) -> Column:
        word = F.element_at(words, (F.shiftright(_slot(h), 6) + 1).cast("int"))
        return F.getbit(word, h.bitwiseAND(F.lit(63)).cast("int")) == 1

    def drawn(series: int, n: int) -> Callable[[Column], Column]:
        mask = (n - 1) << (SERIES_BITS * series)
        return lambda h: h.bitwiseAND(F.lit(mask)) == 0

    step = (
        df.withColumn("_found", F.sort_array(F.transform(terms(F.col(text_col)), lambda t: F.xxhash64(t))))
        .withColumn("_kept", F.filter("_found", in_band))
        .withColumn("_used", F.when(F.size("_kept") > 0, F.col("_kept")).otherwise(F.col("_found")))
    )
    found = ["_used"]
    for depth in range(max(map(len, SERIES))):
        new = {}
        for j, draws in enumerate(SERIES):
            if depth < len(draws):
                coarser = f"_s{j}_{draws[depth - 1]}" if depth else "_used"
                new[f"_s{j}_{draws[depth]}"] = F.filter(coarser, drawn(j, draws[depth]))
        step = step.withColumns(new)
        found += new
    return step.withColumn(out, F.array(*(F.xxhash64(c) for c in found))).drop("_found", "_kept", *found)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets in which either text has a term; of two
    texts without terms, 1."""
    pairs = [(a[j], b[j]) for j in range(SUBSETS)]
    same = reduce(Column.__add__, (((x == y) & (x != EMPTY_HASH)).cast("int") for x, y in pairs))
    used = reduce(Column.__add__, (((x != EMPTY_HASH) | (y != EMPTY_HASH)).cast("int") for x, y in pairs))
    return F.when(used == 0, F.lit(1.0)).otherwise(same / used)


def as_string(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda h: F.lower(F.hex(h))), "-")


def fingerprints(df: DataFrame, text_col: str = "text", **band) -> DataFrame:
    """Add ``fingerprint`` to each row.  Null texts are empty; empty texts share one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    held = lexicon(df.select(text.alias("text")), **band)
    parts = with_parts(df.drop("fingerprint").withColumn("_text", text), "_text", held, "_parts")
    return parts.withColumn("fingerprint", as_string(F.col("_parts"))).drop("_text", "_parts")


def edit_check(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **band) -> DataFrame:
    """Fingerprint each text, its edited text and the next document, and their likeness.

    The next document is the one with the next smaller id; the last is followed by the
    first.  The edited text has its last floor(n / 2) characters replaced by as many of the
    next document's first ones, or all.  Rows without an id come last; rows of one id are
    ordered by a hash of their texts; a single row is its own next; an empty table gives
    none.  Rows are dealt into id ranges, each sorted by one task, and the first row of
    each range is joined to the range before, so no task sees the whole table.
    """
    base = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    held = lexicon(base.select("text"), **band)
    low, high, size = base.agg(F.min("id"), F.max("id"), F.sum(n_bytes(F.col("text")) + 16)).first()
    buckets = max(1, math.ceil((size or 0) / BUCKET_BYTES))
    width = max(1, ((high or 0) - (low or 0)) // buckets + 1)
    bucket = F.coalesce(F.expr(f"(id - ({low or 0}L)) div {width}L"), F.lit(-1).cast("long"))
    plain = base.withColumn("bucket", bucket).withColumn("tie", F.xxhash64("text"))
    rows = with_parts(plain.withColumn("n", F.length("text")), "text", held, "own")
    heads = base.withColumn("bucket", bucket).groupBy("bucket").agg(F.max(F.struct(F.coalesce("id", F.lit(0)).alias("id"), F.bitwise_not(F.xxhash64("text")).alias("tie"))).alias("top"))
    # One row per range: the range after it, in falling order, and round to the first.
    turn = W.orderBy(F.col("bucket").desc())
    first = F.max(F.struct("bucket", "top")).over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    after = stored(
        heads.select("bucket", F.coalesce(F.lead(F.struct("bucket", "top")).over(turn), first).alias("to")).select(
            "bucket", F.col("to.bucket").alias("to_bucket"), F.col("to.top.id").alias("to_id"), F.bitwise_not(F.col("to.top.tie")).alias("to_tie")
        ),
        "ranges",
    )
    starts = (
        after.alias("a")
        .join(
            plain.alias("r"),
            (F.col("a.to_bucket") == F.col("r.bucket")) & (F.col("a.to_id") == F.coalesce("r.id", F.lit(0))) & (F.col("a.to_tie") == F.col("r.tie")),
        )
        .select("a.bucket", F.col("r.text").alias("start_text"))
        .dropDuplicates(["bucket"])
    )
    starts = with_parts(starts, "start_text", held, "start_own")
    order = W.partitionBy("bucket").orderBy(F.col("id").desc_nulls_last(), "tie")
    with_next = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("next_own", F.lead("own").over(order))
    filled = with_next.join(starts, "bucket", "left").select(
        "id", "text", "n", "own", F.coalesce("next_text", "start_text").alias("next_text"), F.coalesce("next_own", "start_own").alias("next_own")
    )
    half = (F.col("n") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n") - half), F.substring("next_text", F.lit(1), half))
    done = with_parts(filled.withColumn("edited", edited), "edited", held, "edited_own")
    return done.select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string(F.col("own")).alias("fingerprint"),
        as_string(F.col("edited_own")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
