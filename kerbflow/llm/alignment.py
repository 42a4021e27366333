"""Alignment of two tokenizers' tokens over the same bytes.

Tokens are where they end.  The ends of both tokenizers are merged by merge path: of every
``PIECE_STEPS`` steps of the merge a binary search on its diagonal finds where both lists
stand, so pieces of equal work are merged without knowing of each other, side by side.  A
piece tells which of its steps end a token of both; where a piece starts with an end that
the piece before has just taken from the other list, the two are stitched.  Shared ends cut
the tokens into groups, and each token of A is linked with each token of B in its group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from kerbflow.llm.bpe_trie import WORD_SPLIT, ByteVocabulary, slices
from kerbflow.llm.common import stored

PIECE_STEPS = 64  # steps of the merge in one piece
LINKS_AT_ONCE = 1_000_000  # links spread out at once in a task
TEXTS_AT_ONCE = 16  # texts whose ids lie in Python lists at once
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Tokens:
    """Ids of texts by both tokenizers, and each id's bytes."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding

        vocabulary = ByteVocabulary(path_a)
        # Reads the strings of added tokens as plain text, and numbers tokens as merges do.
        self.a = Encoding("a", pat_str=WORD_SPLIT, mergeable_ranks=vocabulary.number, special_tokens={})
        self.ids_a = np.array(vocabulary.ids, dtype=np.int32)
        self.b = SentencePieceProcessor(model_file=path_b)
        by_id = vocabulary.bytes_by_id()
        self.bytes_a = [by_id.get(at, b"") for at in range(max(by_id) + 1)]
        self.bytes_b = [self._piece(at) for at in range(self.b.get_piece_size())]
        self.sizes_a, self.sizes_b = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.bytes_a, self.bytes_b))
        # Each id in decimals with each mark that can follow it.
        self.digits_a = [f"{at}{mark}" for mark in ",|" for at in range(len(self.bytes_a))]
        self.digits_b = [f"{at}{mark}" for mark in ",;" for at in range(len(self.bytes_b))]

    def _piece(self, at: int) -> bytes:
        piece = self.b.id_to_piece(at)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(at) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Both arrays of ids of each text; none where they are not of a space and the text.

        Tokens of A always join to what was read; the model of B may change a text.
        """
        none = self.ids_a[:0]
        out = []
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            some = texts[at : at + TEXTS_AT_ONCE]
            for text, b in zip(some, self.b.encode(some, num_threads=1)):
                spaced = " " + text
                if text and b"".join(map(self.bytes_b.__getitem__, b)) == spaced.encode():
                    out.append((self.ids_a[self.a.encode_to_numpy(spaced)], np.array(b, dtype=np.int32)))
                else:
                    out.append((none, none))
        return out


_TOKENS: dict[tuple[str, str], Tokens] = {}


def _tokens(path_a: str, path_b: str) -> Tokens:
    if (path_a, path_b) not in _TOKENS:
        _TOKENS[path_a, path_b] = Tokens(path_a, path_b)
    return _TOKENS[path_a, path_b]


def split_on_diagonals(a: np.ndarray, b: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """How many of the first ``steps`` values of the merge come from ``a``, by binary search.

    Of equal values that of ``a`` comes first.
    """
    low, high = np.maximum(steps - len(b), 0), np.minimum(steps, len(a))
    while (searching := low < high).any():
        middle = (low + high) // 2
        i, j = np.minimum(middle, len(a) - 1), np.clip(steps - 1 - middle, 0, len(b) - 1)
        more = searching & (a[i] <= b[j])
        low, high = np.where(more, middle + 1, low), np.where(searching & ~more, middle, high)
    return low


def shared_ends(a: np.ndarray, b: np.ndarray, piece_steps: int = PIECE_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """How many values of ``a`` and of ``b`` there are up to each value that both hold.

    Both lists must rise.  Pieces are merged side by side, one step of all of them at a time.
    """
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    bounds = np.minimum(np.arange(-(-total // piece_steps) + 1) * piece_steps, total)
    from_a = split_on_diagonals(a, b, bounds)
    i, j, ends_a = from_a[:-1].copy(), bounds[:-1] - from_a[:-1], from_a[1:]
    ends_b = bounds[1:] - ends_a
    pieces = len(i)
    taken_a = np.zeros((pieces, piece_steps), dtype=np.int64)
    shared = np.zeros((pieces, piece_steps), dtype=bool)
    endless = np.iinfo(np.int64).max
    just_a = np.full(pieces, -1, dtype=np.int64)  # what the piece's last step took from a
    first_b = np.full(pieces, -1, dtype=np.int64)  # what its first step took from b
    for step in range(piece_steps):
        value_a = np.where(i < ends_a, a[np.minimum(i, len(a) - 1)], endless)
        value_b = np.where(j < ends_b, b[np.minimum(j, len(b) - 1)], endless)
        left = np.minimum(value_a, value_b) < endless
        is_a = left & (value_a <= value_b)
        is_b = left & ~is_a
        shared[:, step] = is_b & (value_b == just_a)
        if step == 0:
            first_b = np.where(is_b, value_b, first_b)
        just_a = np.where(is_a, value_a, np.where(left, -1, just_a))
        i, j = i + is_a, j + is_b
        taken_a[:, step] = i
    shared[1:, 0] |= (first_b[1:] >= 0) & (first_b[1:] == just_a[:-1])
    piece, step = np.nonzero(shared)
    found_a = taken_a[piece, step]
    return found_a, bounds[piece] + step + 1 - found_a


class Aligned:
    """Texts of a slice with their tokens, groups and links.

    All texts lie one after the other, so one merge serves them; a text's last byte ends a
    token of both, so no group crosses texts.
    """

    def __init__(self, tokens: Tokens, texts: list[str]):
        encoded = tokens.encode(texts)
        self.tokens = tokens
        self.n_a, self.n_b = (np.array([len(x[side]) for x in encoded], dtype=np.int64) for side in (0, 1))
        self.a, self.b = (np.concatenate([x[side] for x in encoded]).astype(np.int64) for side in (0, 1))
        self.to_a, self.to_b = shared_ends(np.cumsum(tokens.sizes_a[self.a]), np.cumsum(tokens.sizes_b[self.b]))
        self.group_a, self.group_b = (np.diff(x, prepend=0) for x in (self.to_a, self.to_b))
        self.groups = np.concatenate([[0], np.searchsorted(self.to_a, np.cumsum(self.n_a), side="right")])
        self.links = np.concatenate([[0], np.cumsum(self.group_a * self.group_b)])

    def texts_of_groups(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        shift_a, shift_b = self.to_b - self.group_b, self.to_a
        order_a = np.arange(len(self.a)) + np.repeat(shift_a, self.group_a)
        order_b = np.arange(len(self.b)) + np.repeat(shift_b, self.group_b)
        last_a, last_b = np.zeros(len(self.a), dtype=bool), np.zeros(len(self.b), dtype=bool)
        last_a[self.to_a - 1] = last_b[self.to_b - 1] = True
        codes = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        codes[order_a] = self.a + last_a * len(self.tokens.bytes_a)
        codes[order_b] = self.b + last_b * len(self.tokens.bytes_b) + len(self.tokens.digits_a)
        digits = self.tokens.digits_a + self.tokens.digits_b
        listed = [digits[code] for code in codes.tolist()]
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(listed[x:y])[:-1] for x, y in zip([0, *ends], ends)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text and id pair it holds linked: text, pair and number of links, in this order.

        Links are spread out ``LINKS_AT_ONCE`` at a time.  A pair is ``a * ids of b + b``.
        """
        width = len(self.tokens.bytes_b)
        span = width * len(self.tokens.bytes_a)
        start_a, start_b = self.to_a - self.group_a, self.to_b - self.group_b
        text_of = np.repeat(np.arange(len(self.n_a)), np.diff(self.groups))
        keys, links = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for low in range(0, int(self.links[-1]), LINKS_AT_ONCE):
            link = np.arange(low, min(low + LINKS_AT_ONCE, int(self.links[-1])))
            group = np.searchsorted(self.links, link, side="right") - 1
            within = link - self.links[group]
            a = self.a[start_a[group] + within // self.group_b[group]]
            b = self.b[start_b[group] + within % self.group_b[group]]
            for found, to in zip(np.unique(text_of[group] * span + a * width + b, return_counts=True), (keys, links)):
                to.append(found)
        key, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(key), dtype=np.int64)
        np.add.at(total, place, np.concatenate(links))
        return key // span, key % span, total


def align_tokens(
    df: DataFrame, path_a: str, path_b: str, digest: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Groups of tokens of a byte-level file (A) and a sentencepiece model (B) that cover the same bytes.

    Returns ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum`` and ``groups`` (``a1,a2|b1;a3|b2,b3``), one row per row.  A reads a space
    and the text, B the text.  Of two ids, the count is the number of rows that hold them
    linked; ``n_best`` are the links whose count is the highest of their A id (ties
    included), ``count_sum`` adds the counts of all links.  Null and empty texts, and those
    whose tokens do not join to a space and the text, have no tokens: zeros and the empty
    ``groups``.  With ``digest`` the column is ``groups_sha256`` (empty if ``groups`` is):
    listed ids are several times as long as the text, and are then never written.  Each row counts for itself, also where ids repeat or are null; other
    columns are left out, so their names cannot clash; an empty table gives none.

    Tasks read texts in slices of about 2 MB (longer texts are read whole) and count each
    slice's pairs before they are shuffled, so a pair that all rows hold makes one row per
    slice.  Counts go back to slices, not to rows.  Aligned slices are written under the
    shared folder first, so that slice numbers stay as they are when tasks run again.
    """
    aligned = stored(_aligned(df.select(id_col, text_col), path_a, path_b, digest), "aligned")
    pairs = aligned.where("pairs is not null").select("slice", F.posexplode(F.arrays_zip("pairs", "rows")))
    pairs = pairs.select(F.col("slice").alias("of"), F.col("pos").alias("at"), F.col("col.pairs").alias("pair"), F.col("col.rows").alias("rows"))
    width = _b_ids(path_b)
    counts = pairs.groupBy("pair").agg(F.sum("rows").alias("count"))
    best = F.max("count").over(Window.partitionBy(F.expr(f"pair div {width}L")))
    counts = counts.withColumn("best", F.col("count") == best)
    back = pairs.select("of", "at", "pair").join(counts, "pair").select("of", "at", "count", "best")
    digests = aligned.drop("pairs", "rows")
    groups = "groups_sha256" if digest else "groups"
    schema = StructType([df.schema[id_col], *[aligned.schema[c] for c in COUNTS]])
    schema = schema.add("n_best", LongType()).add("count_sum", LongType()).add(aligned.schema[groups])

    def counted(docs: pa.Table, found: pa.Table) -> pa.Table:
        at = found["at"].to_numpy()
        count, is_best = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        count[at], is_best[at] = found["count"].to_numpy(), found["best"].to_numpy()
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(docs["places"]).to_numpy())])
        places, links = (docs[c].combine_chunks().flatten().to_numpy() for c in ("places", "links"))
        totals = [np.concatenate([[0], np.cumsum(links * x[places])])[ends] for x in (is_best, count)]
        columns = [docs[c] for c in (id_col, *COUNTS)] + [pa.array(np.diff(x)) for x in totals] + [docs[groups]]
        return pa.table(columns, names=schema.names)

    return digests.groupBy("slice").cogroup(back.groupBy("of")).applyInArrow(counted, schema)


def _b_ids(path_b: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path_b).get_piece_size()


def _aligned(df: DataFrame, path_a: str, path_b: str, digest: bool) -> DataFrame:
    """Aligned rows, slice by slice.

    ``pairs`` and ``rows``, on the first row of a slice, list the id pairs of the slice and
    how many of its rows hold them; ``places`` and ``links`` say which of these pairs a row
    holds, and how often.
    """
    id_col = df.columns[0]
    schema = StructType([df.schema[id_col]]).add("slice", LongType())
    for name in COUNTS:
        schema = schema.add(name, LongType())
    schema = schema.add("groups_sha256" if digest else "groups", StringType())
    schema = schema.add("places", ArrayType(IntegerType())).add("links", ArrayType(LongType()))
    schema = schema.add("pairs", ArrayType(LongType())).add("rows", ArrayType(IntegerType()))

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.string()), "")
            for low, high in slices(texts):
                found = Aligned(tokens, texts.slice(low, high - low).to_pylist())
                text, pair, links = found.pairs()
                groups = found.texts_of_groups()
                if digest:
                    groups = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in groups]
                pairs, places, rows = np.unique(pair, return_inverse=True, return_counts=True)
                ends = np.searchsorted(text, np.arange(high - low + 1)).astype(np.int32)
                first = [True] + [False] * (high - low - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(np.full(high - low, number)),
                        pa.array(found.n_a),
                        pa.array(found.n_b),
                        pa.array(np.diff(found.groups)),
                        pa.array(np.diff(found.links[found.groups])),
                        pa.array(groups, pa.string()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(places.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(links)),
                        pa.array([pairs if x else None for x in first], pa.list_(pa.int64())),
                        pa.array([rows.astype(np.int32) if x else None for x in first], pa.list_(pa.int32())),
                    ],
                    names=schema.names,
                )
                number += 1

    return df.mapInArrow(aligned, schema)
