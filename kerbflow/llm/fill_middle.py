"""Fill-in-the-middle rewriting of documents by piece tables.

A document is a list of descriptors ``(buffer, start, length)`` over bytes that never change:
the text, and the sentinels.  Cutting splits descriptors, an arrangement puts them in
another order, the inverse arrangement restores the text, and hashes read the bytes the
descriptors name one after the other.  Bytes are copied once, when an output is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

PLAIN, PSM, SPM = "plain", "psm", "spm"
TEXT, SENTINELS = 0, 1  # buffers
# Fixed by contract: the sentinels, and the order of prefix, middle, suffix in each form.
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
PARTS = ("prefix", "middle", "suffix")
ORDERS = {PSM: ("prefix", "suffix", "middle"), SPM: ("suffix", "prefix", "middle")}
SENTINEL_BYTES = b"".join(MARKS.values())
PIECE_TYPE = StructType().add("buffer", LongType()).add("start", LongType()).add("length", LongType())


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


@dataclass(frozen=True)
class Choice:
    """How documents are cut: seed, per cent that are rewritten, and per cent of those as spm."""

    seed: int = 7
    rewritten: int = 100
    spm: int = 50

    def draws(self, doc_id: object) -> list[int]:
        """Four numbers that depend on seed and id alone; a null id counts as an empty one."""
        key = f"{self.seed}:{'' if doc_id is None else doc_id}"
        digest = hashlib.sha256(key.encode()).digest()
        return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def cut(pieces: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The descriptors before and after a byte position; one that spans it is split."""
    before, after = [], []
    for piece in pieces:
        if piece.length <= at:
            before.append(piece)
        elif at <= 0:
            after.append(piece)
        else:
            before.append(Piece(piece.buffer, piece.start, at))
            after.append(Piece(piece.buffer, piece.start + at, piece.length - at))
        at -= min(piece.length, max(at, 0))
    return before, after


def sentinel(part: str) -> list[Piece]:
    return [Piece(SENTINELS, SENTINEL_BYTES.index(MARKS[part]), len(MARKS[part]))]


def arrange(parts: dict[str, list[Piece]], form: str) -> list[Piece]:
    """The parts' descriptors in the order of the form, each behind its sentinel."""
    return [piece for part in ORDERS[form] for piece in sentinel(part) + parts[part]]


def taken_apart(output: bytes, form: str) -> dict[str, list[Piece]]:
    """The parts of an output, as descriptors over it.

    No part holds a sentinel, and none can arise where parts meet, so the first one of each
    kind is the one that was put there.
    """
    places = [output.index(MARKS[part]) for part in ORDERS[form]] + [len(output)]
    starts = [at + len(MARKS[part]) for at, part in zip(places, ORDERS[form])]
    return {p: [Piece(TEXT, a, b - a)] for p, a, b in zip(ORDERS[form], starts, places[1:])}


def restored_pieces(output: bytes, form: str) -> list[Piece]:
    """The text an output was made of, as descriptors over the output."""
    if form == PLAIN:
        return [Piece(TEXT, 0, len(output))]
    parts = taken_apart(output, form)
    return [piece for part in PARTS for piece in parts[part]]


def chunks(pieces: Iterable[Piece], text: memoryview) -> Iterator[memoryview]:
    """The bytes the descriptors name, without copying them."""
    buffers = (text, memoryview(SENTINEL_BYTES))
    for buffer, start, length in pieces:
        yield buffers[buffer][start : start + length]


def sha256_of(pieces: Iterable[Piece], text: memoryview) -> str:
    digest = hashlib.sha256()
    for chunk in chunks(pieces, text):
        digest.update(chunk)
    return digest.hexdigest()


class _Texts:
    """The bytes of a column of texts, with line ends and letters counted at once."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column.cast(pa.large_string()), "")
        buffers = column.buffers()
        offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        self.bytes = memoryview(buffers[2] if buffers[2] is not None else b"")
        letters = np.frombuffer(self.bytes, dtype=np.uint8)
        self.bounds = offsets.tolist()
        self.line_ends = np.flatnonzero(letters == ord("\n")) + 1
        self.lines_before = np.searchsorted(self.line_ends, offsets, side="right").tolist()
        # A letter starts at each byte that does not carry one on.
        self.later_bytes = np.flatnonzero((letters & 0xC0) == 0x80)

    def text(self, k: int) -> memoryview:
        return self.bytes[self.bounds[k] : self.bounds[k + 1]]

    def lines(self, k: int) -> int:
        """The line ends, and a last line without one."""
        ends = self.lines_before[k + 1] - self.lines_before[k]
        size = self.bounds[k + 1] - self.bounds[k]
        return ends + (size > 0 and self.bytes[self.bounds[k + 1] - 1] != ord("\n"))

    def line_start(self, k: int, line: int) -> int:
        """Where in its text a line starts; the one after the last starts at the text's end."""
        if line == 0:
            return 0
        at = self.lines_before[k] + line - 1
        end = int(self.line_ends[at]) if at < self.lines_before[k + 1] else self.bounds[k + 1]
        return end - self.bounds[k]

    def letters(self, k: int, start: int, length: int) -> int:
        a = self.bounds[k] + start
        later = np.searchsorted(self.later_bytes, [a, a + length])
        return length - int(later[1] - later[0])


def _rewritten(texts: _Texts, k: int, doc_id: object, choice: Choice) -> tuple:
    text = texts.text(k)
    n = texts.lines(k)
    pieces = [Piece(TEXT, 0, len(text))] if len(text) else []
    h1, h2, h3, h4 = choice.draws(doc_id)
    held = bytes(text)
    if not held or any(mark in held for mark in MARKS.values()) or h3 % 100 >= choice.rewritten:
        return n, PLAIN, None, None, pieces
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = texts.line_start(k, first), texts.line_start(k, second)
    head, suffix = cut(pieces, b)
    prefix, middle = cut(head, a)
    form = SPM if h4 % 100 < choice.spm else PSM
    arranged = arrange({"prefix": prefix, "middle": middle, "suffix": suffix}, form)
    return n, form, texts.letters(k, 0, a), texts.letters(k, a, b - a), arranged


def fill_in_middle(df: DataFrame, choice: Choice = Choice(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with a part of its lines moved behind the rest, between sentinels.

    Returns ``id_col``, ``n`` (lines), ``form`` (plain, psm, spm), ``prefix_chars`` and
    ``middle_chars`` (code points; null if plain), ``pieces`` (the descriptors; buffer 0 is
    the text's UTF-8 bytes, 1 is ``<P><S><M>``), ``output`` and ``output_sha256``.  Where a
    text is cut depends on its id and the choice alone, so rows of one id and text are cut
    alike, and reruns agree; a null id counts as an empty one.  Null and empty texts give
    the form plain, no lines and no descriptors, and so does, with its lines, any text that
    holds a sentinel.  Texts are read whole; other columns are left out, so their names
    cannot clash; an empty table gives none.  Nothing is shuffled.
    """
    schema = StructType([df.schema[id_col]]).add("n", LongType()).add("form", StringType())
    schema = schema.add("prefix_chars", LongType()).add("middle_chars", LongType())
    schema = schema.add("pieces", ArrayType(PIECE_TYPE)).add("output", StringType()).add("output_sha256", StringType())
    piece_type = pa.list_(pa.struct([(name, pa.int64()) for name in Piece._fields]))

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _Texts(batch.column(1))
            found = [_rewritten(texts, k, doc_id, choice) for k, doc_id in enumerate(batch.column(0).to_pylist())]
            n, forms, prefix, middle, pieces = zip(*found) if found else ((),) * 5
            outputs = [b"".join(chunks(p, texts.text(k))) for k, p in enumerate(pieces)]
            digests = [sha256_of(p, texts.text(k)) for k, p in enumerate(pieces)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(forms, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array([[x._asdict() for x in p] for p in pieces], piece_type),
                    pa.array(outputs, pa.binary()).view(pa.string()),
                    pa.array(digests, pa.string()),
                ],
                names=schema.names,
            )

    return df.select(id_col, text_col).mapInArrow(rewritten, schema)


def restore_text(df: DataFrame, form_col: str = "form", output_col: str = "output") -> DataFrame:
    """The text each output was made of, from output and form alone.

    Adds ``restored`` and ``restored_sha256`` in place of columns of these names.  A null
    output counts as an empty one, a null form as plain.  An output that lacks a sentinel
    of its form is an error.
    """
    kept = df.drop(*[c for c in df.columns if c.lower() in ("restored", "restored_sha256")])
    schema = StructType([*kept.schema.fields]).add("restored", StringType()).add("restored_sha256", StringType())
    form_at, output_at = kept.columns.index(form_col), kept.columns.index(output_col)

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outputs = pc.fill_null(batch.column(output_at).cast(pa.binary()), b"").to_pylist()
            forms = pc.fill_null(batch.column(form_at), PLAIN).to_pylist()
            pieces = [restored_pieces(output, form) for output, form in zip(outputs, forms)]
            texts = [b"".join(chunks(p, memoryview(x))) for p, x in zip(pieces, outputs)]
            digests = [sha256_of(p, memoryview(x)) for p, x in zip(pieces, outputs)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary()).view(pa.string()), pa.array(digests, pa.string())], names=schema.names
            )

    return kept.mapInArrow(restored, schema)
