"""Token ids of whole texts with a public tokenizer file, and pieces of bounded length."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructType

from kerbflow.llm.common import lean

OUTPUTS = ("piece", "start", "length", "ids")
SLICE_BYTES = 4_000_000  # text worked on at once in a task
CACHE_ENTRIES = 300_000  # chunks, and pre-tokens, that a worker remembers
# Latin-1 letters, which are their own normal form, and then a run of ASCII punctuation.
PLAIN_CHUNK = r"^(?P<stem>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-/:-@\[-`{-~]*)$"


def _picked(ids: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the strings at the places ``at`` of a table, in a row, and how many each has."""
    own = sizes[at]
    ends = np.cumsum(own)
    total = int(ends[-1]) if len(ends) else 0
    first = np.cumsum(sizes) - sizes
    return ids[np.repeat(first[at] - (ends - own), own) + np.arange(total)], own


class _Known:
    """Ids of the strings met so far, up to ``CACHE_ENTRIES`` of them, as Arrow and flat arrays."""

    def __init__(self):
        self.words = pa.array([], pa.string())
        self.ids = np.empty(0, np.uint32)
        self.sizes = np.empty(0, np.int64)

    def table(self, words: pa.Array, learn: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids in a row, how many each string has, and the places of the given distinct strings."""
        found = pc.index_in(words, value_set=self.words)
        missing = found.is_null().to_numpy(zero_copy_only=False)
        at = found.fill_null(0).to_numpy().astype(np.int64)
        if not missing.any():
            return self.ids, self.sizes, at
        fresh = words.filter(pa.array(missing))
        at[missing] = len(self.words) + np.arange(len(fresh))
        fresh_ids, fresh_sizes = learn(fresh)
        ids, sizes = np.concatenate([self.ids, fresh_ids]), np.concatenate([self.sizes, fresh_sizes])
        if len(self.words) <= CACHE_ENTRIES:
            self.words, self.ids, self.sizes = pa.concat_arrays([self.words, fresh]), ids, sizes
        return ids, sizes, at


def _flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes


class ChunkEncoder:
    """Ids of texts, chunk by chunk.

    The tokenizer must never join text across blanks, and must lower-case and split words
    from punctuation, as ``word_bpe_49k`` does: then a text's ids are those of its
    blank-separated chunks one after the other, and a plain chunk's those of its lower-cased
    letters and of its punctuation.  Each distinct chunk, and each distinct part of plain
    ones, is encoded once and its ids are kept for later texts of the worker, up to
    ``CACHE_ENTRIES`` each; later ones are encoded once for each slice they are met in.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        letters = _byte_letters()
        self.letters = "".join(letters[b] for b in range(256))
        self.chunks, self.parts = _Known(), _Known()

    def _part_ids(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, which need no normalising any more."""
        tokenize, letters = self.model.tokenize, self.letters
        words = (p if p.isascii() else p.encode().decode("latin-1").translate(letters) for p in parts.to_pylist())
        return _flat([[t.id for t in tokenize(w)] if w else [] for w in words])

    def _chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.extract_regex(chunks, PLAIN_CHUNK)
        plain = split.is_valid().to_numpy(zero_copy_only=False)
        stems, tails = split.filter(split.is_valid()).flatten()
        coded = pa.concat_arrays([pc.utf8_lower(stems), tails]).dictionary_encode()
        ids, sizes, at = self.parts.table(coded.dictionary, self._part_ids)
        ids, sizes = _picked(ids, sizes, at[coded.indices.to_numpy()].reshape(2, -1).T.ravel())
        others = chunks.filter(pa.array(~plain)).to_pylist()
        other_ids, other_sizes = _flat([e.ids for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)])
        place = np.empty(len(chunks), dtype=np.int64)
        place[plain] = np.arange(len(stems))
        place[~plain] = len(stems) + np.arange(len(others))
        return _picked(np.concatenate([ids, other_ids]), np.concatenate([sizes.reshape(-1, 2).sum(axis=1), other_sizes]), place)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        chunks = pc.ascii_split_whitespace(texts)
        bounds = chunks.offsets.to_numpy().astype(np.int64)
        coded = chunks.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        ids, sizes, at = self.chunks.table(coded.dictionary, self._chunk_ids)
        found, own = _picked(ids, sizes, at[coded.indices.to_numpy()])
        per_text = np.concatenate([[0], np.cumsum(own)])[bounds - bounds[0]]
        return found, np.diff(per_text)


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(path: str) -> ChunkEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def _with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> np.ndarray:
    out = np.full(len(ids) + len(sizes), end_id, dtype="<u4")
    keep = np.ones(len(out), dtype=bool)
    keep[np.cumsum(sizes + 1) - 1] = False
    out[keep] = ids
    return out


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``SLICE_BYTES`` of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield at, to
        at = to


def token_pieces(
    df: DataFrame, tokenizer_path: str, max_length: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each document's ids and ``end_id``, cut into pieces of ``max_length`` where longer.

    Returns ``id_col``, ``piece`` (from 0), ``start``, ``length`` and ``ids`` (little-endian
    unsigned 32-bit).  Null and blank texts have the one id ``end_id``; ids may repeat or be
    null; an empty table gives none.  Nothing is shuffled.
    """
    schema = StructType([df.schema[id_col]])
    schema = schema.add("piece", IntegerType()).add("start", LongType()).add("length", LongType()).add("ids", BinaryType())

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.string()), "")
            for a, b in _slices(texts):
                ids, sizes = encoder.encode(texts.slice(a, b - a))
                held = memoryview(_with_end(ids, sizes, end_id).tobytes())
                sizes = sizes + 1
                pieces = -(-sizes // max_length)
                doc = np.repeat(np.arange(b - a), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * max_length
                length = np.minimum(sizes[doc] - start, max_length)
                at = 4 * ((np.cumsum(sizes) - sizes)[doc] + start)
                data = [bytes(held[x : x + 4 * n]) for x, n in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(doc)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(data, pa.binary()),
                    ],
                    names=schema.names,
                )

    return df.select(id_col, text_col).mapInArrow(cut, schema)
