"""Byte-pair encoding of whole texts over a trie of their distinct words, and decoding.

Encoding a word by merges gives, for each of its prefixes, one last token; the tokens
before that one are the encoding of the shorter prefix it leaves.  So one token per prefix
says everything: distinct words go into a trie, a depth-first pass gives each node its last
token from the nodes above it, and words that share a prefix share the work.  A token can
end a prefix if no merge would cross from the token before it.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from kerbflow.llm.tokens import _byte_letters

SLICE_BYTES = 2_000_000  # text worked on at once in a task
CACHE_WORDS = 200_000  # words a worker remembers
CACHE_PAIRS = 500_000  # neighbouring tokens it remembers as parting or merging
# Fixed by the tokenizer's file format: how its byte-level splitter parts a text into words.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteVocabulary:
    """Tokens and merges of a byte-level tokenizer file.

    Tokens are numbered in the order in which merges make them, single bytes first.
    ``ids[n]`` is the file's id of token ``n``.  Files whose merges make one token twice, or
    whose added tokens take blanks or word bounds into account, are refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {letter: byte for byte, letter in _byte_letters().items()}
        vocabulary = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that depend on their surroundings are not supported")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.number: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        self.ids = [vocabulary[letter] for _, letter in sorted(_byte_letters().items())]
        self.parts: list[tuple[int, int]] = [(-1, -1)] * 256
        self.merged: dict[tuple[int, int], int] = {}
        for left, right in merges:
            a, b = (self.number[bytes(map(byte_of.__getitem__, x))] for x in (left, right))
            token = bytes(map(byte_of.__getitem__, left + right))
            if token in self.number:
                raise ValueError(f"two merges make the token {token!r}")
            self.number[token] = self.merged[a, b] = len(self.ids)
            self.parts.append((a, b))
            self.ids.append(vocabulary[left + right])
        self.sizes = [len(token) for token in self.number]
        # Finds all tokens that end at each place of a word, bytes read as letters.
        self.endings = ahocorasick.Automaton()
        for token, n in self.number.items():
            self.endings.add_word(token.decode("latin-1"), n)
        self.endings.make_automaton()

    def bytes_by_id(self) -> dict[int, bytes]:
        known = {self.ids[n]: token for token, n in self.number.items()}
        return known | {at: content.encode() for content, at in self.added.items()}


class TrieEncoder:
    """Ids of words, each shared prefix worked out once."""

    def __init__(self, vocabulary: ByteVocabulary):
        self.vocabulary = vocabulary
        self.parting: dict[tuple[int, int], bool] = {}

    def _parts(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens stay apart.

        The merges that made them are undone, latest first, each time asking whether the
        tokens then at the border would have merged before.  Of equal merges the left one
        comes first.
        """
        merged, parts = self.vocabulary.merged, self.vocabulary.parts
        before = len(parts)
        while True:
            if merged.get((left, right), before) < before:
                return False
            if left > right:
                before, left = left, parts[left][1]
                if left < 0:
                    return True
            else:
                before, right = right + 1, parts[right][0]
                if right < 0:
                    return True

    def _stays(self, left: int, right: int) -> bool:
        if len(self.parting) >= CACHE_PAIRS:
            self.parting.clear()
        found = self.parting[left, right] = self._parts(left, right)
        return found

    def encode(self, words: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Each distinct word with its ids, in the order of the words' bytes."""
        sizes, ids, endings = self.vocabulary.sizes, self.vocabulary.ids, self.vocabulary.endings.iter
        parting, stays = self.parting, self._stays
        last = [0]  # by depth: the last token of the path's prefix
        for word, shared in trie(words):
            del last[shared + 1 :]
            depth = shared  # how far the path's last tokens are known
            for at, token in endings(word.decode("latin-1")):
                if at < depth:
                    continue
                start = at + 1 - sizes[token]
                if start:
                    before = last[start]
                    stay = parting.get((before, token))
                    if stay is None:
                        stay = stays(before, token)
                    if not stay:
                        continue
                last.append(token)
                depth += 1
            found, at = [], len(word)
            while at:
                token = last[at]
                found.append(ids[token])
                at -= sizes[token]
            yield word, found[::-1]


def trie(words: list[bytes]) -> Iterator[tuple[bytes, int]]:
    """The trie of some words, its branches in depth-first order.

    Sorted words are inserted one by one.  A word's branch is its path from the root; it
    shares the nodes above the depth given with the branch before, and those below are new.
    """
    before = b""
    for word in sorted(set(words) - {b""}):
        yield word, len(os.path.commonprefix((before, word)))
        before = word


class TextEncoder:
    """Ids of texts, as the ``tokenizers`` library gives them without special tokens added.

    ``added_as_text`` reads the strings of added tokens as plain text.  Words are kept for
    later texts of the worker, up to ``CACHE_WORDS``.
    """

    def __init__(self, path: str, added_as_text: bool = False):
        from tokenizers import Tokenizer

        self.vocabulary = ByteVocabulary(path)
        self.words = TrieEncoder(self.vocabulary)
        self.split = regex.compile(WORD_SPLIT).findall
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.settled: dict[str, bool] = {}
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.sizes = array("i"), array("q"), array("q")
        self.added = None
        if self.vocabulary.added and not added_as_text:
            contents = sorted(self.vocabulary.added, key=len, reverse=True)
            self.added = regex.compile("(" + "|".join(map(regex.escape, contents)) + ")")
            for content, at in self.vocabulary.added.items():
                self._add(content, [at])

    def _add(self, word: str, ids: list[int]) -> None:
        self.known[word] = len(self.starts)
        self.starts.append(len(self.ids))
        self.sizes.append(len(ids))
        self.ids.extend(ids)

    def _unsettled(self, text: str) -> bool:
        """Whether a letter of the text is of another kind to the library than to ``regex``.

        Their tables of letters can be of different age.  Each letter is tried once.
        """
        odd = False
        for letter in set(text):
            known = self.settled.get(letter)
            if known is None:
                probe = f"a{letter}1{letter}!{letter}  {letter}"
                theirs = [b - a for _, (a, b) in self.library.pre_tokenize_str(probe)]
                known = self.settled[letter] = theirs == [len(w) for w in self.split(probe)]
            odd |= not known
        return odd

    def _plain_words(self, text: str) -> list[str]:
        if not text.isascii() and self._unsettled(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return self.split(text)

    def _words(self, text: str) -> list[str]:
        if self.added is None or not self.added.search(text):
            return self._plain_words(text)
        parts = self.added.split(text)
        return list(chain.from_iterable([p] if k % 2 else self._plain_words(p) for k, p in enumerate(parts)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        words, bounds = [], [0]
        for text in texts:
            words += self._words(text)
            bounds.append(len(words))
        known = self.known
        before, used = len(self.starts), len(self.ids)
        fresh = {w.encode(): w for w in set(words) if w not in known}
        for word, ids in self.words.encode(list(fresh)):
            self._add(fresh[word], ids)
        if not words:
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        place = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
        # Views, not copies: the arrays hold all words the worker remembers.
        found, ends = taken(np.frombuffer(self.ids, np.int32), np.frombuffer(self.starts, np.int64), np.frombuffer(self.sizes, np.int64), place)
        if before > CACHE_WORDS:
            for word in list(islice(reversed(known), len(known) - before)):
                del known[word]
            del self.starts[before:], self.sizes[before:], self.ids[used:]
        return found, np.diff(ends[bounds])


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most so many bytes of text, or of one longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        yield at, to
        at = to


def taken(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` at some places one after the other, and where each one ends (from 0)."""
    size = sizes[place]
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(starts[place] - ends[:-1], size) + np.arange(ends[-1])
    return values[at], ends


_ENCODERS: dict[tuple[str, bool], TextEncoder] = {}


def text_encoder(path: str, added_as_text: bool = False) -> TextEncoder:
    """The worker's encoder of a file, made once."""
    key = (path, added_as_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(path, added_as_text)
    return _ENCODERS[key]


def encode_texts(
    df: DataFrame, tokenizer_path: str, added_as_text: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Whole texts as ids of a byte-level tokenizer file.

    Returns ``id_col`` and ``ids`` (array of int), one row per row.  Null and empty texts
    have no ids; row ids may repeat or be null; other columns are left out, so their names
    cannot clash; an empty table gives none.  Texts of any length are read whole, about
    2 MB of text at once.  Strings of added tokens become those tokens, as the library does it, or
    with ``added_as_text`` stay text.  Nothing is shuffled.
    """
    schema = StructType([df.schema[id_col]]).add("ids", ArrayType(IntegerType()))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer_path, added_as_text)
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.string()), "")
            for a, b in slices(texts):
                ids, sizes = encoder.encode(texts.slice(a, b - a).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=schema.names)

    return df.select(id_col, text_col).mapInArrow(encoded, schema)


class Decoder:
    """Texts of ids, as the ``tokenizers`` library gives them with special tokens kept.

    Bytes that are not UTF-8 become replacement characters; ids the file lacks are left out.
    """

    def __init__(self, path: str):
        by_id = ByteVocabulary(path).bytes_by_id()
        self.sizes = np.zeros(max(by_id) + 2, dtype=np.int64)
        for at, token in by_id.items():
            self.sizes[at] = len(token)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(by_id[at] for at in sorted(by_id)), dtype=np.uint8)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of the ids between neighbouring bounds."""
        none = len(self.sizes) - 1
        letters, ends = taken(self.letters, self.starts, self.sizes, np.where((ids >= 0) & (ids < none), ids, none))
        held, ends = letters.tobytes(), ends[bounds].tolist()
        return [held[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


_DECODERS: dict[str, Decoder] = {}


def _decoder(path: str) -> Decoder:
    if path not in _DECODERS:
        _DECODERS[path] = Decoder(path)
    return _DECODERS[path]


def decode_ids(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The text of each row's ids.

    Returns ``id_col``, ``ids_col`` and ``decoded``.  Null and empty lists give the empty
    text; null ids and ids the file lacks are left out; row ids may repeat or be null.
    """
    schema = StructType([df.schema[id_col], df.schema[ids_col]]).add("decoded", StringType())

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(tokenizer_path)
        for batch in batches:
            lists = batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ids = pc.fill_null(pc.list_flatten(lists), -1).to_numpy(zero_copy_only=False)
            texts = decoder.decode(ids, np.concatenate([[0], np.cumsum(sizes)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.string())], names=schema.names)

    return df.select(id_col, ids_col).mapInArrow(decoded, schema)
