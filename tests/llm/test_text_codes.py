"""Trie encoding, token alignment and fill-in-the-middle against plain definitions."""

from __future__ import annotations

import hashlib
import json
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from kerbflow.llm import alignment, queries
from kerbflow.llm.alignment import align_tokens, shared_ends, split_on_diagonals
from kerbflow.llm.bpe_trie import ByteVocabulary, Decoder, TextEncoder, TrieEncoder, decode_ids, encode_texts, trie
from kerbflow.llm.fill_middle import Choice, Piece, cut, fill_in_middle, restore_text
from kerbflow.llm.tokens import _byte_letters

BYTES, PIECES = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
LIBRARY, ENCODER = Tokenizer.from_file(BYTES), TextEncoder(BYTES)
LETTERS = {letter: byte for byte, letter in _byte_letters().items()}
SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, Ids string, N int, GROUPS string, Output string, restored string, slice int"
ODD = [
    None,
    "",
    " ",
    "\n",
    "\n\n\nend",
    "one line",
    "a\nb\nc\n",
    "<|endoftext|>",
    "x<|endoftext|><|endoftext|> y <|endoftext|>",
    "it's we'll  they've\t\tgone   ​ 　",
    "é́ 中文字符 😀😀 Привет мир 한국어",
    "ᶰ՘ newer letters \U00011db0\U0001df2b1՘",
    "has a ▁ piece mark",
    "holds <P> a mark\nand more",
    "no <S",
    "<<P\n>\n<M\nS>\n",
    "aaaa" * 700,
    "-" * 300 + " " * 90 + "\t" * 40,
    "word " * 4000,
    "\r\n line\r\nends\x0b\x0c\x1c\x85",
]


def random_texts(seed, count=60):
    rng = random.Random(seed)
    letters = "abcdefgh  \n'.,-0123éß中😀▁" + "the "
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 90))) for _ in range(count)]


@pytest.fixture(scope="module")
def docs(spark):
    texts = ODD + random_texts(4) + ["the same text", "the same text"]
    rows = [(None if k % 17 == 5 else k // 2 if k % 11 == 3 else k, t, "x", 1, "g", "o", "r", 2) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[:3], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_row(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# encoding over a trie


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


def test_a_trie_shares_prefixes():
    words = [b"abd", b"", b"ab", b"b", b"abc", b"ab"]
    assert list(trie(words)) == [(b"ab", 0), (b"abc", 2), (b"abd", 2), (b"b", 0)]
    assert list(trie([])) == []


def test_words_are_merged_as_the_merges_say():
    """Every word against merging its bytes, lowest rank first and leftmost of equals."""
    vocabulary = ByteVocabulary(BYTES)
    rng = random.Random(8)
    alphabet = [bytes([b]) for b in b" abcehinorst"] + ["é".encode(), "中".encode(), b"\xff"]
    words = [b"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 25))) for _ in range(3000)] + [b"a" * 400]
    for word, ids in TrieEncoder(vocabulary).encode(words):
        tokens = list(word)
        while True:
            ranks = [vocabulary.merged.get(pair, len(vocabulary.ids)) for pair in zip(tokens, tokens[1:])]
            if not ranks or min(ranks) == len(vocabulary.ids):
                break
            at = ranks.index(min(ranks))
            tokens[at : at + 2] = [ranks[at]]
        assert ids == [vocabulary.ids[t] for t in tokens]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_is_encoded_as_the_library_does(text):
    assert ENCODER.encode([text])[0].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_a_full_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr("kerbflow.llm.bpe_trie.CACHE_WORDS", 20)
    monkeypatch.setattr("kerbflow.llm.bpe_trie.CACHE_PAIRS", 5)
    encoder = TextEncoder(BYTES)
    for seed in range(6):
        texts = [t or "" for t in ODD] + random_texts(seed % 3)
        ids, sizes = encoder.encode(texts)
        found = np.split(ids, np.cumsum(sizes)[:-1])
        assert [f.tolist() for f in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert seed < 2 or len(encoder.known) == len(encoder.starts) == kept
        kept = len(encoder.known)


def test_added_tokens_can_be_plain_text(library):
    library.encode_special_tokens = True
    try:
        want = library.encode("x<|endoftext|>y", add_special_tokens=False).ids
    finally:
        library.encode_special_tokens = False
    assert TextEncoder(BYTES, added_as_text=True).encode(["x<|endoftext|>y"])[0].tolist() == want


def test_texts_are_encoded_and_decoded(docs, none, library):
    coded = encode_texts(docs, BYTES)
    assert coded.columns == ["doc_id", "ids"]
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    want = [(at, library.encode(text, add_special_tokens=False).ids) for at, text in texts]
    assert by_row(coded, "doc_id", "ids") == sorted(want, key=repr)
    back = decode_ids(coded, BYTES)
    assert back.columns == ["doc_id", "ids", "decoded"]
    assert by_row(back, "doc_id", "decoded") == sorted(texts, key=repr)
    assert decode_ids(encode_texts(none, BYTES), BYTES).collect() == []


def test_any_ids_are_decoded_as_the_library_does(spark, library):
    rng = random.Random(2)
    lists = [[rng.randrange(0, 50_400) for _ in range(rng.randrange(0, 12))] for _ in range(200)] + [[50256, 50257, 255, 50256]]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lists)] + [(-1, None), (-2, [None, 40])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in decode_ids(df, BYTES).collect()}
    assert all(got[k] == library.decode(x, skip_special_tokens=False) for k, x in enumerate(lists))
    assert got[-1] == "" and got[-2] == library.decode([40])


def test_files_that_the_method_cannot_read_are_refused(tmp_path):
    spec = '{"added_tokens": [], "model": {"vocab": {%s}, "merges": [["a", "b"], ["ab", "c"], ["b", "c"], ["a", "bc"]]}}'
    letters = [*LETTERS, "ab", "abc", "bc"]
    (tmp_path / "t.json").write_text(spec % ", ".join(f"{json.dumps(x)}: {k}" for k, x in enumerate(letters)))
    with pytest.raises(ValueError, match="two merges"):
        ByteVocabulary(str(tmp_path / "t.json"))
    assert len(Decoder(BYTES).sizes) == 50_258


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables absent")
def test_encoding_query_against_the_library(spark, library):
    want = []
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        texts = ",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in texts)))
    got = queries.op12_bpe_trie(spark, SF_DIR)
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert sorted(map(tuple, got.collect())) == sorted(want)


# alignment


@pytest.mark.parametrize("steps", [1, 2, 3, 64])
def test_pieces_of_the_merge_find_all_shared_ends(steps):
    rng = random.Random(steps)
    for _ in range(150):
        high = rng.randrange(1, 60)
        a, b = (sorted(rng.sample(range(1, high + 1), rng.randrange(0, high + 1))) for _ in range(2))
        found_a, found_b = shared_ends(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64), steps)
        both = sorted(set(a) & set(b))
        assert list(zip(found_a, found_b)) == [(a.index(x) + 1, b.index(x) + 1) for x in both]


def test_diagonals_part_the_merge():
    a, b = np.array([1, 3, 3, 5]), np.array([2, 3, 6])
    merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
    split = split_on_diagonals(a, b, np.arange(8))
    assert split.tolist() == [sum(side == 0 for _, side in merged[:k]) for k in range(8)]


def aligned_plainly(rows, library, pieces):
    """Rows of the operator from sets and loops."""
    groups_of, holders = [], Counter()
    for _, text in rows:
        held = " " + (text or "")
        a = library.encode(held, add_special_tokens=False)
        b = pieces.encode(text or "")
        bytes_a = [bytes(LETTERS[x] for x in token) for token in a.tokens]
        bytes_b = [bytes([int(pieces.id_to_piece(x)[3:5], 16)]) if pieces.is_byte(x) else pieces.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not text or b"".join(bytes_a) != held.encode() or b"".join(bytes_b) != held.encode():
            groups_of.append([])
            continue
        ends_a, ends_b = (np.cumsum(list(map(len, x))).tolist() for x in (bytes_a, bytes_b))
        cuts = [0] + sorted(set(ends_a) & set(ends_b))
        groups = [
            ([x for x, e in zip(a.ids, ends_a) if low < e <= high], [x for x, e in zip(b, ends_b) if low < e <= high])
            for low, high in zip(cuts, cuts[1:])
        ]
        groups_of.append(groups)
        holders.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    best = defaultdict(int)
    for (x, _), n in holders.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, _), groups in zip(rows, groups_of):
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        listed = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        counts = [holders[link] for link in links]
        n_best = sum(holders[x, y] == best[x] for x, y in links)
        out.append((doc_id, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), n_best, sum(counts), listed))
    return out


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@pytest.fixture
def plain_library(library):
    library.encode_special_tokens = True
    yield library
    library.encode_special_tokens = False


@pytest.mark.parametrize("links_at_once", [7, 1_000_000])
def test_groups_links_and_counts(docs, plain_library, monkeypatch, links_at_once):
    monkeypatch.setattr(alignment, "LINKS_AT_ONCE", links_at_once)  # for forked workers too
    pieces = SentencePieceProcessor(model_file=PIECES)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = aligned_plainly(rows, plain_library, pieces)
    found = alignment.Aligned(alignment.Tokens(BYTES, PIECES), [t or "" for _, t in rows])
    assert found.texts_of_groups() == [w[-1] for w in want]
    text, _, links = found.pairs()
    assert np.bincount(text, links, len(rows)).astype(int).tolist() == [w[4] for w in want]
    got = align_tokens(docs, BYTES, PIECES)
    assert got.columns == [*ALIGNED, "groups"]
    assert by_row(got, *ALIGNED, "groups") == sorted(want, key=repr)
    assert any(w[3] == 0 and t for w, (_, t) in zip(want, rows))  # a text whose tokens do not join to it


def test_alignment_of_an_empty_table(none):
    got = align_tokens(none, BYTES, PIECES, digest=True)
    assert got.columns == [*ALIGNED, "groups_sha256"] and got.collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables absent")
def test_alignment_query_against_the_plain_one(spark, plain_library):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    want = aligned_plainly(rows, plain_library, SentencePieceProcessor(model_file=PIECES))
    want = [(*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for w in want]
    got = queries.op11_alignment(spark, SF_DIR)
    assert got.dtypes == [(c, "bigint") for c in ALIGNED] + [("groups_sha256", "string")]
    assert sorted(map(tuple, got.collect())) == sorted(want)


# fill in the middle


def test_cutting_splits_the_descriptor_at_the_place():
    pieces = [Piece(0, 0, 4), Piece(1, 3, 3), Piece(0, 4, 5)]
    assert cut(pieces, 5) == ([Piece(0, 0, 4), Piece(1, 3, 1)], [Piece(1, 4, 2), Piece(0, 4, 5)])
    assert cut(pieces, 4) == (pieces[:1], pieces[1:])
    assert cut(pieces, 0) == ([], pieces) and cut(pieces, 12) == (pieces, [])


def rewritten_plainly(doc_id, text, choice):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    key = f"{choice.seed}:{'' if doc_id is None else doc_id}"
    h = [int(hashlib.sha256(key.encode()).hexdigest()[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(units)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= choice.rewritten:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = f"<S>{suffix}<P>{prefix}<M>{middle}"
    form, output = ("spm", spm) if h[3] % 100 < choice.spm else ("psm", f"<P>{prefix}<S>{suffix}<M>{middle}")
    return doc_id, n, form, len(prefix), len(middle), output, text


@pytest.mark.parametrize("choice", [Choice(), Choice(seed=11, rewritten=60, spm=0), Choice(seed=2, spm=100)])
def test_documents_are_rearranged_and_restored(docs, choice):
    made = restore_text(fill_in_middle(docs, choice))
    want = [rewritten_plainly(r.doc_id, r.text, choice) for r in docs.select("doc_id", "text").collect()]
    assert by_row(made, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored") == sorted(want, key=repr)
    for r in made.collect():
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest()
        buffers = r.restored.encode(), b"<P><S><M>"
        assert b"".join(buffers[p.buffer][p.start : p.start + p.length] for p in r.pieces) == r.output.encode()


def test_marks_at_the_borders_do_not_mislead(spark):
    texts = [x + y + "\n" + z for x in ("<", "<P", "P>", "", "<M\n<") for y in ("", "<S", "M>") for z in ("", ">", "<P", "S>\n")]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts * 4)], "doc_id long, text string")
    made = restore_text(fill_in_middle(df))
    assert made.join(df, "doc_id").where("restored <> text").count() == 0
    assert {r.form for r in made.select("form").distinct().collect()} >= {"psm", "spm"}


def test_rewriting_of_empty_tables_and_text_ids(spark, none):
    assert restore_text(fill_in_middle(none)).collect() == []
    df = spark.createDataFrame([("a", "x\ny\nz"), (None, "x\ny")], "doc_id string, text string")
    want = [rewritten_plainly(r.doc_id, r.text, Choice()) for r in df.collect()]
    made = restore_text(fill_in_middle(df).withColumn("RESTORED", F.lit(1)))
    assert by_row(made, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored") == sorted(want, key=repr)
