"""The registered queries of the operators, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.llm.alignment import align_tokens
from kerbflow.llm.bpe_trie import decode_ids, encode_texts
from kerbflow.llm.common import n_bytes, stored, table
from kerbflow.llm.fill_middle import fill_in_middle, restore_text
from kerbflow.llm.fingerprints import edit_check
from kerbflow.llm.html_text import extract_text
from kerbflow.llm.jaccard import Threshold, jaccard_join
from kerbflow.llm.mixing import mix_sources
from kerbflow.llm.neighbours import nearest_neighbours
from kerbflow.llm.packing import pack_best_fit
from kerbflow.llm.repeats import remove_repeats
from kerbflow.llm.sharding import shuffle_into_shards
from kerbflow.llm.tokens import token_pieces
from kerbflow.llm.toxicity import held_out, score_toxicity, train
from kerbflow.llm.url_filter import ALLOW, BLOCK, Rule, judge_urls

SHARDS = 24
SEQUENCE_TOKENS = 2048
# Fixed by contract.
URL_RULES = [
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
]


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shuffle_into_shards(docs, SHARDS).select(
        "doc_id",
        (n_bytes(F.col("text")) + 8).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"), width=4, threshold=Threshold(85, 100))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_check(table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, length=100).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = token_pieces(docs, tokenizer_path(), SEQUENCE_TOKENS)
    digest = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack_best_fit(stored(digest, "pieces"), SEQUENCE_TOKENS)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of two tokenizers' tokens over each document, and how common their links are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_tokens(docs, *paths, digest=True)


def op12_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each document and the text they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return decode_ids(coded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut and rearranged for filling in the middle, and the texts rebuilt from that."""
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("pieces")
    return restore_text(made).drop("output", "restored")


OP5_SQL = """
WITH parts AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
),
rules(rule, verdict, rule_host, rule_path) AS (VALUES
    ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
    ('www.example.com/en/', 'allow', 'www.example.com', '/en/'),
    ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')
),
fits AS (
    SELECT p.host, p.path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
    FROM (SELECT DISTINCT host, path FROM parts) p
    JOIN rules ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)
    GROUP BY p.host, p.path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (host, path)
"""

# All pairs that share a shingle, with the sizes of their intersections; then the smallest
# id reachable.
OP2_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [w] ELSE list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) END) AS s
    FROM words
),
coded AS (SELECT doc_id, dense_rank() OVER (ORDER BY s) AS c FROM shingles),
sizes AS (SELECT doc_id, count(*) AS n FROM coded GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
    FROM coded a JOIN coded b ON a.c = b.c AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 100 * k >= 85 * (x.n + y.n - k)
),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r USING (doc_id)
"""

# One 32-bit number per eight digits of the digest; parts are lists of lines.
OP13_SQL = r"""
WITH lines AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l,
        sha256('7:' || doc_id::VARCHAR) AS h
    FROM documents
),
draws AS (
    SELECT doc_id, text, l, len(l) AS n, list_transform([1, 9, 17, 25], lambda k:
        list_reduce(list_transform(range(0, 8), lambda i: (position(h[k + i] IN '0123456789abcdef') - 1)::BIGINT),
            lambda x, y: 16 * x + y)) AS d
    FROM lines
),
cuts AS (
    SELECT doc_id, text, l, n, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d[3] % 100 >= 100
            THEN 'plain' WHEN d[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM draws
),
parts AS (
    SELECT *, array_to_string(l[1:a], '') AS prefix, array_to_string(l[a + 1:b], '') AS middle, array_to_string(l[b + 1:n], '') AS suffix
    FROM cuts
)
SELECT doc_id, n::BIGINT AS n, form,
    CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_jaccard_join,
        op3_toxicity,
        op4_neighbours,
        op5_url_filter,
        op6_mixing,
        op7_fingerprints,
        op8_html_text,
        op9_suffix_dedup,
        op10_packing,
        op11_alignment,
        op12_bpe_trie,
        op13_fill_middle,
    )
}
SQL: dict[str, str] = {"op2_jaccard_join": OP2_SQL, "op5_url_filter": OP5_SQL, "op13_fill_middle": OP13_SQL}
