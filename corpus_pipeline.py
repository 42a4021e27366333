"""The corpus pipeline: five stages over ``documents``, each one operator of ``kerbflow.llm``.

toxicity (documents it rejects go), n-gram Jaccard join (one document of each group
stays), suffix-array removal of repeated passages, mixing sources to target weights,
best-fit packing.  Stages work on all rows of their input, treat null texts as empty and
keep rows they do not decide about; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.llm.common import stored, table
from kerbflow.llm.jaccard import Threshold, jaccard_join
from kerbflow.llm.mixing import mixed_documents
from kerbflow.llm.packing import pack_best_fit
from kerbflow.llm.queries import SEQUENCE_TOKENS, tokenizer_path
from kerbflow.llm.repeats import remove_repeats
from kerbflow.llm.tokens import token_pieces
from kerbflow.llm.toxicity import score_toxicity, train
from kerbflow.session import prepare

# Rows that go to a Python worker at once.  Texts are long; Spark's own 10,000 would hold
# tens of megabytes of them in each copy.
BATCH_ROWS = "2000"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model trained on the labelled ones does not call toxic.

    As the first stage it also puts the runtime settings on the session, for all stages.
    """
    prepare(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).where("predicted = 0").select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five words, 0.8).

    Rows that share that id stay together; rows without an id stay unless they are in a group
    that has one.
    """
    found = jaccard_join(docs, width=5, threshold=Threshold(80, 100))
    stays = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    return docs.alias("d").join(stays.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")), "left_semi")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 100 bytes or more that came before.

    A document may end up empty, but no row goes.  Bytes of a character that was cut in two
    go with the passage.
    """
    cut = remove_repeats(docs, length=100, as_text=True).withColumn("text", F.col("kept"))
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: sequence and offset."""
    pieces = token_pieces(docs, tokenizer_path(), SEQUENCE_TOKENS)
    digest = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack_best_fit(stored(digest, "pieces"), SEQUENCE_TOKENS)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", keep_one_of_each_group),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's output is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
