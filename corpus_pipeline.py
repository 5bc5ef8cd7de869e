"""A training-data pipeline over ``documents``: drop toxic texts, exact and near duplicates, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; all but the last return the columns of ``documents``. ``run`` writes each
stage as Parquet in the shared folder and rereads it for the next.

Rows that nothing speaks against stay: null and empty texts are scored like any
other, very long ones whole. Rows are told apart by id: rows that repeat an id share its fate.
The mix returns a document once for each copy taken. Stages work on the five columns of ``documents``;
other columns, whatever their names, are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlog.llm import byte_bpe, exact_dedup, mixing, near_dedup, toxicity
from flowlog.llm.common import materialise
from flowlog.llm.queries import VOCABULARY

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> list[str]:
    return [c for c in COLUMNS if c in docs.columns]


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the toxicity machine, fitted on the labelled ones, rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score_texts(docs.select(*_columns(docs)), toxicity.train(docs, labels))
    return scored.where(toxicity.predicted(F.col("toxicity")) == 0).select(*_columns(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) the row with the smallest id stays."""
    columns = _columns(docs)
    return exact_dedup.exact_groups(docs.select(*columns)).where("kept").select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near duplicates (five words, 0.8) stays, that of the smallest id."""
    columns = _columns(docs)
    groups = near_dedup.near_groups(docs.select("doc_id", "text"), width=5, percent=80)
    gone = groups.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.select(*columns).join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 1, 2, 3, repeating; a document comes once for each copy."""
    columns = _columns(docs)
    mixed = mixing.systematic_mix(docs.select(*columns)).where("mix_copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))).select(*columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (packed unsigned 32-bit), with a check that they decode to it."""
    coded = byte_bpe.encode(docs.select("doc_id", "source", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256")),
                            public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, decoded_col="decoded")
    return coded.select("doc_id", "source", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


STAGES = [("toxicity", keep_clean), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies),
          ("source_mix", mix_sources), ("byte_bpe", encode_texts)]
#: The toxicity machine and the tokenizer are not expressible in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
