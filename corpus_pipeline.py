"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns rows with the columns of ``documents``; the last one returns
piece ids.  ``run`` writes every stage's rows as Parquet into the shared folder
and reads them back for the next.

Edge cases common to all stages: an empty table stays empty; extra columns pass
through; null text counts as empty and null ids are kept as far as the operator
can name them (see each operator's docstring); repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import mixing, ngram_join, pieces, quality_gam, secret_scan
from tessera.llm.common import staged, table
from tessera.session import ship_package

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
KEEP_SCORE = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose quality score reaches ``KEEP_SCORE``; labels of the held-out
    fold (crc32(doc_id) mod 5 = 0) are not learned from."""
    labels = table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    score = quality_gam.quality_score(quality_gam.fit_quality(docs, labels))
    return docs.where(score(F.coalesce("text", F.lit(""))) >= KEEP_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: word 5-grams, Jaccard >= 0.8."""
    return ngram_join.drop_near_copies(docs, words=5, threshold=(80, 100))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets blotted out of their texts."""
    return secret_scan.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_ids and the piece ids of the text."""
    coded = pieces.encode(docs.select("doc_id", "lang", "source", "text"), pieces.read_pieces(PIECE_MODEL))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [("quality", quality), ("near_copies", near_copies), ("secrets", secrets), ("source_mix", source_mix), ("piece_ids", piece_ids)]

# The fitted model, sketches and piece folds have no SQL form; tests/llm compares with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
