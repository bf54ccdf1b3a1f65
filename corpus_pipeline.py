"""A corpus made ready for training: quality, line dedup, near duplicates, mix, packing.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns what
it keeps with the columns of ``docs``; the last returns the packed pieces. Rows that
repeat an id stay or go together; null ids, sources and texts are kept as they are by
the stages that don't need them (a null text scores as an empty one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kpicast.llm import crf, line_dedup, mixing, packing, partenum
from kpicast.llm.common import prepare
from kpicast.llm.queries import MIX_SEED, quality_model, vocabulary
from kpicast.session import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier takes for good."""
    prepare(spark)
    scored = crf.score(docs, quality_model(spark, sf_dir, docs))
    return scored.filter("_predicted = 1").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the blocks of lines that an earlier document has; a document of
    which nothing is left goes. n_chars follows the text."""
    prepare(spark)
    found = line_dedup.dedup_lines(docs)
    cut = F.col("_deleted_lines") > 0
    found = found.filter(~cut | (F.trim(F.regexp_replace("text", r"[\x09-\x0D]", " ")) != ""))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(cut, length).otherwise(F.col("n_chars")))
    return found.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the one with the smallest id."""
    prepare(spark)
    grouped = partenum.near_duplicates(docs)
    kept = grouped.filter("doc_id <=> component_id").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    prepare(spark)
    return mixing.mix_sources(docs, MIX_SEED)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    prepare(spark)
    return packing.pack(packing.pieces(docs, vocabulary("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram jaccard join", near_duplicates),
    ("source mix", mix),
    ("best-fit packing", pack),
]

# SQL can't express the classifier, the alignment and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
