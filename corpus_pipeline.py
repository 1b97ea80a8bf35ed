"""The training-corpus pipeline: STAGES, run() and its SQL twin (query ``pipeline``).

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages
the rows are written as Parquet under the shared checkpoint folder and reread.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import decontamination, mixing, quality_classifier, simhash, substring_dedup
from lakemart.llm.common import importable, read_table
from lakemart.session import checkpoint_root


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the classifier rejects go."""
    importable(spark)
    scored = quality_classifier.score_quality(docs, read_table(spark, sf_dir, "labels"), carry=True)
    return scored.filter("predicted = 1").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each component stays."""
    importable(spark)
    return simhash.drop_near_duplicates(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: repeated word windows are cut out of the later documents.

    A text that loses nothing stays as it is, byte for byte; one that loses
    words becomes its kept words, joined by a space, and its ``n_chars`` follows.
    Documents that lose all their words go.
    """
    importable(spark)
    cut = substring_dedup.remove_repeated_substrings(docs, carry=True, carry_text=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    columns = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("text", "n_chars")]
    chars = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("row.n_chars"))
    out = cut.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words"))).select(
        *columns, text.alias("text"), chars.cast("long").alias("n_chars"))
    return out.select(*[f"`{c}`" for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that contain a benchmark item go."""
    importable(spark)
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: the documents, with how many of their words the mix takes."""
    importable(spark)
    return mixing.mix_sources(docs, keep=tuple(c for c in docs.columns if c not in ("doc_id", "source")))


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mixing_sources", mixing_stage),
]

#: The first stage is a trained network: SQL can't express run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread.  What is written
    between stages is removed when the application ends."""
    docs = read_table(spark, sf_dir, "documents")
    root = f"{checkpoint_root(spark)}/llm/corpus-{uuid.uuid4().hex[:12]}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{root}/{i}-{name}")
            docs = spark.read.parquet(f"{root}/{i}-{name}")
    return docs
