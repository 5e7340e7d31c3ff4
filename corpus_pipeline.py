"""A corpus from raw documents to token ids, in five stages.

Each stage gets what the one before kept, as a stored table. The first four return
the columns of ``documents``; the last adds ``ids``, the text ``decoded`` from them and
``n_tokens``, in place of columns that have these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontam, lines, minhash, pieces, quality
from strata.llm.common import table
from strata.scratch import remove, scratch_dir, scratch_scope


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without what the quality classifier rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated runs of lines, and their new lengths."""
    columns = docs.columns
    out = lines.dedup_lines(docs)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8)."""
    return minhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and the text they decode to."""
    coded = pieces.encode_and_decode(docs)
    rest = [c for c in coded.columns if c.lower() != "n_tokens"]
    return coded.select(*(F.col(f"`{c}`") for c in rest), F.coalesce(F.array_size("ids"), F.lit(0)).alias("n_tokens"))


STAGES = [
    ("quality", good_documents),
    ("lines", unrepeated_lines),
    ("near_duplicates", distinct_documents),
    ("decontamination", decontaminated),
    ("tokens", tokenised),
]

#: Models, signatures and alignments have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's own tables go when its result is stored, its input after the next one."""
    docs, held = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name)
        with scratch_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if held is not None:
            remove(spark, held)
        docs, held = spark.read.schema(out.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
