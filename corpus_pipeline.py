"""A cleaning pipeline over ``documents``: each stage calls one operator of dimforge.llm.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of
``documents``; the last one adds token ids.  Whoever runs the stages writes each result as
Parquet and reads it again as the next stage's docs; ``run`` does so in the folder that
spark.checkpoint.dir names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.llm import decontaminate, language, line_dedup, near_dedup, sentence_pieces
from dimforge.llm.common import fresh, shared_folder, ship, table


def _aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its own columns of these names (in any case), which an operator's results
    would replace, under other names, and the way back."""
    moved = {c: fresh(docs, f"own_{c}") for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(moved), {new: old for old, new in moved.items()}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language (null texts, or without a letter) go; the others carry the
    predicted language in lang.  It is a label, no filter by language: every other document
    stays.  All other columns come out as they went in, whatever their names; repeated rows
    stay repeated, and an empty table stays empty."""
    ship(spark)
    columns = docs.columns
    kind = docs.schema["lang"].dataType if "lang" in columns else "string"
    docs, back = _aside(docs, "lang_pred", "score")
    found = language.label(docs).filter(F.col("lang_pred") != language.UNKNOWN).withColumn("lang", F.col("lang_pred").cast(kind))
    return found.drop("lang_pred", "score").withColumnsRenamed(back).select(columns)


def boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go from the texts, with n_chars brought up to date; no
    document goes.  Null and empty texts stay; all other columns come out as they went in,
    whatever their names; an empty table stays empty."""
    columns = docs.columns
    docs, back = _aside(docs, "n_lines", "n_dropped")
    cleaned = line_dedup.drop_boilerplate(docs)
    if "n_chars" in columns:
        changed = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
        cleaned = cleaned.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return cleaned.drop("n_lines", "n_dropped").withColumnsRenamed(back).select(columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, and one row
    of those that repeat an id."""
    ship(spark)
    gone = near_dedup.near_duplicates(docs).filter("not kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    # A null id is no document's: such rows all stay.
    return left.filter("doc_id is not null").dropDuplicates(["doc_id"]).union(left.filter("doc_id is null"))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.  Null and empty texts hold none; all columns
    come out as they went in; an empty table on either side drops nothing."""
    ship(spark)
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ids, n_tokens and round_trip: whether decoding the ids gives the text back.  If the
    documents have such columns themselves, those stay and the results get a leading
    underscore.  Null and empty texts have no ids and round-trip; an empty table stays empty."""
    ship(spark)
    results = ("ids", "n_tokens", "round_trip")
    named = {r: fresh(docs, r) for r in results}
    docs, back = _aside(docs, *results)
    return sentence_pieces.encode_checked(docs).withColumnsRenamed(named).withColumnsRenamed(back)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", boilerplate_lines),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_passages),
    ("sentence_pieces", tokens),
]

#: Language models and sketches are no SQL; the tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the documents that are left, with their ids.  Each stage's
    result is written and read again, so a lost executor repeats no earlier stage.  Nulls,
    ties, repeated rows and empty tables are defined by the stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus_pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
