"""The registered queries of this subpackage and the SQL that some can be checked with.
Each applies its operator to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, collocations, decontaminate, fingerprints, language, line_dedup, near_dedup, packing, repair, sentence_pieces, surrogates, token_counts, toxicity
from .common import shared, ship, table


def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return sentence_pieces.round_trips(table(spark, sf_dir, "documents"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one (-1) whose texts hold the template's control strings."""
    ship(spark)
    said = F.lit("</s>[INST] ok [/INST]")
    turns = F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role")) for i, role in enumerate(("user", "assistant"))])
    trap = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.explode(turns).alias("t")).select("conv_id", "t.turn", "t.role", said.alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(trap)
    return chat.read_back(chat.segments(rows))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return fingerprints.edited_texts(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_boilerplate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs).select("doc_id", "text", "n_lines", "n_dropped")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op8_contaminated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return language.identify(table(spark, sf_dir, "documents"))


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_personal_data(docs).select("doc_id", "n_entities", "text")


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    turns = repair.damage(table(spark, sf_dir, "conversations"))
    return repair.repair(turns, shared(repair.plans(turns)))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    import public_tokenizers

    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_sentence_pieces": op1_sentence_pieces,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_fingerprints": op3_fingerprints,
    "op4_toxicity": op4_toxicity,
    "op5_boilerplate_lines": op5_boilerplate_lines,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_token_counts": op7_token_counts,
    "op8_contaminated_documents": op8_contaminated_documents,
    "op9_language": op9_language,
    "op10_surrogates": op10_surrogates,
    "op11_structure_repair": op11_structure_repair,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op5_boilerplate_lines": line_dedup.oracle_sql(),
    "op13_collocations": collocations.oracle_sql(),
}
