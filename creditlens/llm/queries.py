"""The ``opN_<name>`` queries over the given tables and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.llm import (
    classifier, embeddings, formatting, jaccard, licenses, mixing, periodic, pieces, quality, repair, repeats, secret_scan,
    tokencounts,
)
from creditlens.llm.common import read, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle:
            ORACLE[name] = oracle
        return fn
    return deco


@query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.scan_documents(docs).drop("clean_text")


@query("op5_chat_formatting", formatting.ORACLE_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"  # fixed by the contract
    extra = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"),
                 F.lit(r).alias("role"), F.lit(said).alias("text"))
        for i, r in enumerate(("user", "assistant"))])).alias("r")).select("r.*")
    return formatting.digest(formatting.format_conversations(turns.unionByName(extra)))


@query("op6_mixing", mixing.ORACLE_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query("op8_quality_rules", quality.ORACLE_QUERY)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = quality.judge(docs)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("text")
    return tokencounts.histogram(tokencounts.count_tokens(docs))


@query("op1_embedding_near_dedup", embeddings.ORACLE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


@query("op7_sentencepiece")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = classifier.train(docs, read(spark, sf_dir, "labels"))
    out = classifier.score(docs, model)
    return out.select("doc_id", (classifier.remainder(F.col("doc_id")) == 0).alias("held_out"), "score",
                      (F.col("score") >= classifier.CUT).cast("int").alias("predicted"))


@query("op2_jaccard_join", jaccard.ORACLE_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"))


@query("op4_repeated_bytes")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(read(spark, sf_dir, "documents")))


@query("op11_periodic_runs", periodic.ORACLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.detect(read(spark, sf_dir, "documents"), planted=True))


@query("op12_conversation_repair", repair.ORACLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(read(spark, sf_dir, "conversations")))


@query("op13_license_scan", licenses.ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text")))
