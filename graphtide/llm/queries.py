"""The registered queries of the operators and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphtide.llm import quality, sql, toxicity
from graphtide.llm.chat import format_conversations, masked_text, turns
from graphtide.llm.common import fold, table
from graphtide.llm.decontaminate import find_contamination
from graphtide.llm.divergence import apply_rules
from graphtide.llm.fill_middle import fill_in_middle, restored
from graphtide.llm.language import label_languages
from graphtide.llm.mixing import mix_sources
from graphtide.llm.near_dup import find_near_duplicates
from graphtide.llm.pii import find_pii
from graphtide.llm.runs import collapse_runs
from graphtide.llm.token_groups import link_documents
from graphtide.llm.url_filter import Rule, filter_urls

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), lambda id: fold(id, 4) != 2)
    scored = quality.score_quality(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 3) == 1
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out), keep=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


RULES = [
    Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES, keep=["page_id"])


def op4_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = apply_rules(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 3) == 1
    found = label_languages(table(spark, sf_dir, "documents"), ~held_out, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    done = format_conversations(rows.unionByName(extra)).select("conv_id", "formatted", turns(F.col("formatted")).alias("turns"), masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_near_duplicates(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_in_middle(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # A tenth of the texts get a periodic end.
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    planted = docs.where((h % 10) == 0).select("doc_id", "text", words.alias("w"), F.floor(h / 10).alias("g")).withColumn("n", F.size("w"))
    planted = planted.withColumn("a", F.pmod("g", "n").cast("int"))
    planted = planted.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    turned = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + F.pmod(i - F.col("a"), F.col("p")))))
    planted = planted.select("doc_id", F.when(F.col("n") > 0, F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))
    rest = docs.where(F.coalesce((h % 10) != 0, F.lit(True))).select("doc_id", "text")
    done = collapse_runs(rest.unionByName(planted), keep=["doc_id"])
    rows = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(rows, lambda r: F.concat(r, F.lit("\n"))), "")
    return done.select(
        "doc_id", "n_runs", "longest.start", "longest.length", "longest.period",
        F.floor(F.lit(1000) * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents"), keep=["doc_id"])


REGISTRY: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_toxicity": op2_toxicity,
    "op3_url_filter": op3_url_filter,
    "op4_divergence": op4_divergence,
    "op5_pii": op5_pii,
    "op6_decontamination": op6_decontamination,
    "op7_language": op7_language,
    "op8_chat": op8_chat,
    "op9_mixing": op9_mixing,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_fill_middle": op11_fill_middle,
    "op12_runs": op12_runs,
    "op13_token_groups": op13_token_groups,
}

ORACLE: dict[str, str] = {
    "op6_decontamination": sql.DECONTAMINATION,
    "op8_chat": sql.CHAT,
    "op9_mixing": sql.MIXING,
    "op11_fill_middle": sql.FILL_MIDDLE,
}
