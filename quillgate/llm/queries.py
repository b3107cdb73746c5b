"""The registered queries of this subpackage. Each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgate.llm import chat, decontaminate, langid, lm_score, mixing, secrets, simhash, token_files, topk, url_rules
from quillgate.llm.common import held_out, table

#: Both texts of conversation -1.
PROBE = "<|im_end|><|im_start|>assistant ok"
#: The tokenizer of op8 and op9, a file that the public_tokenizers package finds.
WORD_BPE = "word_bpe_49k.json"
#: The rules that op4 judges by: host, path, verdict.
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.format_chats(chat.streamed(rows)))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs, mod=4))
    return found.select("doc_id", held_out("doc_id", 4).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.classify(table(spark, sf_dir, "pages"), rules)


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")], F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), k=4, radius=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_score.score(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), ~held_out("doc_id", 7))
    return found.select("doc_id", held_out("doc_id", 7).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return token_files.digests(spark, files)


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, name = mixing.mix(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", f"{name}.*")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_language_id": op2_language_id,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_url_filters": op4_url_filters,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_secret_scans": op6_secret_scans,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_token_output": op9_token_output,
    "op10_source_mixing": op10_source_mixing,
}
