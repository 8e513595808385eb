"""The operators applied to the given tables, and the SQL checks where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillstone.llm import chat, checks, decontam, hmm, jaccard, licenses, line_dedup, mixing, negatives, packing, prefixes, quality, secrets, suffix_dedup

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if check:
            CHECKS[name] = check
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_secret_scan", checks.SECRETS)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf, "documents").select("doc_id", "text"))

    def count(kind: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("secrets")).alias("spans"),
    )


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf, "documents"), digest=True)
    return kept.select(F.col("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept_sha256"))


@query("op3_mix_sources")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents"))
    return mixed.select(F.col("doc").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op4_chat_format", checks.CHAT)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    tricky = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.read_back(chat.format_turns(turns))


@query("op5_quality_rules")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select(
        F.col("doc").alias("doc_id"), *[F.col(f"q.{c}") for c in counts], F.array_join("q.failed", ",").alias("failed_rules")
    )


@query("op6_license_scan")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf, "documents")).drop("spans")


@query("op7_line_dedup")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    kept = line_dedup.drop_repeated_lines(docs, count="n_removed")
    return kept.select("doc_id", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op8_lm_scores")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return hmm.language_model(table(spark, sf, "documents"))


@query("op9_jaccard_join", checks.JACCARD)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    joined = jaccard.join_components(table(spark, sf, "documents"))
    return joined.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


@query("op10_decontamination", checks.DECONTAMINATION)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    windows = decontam.item_windows(table(spark, sf, "benchmark"))
    hits = decontam.find_hits(table(spark, sf, "documents"), windows)
    n_hit = decontam.covered(F.col("spans"))
    return hits.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query("op11_best_fit_packing")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    # the ranks of byte_bpe_50k.json, for the faster of the two libraries; tests hold the ids against the other
    parts = packing.tokenized(
        table(spark, sf, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        {"<|endoftext|>": 50256},
    )
    packed = packing.pack(parts)
    return packed.select(F.col("doc").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op13_hard_negatives", checks.HARD_NEGATIVES)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf, "embeddings"))


@query("op12_prefix_trie", checks.PREFIXES)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return prefixes.prefix_tree(table(spark, sf, "conversations"))
