"""The registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brontide.llm import decontaminate, near_dup, pieces, pii, quality, rules, shards, spelling, suffixes, tokens, turns, urls, warc
from brontide.llm.common import table, written
from brontide.llm.sql import ORACLE

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(f):
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


@_query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.array_join(F.array_sort("item_ids"), ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", ids.alias("items_sha256"), "contaminated")


@_query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@_query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = rules.judge(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@_query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, keep_text=False)
    counts = [F.size(F.filter("base_spans", lambda x, i=i: x["kind"] == i)).cast("long").alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text("base_spans").cast("binary"), 256).alias("base_sha256"), pii.spans_text("spans").alias("spans"))


@_query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of each text as count and digest, and whether decoding them gives the text again."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    both = pieces.decode(coded, path)
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_ids"), digest.alias("ids_sha256"), F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


@_query
def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@_query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shards.shard(table(spark, sf_dir, "documents"), 40, keep=["doc_id"])
    none = F.lit(None).cast("int").alias("grown_shard")
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", none)


#: Fixed values of the contract.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@_query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, URL_RULES, urls.spam_keys(pages)).select("page_id", "host", "path", "rule", "verdict", "listed")


@_query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_archive(table(spark, sf_dir, "pages"))
    return warc.read_archive(archive, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@_query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"), damage=97)


@_query
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired = turns.Repaired(turns.damaged(conversations))
    ids = conversations.select("conv_id").distinct().withColumn("ck", turns.never_null("conv_id"))
    found = repaired.summary.drop("conv_id").join(repaired.digest(), "ck")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    out = ids.join(found, "ck", "left").select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
    out = written(out, "repaired")
    repaired.clear()
    return out


@_query
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, scratch = suffixes.without_repeats(docs, length=200, keep="none")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    out = found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    out = written(out, "without-repeats", suffixes.TEXT_ROWS)
    scratch.clear()
    return out
