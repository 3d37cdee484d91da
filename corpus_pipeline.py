"""From raw documents to token ids: five stages, each over all that the one before kept.

Defined results of the stages: a null text is an empty one and fails the first stage; rows
without an id pass or fail by their text and are nobody's near-duplicate; of repeated rows one
stays; an empty table gives none; further columns of the input pass through the first four
stages whatever their names, which working columns never take, and the last one leaves them
out. Very long texts are handled whole, one at a time.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brontide.llm import decontaminate, near_dup, pieces, pii, rules
from brontide.llm.common import Scratch, free_names, table, written

#: The SentencePiece model of the last stage; it must be installed on every machine.
MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Near copies share four fifths of their five-word shingles; 16 x 16 tables miss such a pair with 2e-5.
NEAR = near_dup.Params(shingle=5, share=80, collection=16)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a learned rule rejects go."""
    judged = rules.judge(docs, table(spark, sf_dir, "labels"))
    return judged.where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the smallest id.

    Of an id with several texts, each goes or stays by its own set; of rows of one id and set, one stays.
    """
    stays, own, wordless = free_names(docs, "stays", "set_digest", "wordless")
    judged = near_dup.near_duplicates_by_set(docs, params=NEAR).where("doc_id IS NOT NULL")
    # Ids that occur once and stay go through untouched; the rows of one that occurs often are told apart by their sets.
    fate = judged.groupBy("doc_id").agg(F.max("stays").alias(stays), F.count("*").alias("n")).where(f"NOT `{stays}` OR n > 1")
    few = written(fate.select("doc_id", stays), "leaving")
    small = few.count() <= near_dup.BROADCAST_IDS
    marked = docs.join(F.broadcast(few) if small else few, "doc_id", "left").where(F.col(stays).isNull() | F.col(stays))
    once = marked.where(F.col(stays).isNull()).select(docs.columns)
    repeated = marked.where(F.col(stays)).select(*docs.columns, near_dup.set_digests(NEAR.shingle, "text").alias(own))
    often = judged.join(few.where(F.col(stays)), "doc_id", "left_semi").where("NOT stays").select("doc_id", F.col("digest").alias(own))
    repeated = repeated.join(often, ["doc_id", own], "left_anti").withColumn(wordless, F.when(F.col(own).isNull(), F.col("text")))
    # Rows of one id and set have one text but for blanks and case; the least row of them stays.
    rest = [c for c in docs.columns if c != "doc_id"]
    least = repeated.groupBy("doc_id", own, wordless).agg(F.min(F.struct(*rest)).alias(stays))
    return once.unionByName(least.select("doc_id", *(F.col(stays)[c].alias(c) for c in rest)).select(docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a twentieth or more of benchmark windows go."""
    judged = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("contaminated")).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes its kind's name; n_chars follows the new text."""
    found = pii.find_pii(docs)
    clean = found.withColumn("text", pii.redacted(F.col("text"), F.col("spans")))
    length = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", length).select(docs.columns)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and whether they decode to it."""
    coded = pieces.decode(pieces.encode(docs.select("doc_id", "lang", "source", "text"), MODEL), MODEL)
    round_trip = F.col("decoded").eqNullSafe(F.col("text"))
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_ids"), round_trip.alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", sentencepiece_ids),
]

#: Learned rules, MinHash and merge encodings are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES:
        before, docs = docs, scratch.written(stage(spark, docs, sf_dir), name)
        scratch.drop(before)  # the next stage reads only what this one kept
    return docs
