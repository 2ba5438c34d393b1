"""The corpus pipeline: documents -> toxicity -> near duplicates -> decontamination -> mixing -> sharding.

Each stage is a function of (spark, docs, sf_dir); it works on all that its predecessor kept, and its
result is written as Parquet in the shared folder and read again as the next one's docs.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiolake.llm import decontamination, jaccard_join, kd_sharding, mixing, toxicity
from regiolake.llm.common import read, stored
from regiolake.llm.queries import KD_DIMS, MIX_TARGETS, NUM_SHARDS, labelled_domains

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    scored = toxicity.classify(docs, read(spark, sf_dir, "labels"))
    return scored.where(F.col("predicted") == 0).select(*DOCUMENT_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays (of the least text hash, if it is
    repeated with several texts of the group); so do all documents without words, which are no copies of anything,
    and rows without an id, which can't be named.  Different texts under one id are different documents."""
    found = stored(jaccard_join.jaccard_components(docs, n=5, percent=80, by_text=True), "pipeline-components")
    first = (found.where("n_shingles > 0 AND doc_id = component_id").groupBy("component", "doc_id")
             .agg(F.min("text_hash").alias("text_hash")).select("doc_id", "text_hash"))
    alone = docs.where(F.col("doc_id").isNull() | ~F.rlike(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]")))
    worded = docs.where(F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))).withColumn("text_hash", F.xxhash64("text"))
    return (worded.join(first, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"]).select(*DOCUMENT_COLUMNS)
            .unionByName(alone.select(*DOCUMENT_COLUMNS)))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up a twentieth or more go."""
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark")).select(*DOCUMENT_COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The largest mixture without repeats whose expected tokens by domain match the target weights."""
    labelled = labelled_domains(docs, read(spark, sf_dir, "labels"))
    rated = mixing.mix(docs, labelled, MIX_TARGETS, most=1.0)
    return mixing.thinned(rated).select(*DOCUMENT_COLUMNS)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest in shards of near equal bytes, each row with its place in the shard."""
    out = kd_sharding.shard_documents(docs, KD_DIMS, num_shards=NUM_SHARDS)
    return out.select(*DOCUMENT_COLUMNS, "size", "text_crc32", "shard", "slot")


STAGES = [("toxicity", toxic), ("near_duplicates", near_duplicates), ("decontamination", decontaminated), ("mixing", mixed),
          ("sharding", sharding)]

# a learned classifier and a fitted mixture aren't SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
