"""Documents to shards, as stages that each apply one operator of ``tidemark.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, hash_tree, mixing, near_dup, pu_toxicity
from tidemark.llm.tables import store, table


def _slim(docs: DataFrame) -> DataFrame:
    """What the operators look at, and the whole row beside it, so that no column's name clashes."""
    return docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("_row"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not judged toxic, by a model of four folds of the labels.

    NULL, empty and very long texts are judged like any other, by their words. Equal
    rows stay or go together. No rows give no rows.
    """
    labels = table(spark, sf_dir, "labels").where(~pu_toxicity.held_out())
    scored = pu_toxicity.score(_slim(docs), *pu_toxicity.learn(docs, labels))
    return scored.where("toxicity < 0.5").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest doc_id.

    Rows without doc_id come first. Where rows share a doc_id or have none, each is a
    document of its own, by a number that is stored with it, so one row of each group stays
    whatever the ids are. A row whose text is NULL, empty or without words is in no group.
    """
    shared = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if shared.isEmpty():
        copies = near_dup.near_duplicates(docs).where("not kept").select("doc_id").distinct()
        return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)
    rows = store(docs.select(F.struct(*docs.columns).alias("_row"), F.monotonically_increasing_id().alias("_n")), "numbered")
    groups = near_dup.near_duplicates(rows.select(F.col("_n").alias("doc_id"), "_row.text"))
    groups = groups.select(F.col("doc_id").alias("_n"), "component_id").join(rows.select("_n", "_row.doc_id"), "_n")
    first = groups.groupBy("component_id").agg(F.min(F.struct("doc_id", "_n")).alias("first")).select("first._n")
    return rows.join(first, "_n", "left_semi").select("_row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; a NULL or empty text holds none."""
    found = decontaminate.find(_slim(docs), table(spark, sf_dir, "benchmark"))
    return found.where(F.size("matches") == 0).select("_row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of rare sources several times; a NULL source is one of its own."""
    return mixing.mixed(_slim(docs), mixing.plan(docs)).select("_row.*")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document's every copy."""
    return hash_tree.sharded(docs, hash_tree.tree(8))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shards),
]

#: SQL can't express the first stage; tests/llm checks each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is stored and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
