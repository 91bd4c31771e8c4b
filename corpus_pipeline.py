"""The corpus pipeline: stages over documents, each written and read again as the next one's input."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm.contamination import with_matches
from emberlog.llm.jaccard import ids, linked_rows, row_hash
from emberlog.llm.mixing import copies, mix
from emberlog.llm.quality import judge
from emberlog.llm.queries import SHARDS, WEIGHTS, domains, table
from emberlog.llm.sharding import shard
from emberlog.llm.staging import joined_evenly, written


def _whole(docs: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def _with_row(docs: DataFrame) -> DataFrame:
    """doc_id and text beside the whole row, so that added columns can't clash with it."""
    return docs.select(_whole(docs), "doc_id", "text")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no base rule and no learned rule rejects.

    Every row is judged by its own text; null and repeated ids don't matter, except that rows
    that share a labelled id are all learned from. Null and empty texts fail the base rules.
    """
    judged = judge(_with_row(docs), table(spark, sf_dir, "labels"), ["row"])
    return judged.where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked ones, whatever their ids: the one with the smallest, null as the largest.

    Rows are told apart by a hash of all their columns, so rows that share an id, null
    included, are judged one by one. Of rows equal in every column one is kept.
    """
    groups = written(linked_rows(docs, row_key=row_hash(docs)), "groups")
    row = F.struct("doc_id", "row_key")
    linked = groups.where("component is not null")
    first = written(linked.groupBy("component").agg(F.min(row).alias("first"), F.count("*").alias("n")).where("n > 1"), "first")
    later = joined_evenly(linked, first, ["component"], "inner", "row_key").where(row != F.col("first"))
    later = later.select("doc_id", "row_key").distinct()
    keyed = docs.select(_whole(docs), ids().alias("doc_id"), row_hash(docs).alias("row_key"))
    kept = keyed.join(later.hint("shuffle_hash"), ["doc_id", "row_key"], "left_anti").select("row.*")
    # Only a table that repeats a row pays for finding repeated rows.
    repeated = groups.groupBy("doc_id", "row_key").count().where("count > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates()


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Every row is judged by its own text, whatever its id. Null and empty texts contain nothing and stay.
    """
    found = with_matches(_with_row(docs).drop("doc_id"), table(spark, sf_dir, "benchmark"))
    return found.where(F.size("matches") == 0).select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at their fitted rates.

    Rows are drawn one by one, by a hash of all their columns, so rows that share an id or have
    none are told apart; rows equal in every column are drawn alike. Null and empty texts have no
    tokens, and a rate like any other.
    """
    keyed = docs.select(_whole(docs), "doc_id", "text", row_hash(docs).alias("row_key"))
    mixed = mix(keyed, domains(table(spark, sf_dir, "labels")), WEIGHTS, ["row", "row_key"])
    return mixed.where(copies(F.col("rate"), F.col("row_key")) > 0).select("row.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot.

    Rows are dealt by a hash of all their columns: null and repeated ids and empty texts are rows like any other.
    """
    return shard(docs, SHARDS)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixing),
    ("sharding", sharding),
]

#: Learned rules, link search and drawn rates have no SQL form; tests compare with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
