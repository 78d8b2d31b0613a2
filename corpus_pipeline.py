"""From raw documents to training shards in five stages, each a numbered operator with its decisions applied.

STAGES holds (name, function); a function takes (spark, docs, sf_dir) and returns the documents it keeps, with
all their columns. Each stage is written as Parquet and read again as the next one's docs. The last stage adds
where each document goes: shard, slot, size, text_crc32 and hilbert (columns of documents of these names give way).

Rows without doc_id pass the stages that decide by id. A mix that repeats a document repeats its row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlens.llm import decontaminate, minhash, mixing, quality, sharding
from claimlens.llm.common import saved, table

#: Sharding isn't native SQL and the classifier is trained, so no SQL gives these rows.
ORACLE_SQL = None

#: Percent of shingles that near copies share here: the general threshold of near-duplicate stages.
NEAR_PERCENT = 80
N_SHARDS = 24


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs but those whose doc_id is in ids (a column doc_id)."""
    gone = ids.select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def packed(docs: DataFrame) -> DataFrame:
    """The columns that stages work on, and each row whole in a struct, so no column of documents can clash with theirs."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return own.select("row.doc_id", "row.text", "row.source", "row.lang", "row")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is the classifier's threshold at least. Null and empty texts are scored like any
    (by the bias alone); repeated rows are judged alike; an empty table stays empty."""
    model = quality.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    # in the struct alone, so that a text goes to Python and back once
    rated = quality.scored(packed(docs).select("row"), model, "row")
    return rated.where(F.col("_score") >= quality.THRESHOLD).select("row.*")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest doc_id. Of rows that repeat a doc_id the one with the
    least hash of text, then of all columns, stays; null and blank texts and rows without doc_id are in no group."""
    groups = minhash.near_groups(docs.select("doc_id", "text"), NEAR_PERCENT)
    kept = without(docs, groups.where("doc_id <> component_id").select("doc_id"))
    if docs.groupBy("doc_id").count().where("doc_id is not null and count > 1").isEmpty():
        return kept
    rows = packed(kept).withColumn("_all", F.struct(F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"), F.xxhash64("row").alias("r")))
    first = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min_by("row", "_all").alias("row"))
    return first.select("row.*").unionByName(kept.where("doc_id is null"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found. Null and empty texts hold none; rows without doc_id stay."""
    found = decontaminate.contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return without(docs, found.select("doc_id"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it (0, 1, 2, ...). Texts without words are never taken; null is a source of
    its own; rows alike in doc_id and text share one decision."""
    out = mixing.mix(packed(docs))
    return out.select("row.*")


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard, slot, size, text_crc32 and place on the curve. Rows alike in all columns are
    interchangeable; of rows that share doc_id, text, source and lang the places go in the order of a hash of all columns."""
    rows = packed(docs).withColumns({"_key": F.xxhash64(F.coalesce("text", F.lit("")), "source", "lang"), "_all": F.xxhash64("row")})
    placed = sharding.shards(rows, N_SHARDS, "rows", ["doc_id", "_key"])
    added = ["shard", "slot", "size", "text_crc32", "hilbert"]
    same = F.row_number().over(Window.partitionBy("_pid", "_pkey").orderBy("shard", "slot"))
    places = placed.select(F.col("row.doc_id").alias("_pid"), F.col("row._key").alias("_pkey"), *added).withColumn("_pn", same)
    nth = F.row_number().over(Window.partitionBy("doc_id", "_key").orderBy("_all"))
    rows = rows.withColumn("_nth", nth).select("doc_id", "_key", "_nth", "row")
    out = rows.join(places, rows["doc_id"].eqNullSafe(places["_pid"]) & (rows["_key"] == places["_pkey"]) & (rows["_nth"] == places["_pn"]))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in added], *added)


STAGES = [
    ("quality_classifier", keep_good),
    ("minhash_near_dedup", keep_one_of_each_group),
    ("benchmark_decontamination", drop_benchmark),
    ("source_mixing", mix_sources),
    ("hilbert_sharding", cut_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
