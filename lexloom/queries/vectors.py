"""Similarity searches: every row whose id is divisible by 20 against all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexloom.operators import vectors as V
from lexloom.queries.catalogue import query


@query("embeddings", sql="""
with q as (select vec_id as query_id, embedding as e from embeddings where vec_id % 20 = 0),
s as (select query_id, vec_id, list_cosine_similarity(cast(e as double[]), cast(embedding as double[])) as score from q join embeddings on query_id <> vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank, vec_id, round(score, 6) as score from r where rank <= 10""")
def cosine_top_k(embeddings: DataFrame) -> DataFrame:
    return V.top_k(embeddings, "vec_id", "embedding", embeddings.filter("vec_id % 20 = 0"), 10).withColumn("score", F.round("score", 6))


@query("embeddings", sql="""
with q as (select vec_id as query_id, embedding as e from embeddings where vec_id % 20 = 0),
s as (select query_id, vec_id, list_distance(cast(e as double[]), cast(embedding as double[])) as score from q join embeddings on query_id <> vec_id),
r as (select *, row_number() over (partition by query_id order by score, vec_id) as rank from s)
select query_id, rank, vec_id, round(score, 5) as score from r where rank <= 10""")
def distance_top_k(embeddings: DataFrame) -> DataFrame:
    return V.top_k(embeddings, "vec_id", "embedding", embeddings.filter("vec_id % 20 = 0"), 10, "l2").withColumn("score", F.round("score", 5))


def _indexed(embeddings: DataFrame) -> DataFrame:
    cells = V.Cells(embeddings, "vec_id", "embedding")
    return cells.search(embeddings, embeddings.filter("vec_id % 20 = 0"), 10)


@query("embeddings")
def indexed_top_k(embeddings: DataFrame) -> DataFrame:
    """Search in an inverted index; indexed_recall compares it with the exact search."""
    return _indexed(embeddings)


@query("embeddings", sql="""
select count(*) as queries, true as enough from embeddings where vec_id % 20 = 0""")
def indexed_recall(embeddings: DataFrame) -> DataFrame:
    """Whether the index finds nine tenths of the true neighbours, over all queries and rows."""
    queries = embeddings.filter("vec_id % 20 = 0")
    exact = V.top_k(embeddings, "vec_id", "embedding", queries, 10).select("query_id", "vec_id")
    found = _indexed(embeddings).select("query_id", "vec_id", F.lit(1).alias("found"))
    joined = exact.join(found, ["query_id", "vec_id"], "left")
    return joined.agg(F.countDistinct("query_id").alias("queries"), (F.count("found") >= 0.9 * F.count(F.lit(1))).alias("enough"))


@query("embeddings", sql="""
with x as (select label, unnest(embedding) as v, generate_subscripts(embedding, 1) as i from embeddings)
select label, cast(i - 1 as int) as i, round(avg(cast(v as double)), 6) as mean, count(*) as n from x group by label, i""")
def label_centroids(embeddings: DataFrame) -> DataFrame:
    rows = embeddings.select("label", F.posexplode("embedding").alias("i", "v"))
    return rows.groupBy("label", "i").agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("mean"), F.count(F.lit(1)).alias("n"))
