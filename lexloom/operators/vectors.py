"""Vectors: similarity, exact top-k in blocks of queries, and an inverted index with measured recall."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Vectors of a block that is scored at once, and groups into which the rows of an exact search are parted.
BLOCK, GROUPS = 1024, 64


def dot(a: Column, b: Column) -> Column:
    pairs = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 for empty vectors, zero norms and unequal lengths."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (norms > 0), dot(a, b) / norms).otherwise(0.0)


def _packed(df: DataFrame, key: str, vector: str, group: list[Column]) -> DataFrame:
    """(group, dim, ids, data): rows of one group and dimension in blocks of at most BLOCK; null keys and vectors are left out."""
    kind = df.schema[key].dataType.simpleString()
    rows = df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
        F.concat_ws("/", *[g.cast("string") for g in group], F.size(vector).cast("string")).alias("g"), F.size(vector).alias("dim"), F.col(key).alias("k"), F.col(vector).cast("array<float>").alias("v")
    )
    # A group may be large: its rows are spread by a salt, and sorted only so that equal groups lie together.
    rows = rows.repartition("g", F.pmod(F.xxhash64("k"), F.lit(8))).sortWithinPartitions("g")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = np.array(batch.column(0).to_pylist(), object)
            ends = [*np.flatnonzero(groups[1:] != groups[:-1]) + 1, len(groups)]
            begin = 0
            for end in ends:
                for at in range(begin, end, BLOCK):
                    part = batch.slice(at, min(BLOCK, end - at))
                    columns = [pa.array([groups[at]]), part.column(1).slice(0, 1), pa.array([part.column(2).to_pylist()], pa.list_(part.column(2).type)), pa.array([part.column(3).flatten()], pa.list_(pa.float32()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["g", "dim", "ids", "data"])
                begin = end

    return rows.mapInArrow(run, f"g string, dim int, ids array<{kind}>, data array<float>")


def _best(pairs: DataFrame, key: str, kind: str, k: int, metric: str) -> DataFrame:
    """(query_id, rank, key, score) over pairs(qids, qdata, ids, data, dim) of blocks; each pair gives its best k, ties
    included, and the window takes the best before it shuffles."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                qids, ids = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                dim = batch.column(4)[i].as_py()
                a, b = (np.asarray(batch.column(c)[i].values, np.float64).reshape(-1, dim) for c in (1, 3))
                score = _scores(a, b, metric)
                order = -score if metric == "cosine" else score.copy()
                order[np.array(qids, object)[:, None] == np.array(ids, object)[None, :]] = np.inf
                last = min(k, order.shape[1]) - 1
                kth = np.partition(order, last, axis=1)[:, last]
                q, j = np.nonzero((order <= kth[:, None]) & np.isfinite(order))
                kinds = batch.column(0).type.value_type
                columns = [pa.array([qids[x] for x in q], kinds), pa.array([ids[x] for x in j], kinds), pa.array(score[q, j])]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", key, "score"])

    scored = pairs.select("qids", "qdata", "ids", "data", "dim").mapInArrow(run, f"query_id {kind}, `{key}` {kind}, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score") if metric == "cosine" else F.asc("score"), key)
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", key, "score")


def _scores(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """All scores of two blocks, rounded to 12 digits: their last bits depend on how the rows lie in blocks, and so would ties."""
    if metric != "cosine":
        return np.round(np.sqrt(np.maximum((a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1)[None, :], 0)), 12)
    scale = np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :]
    return np.round(np.divide(a @ b.T, scale, out=np.zeros_like(scale), where=scale > 0), 12)


def top_k(df: DataFrame, key: str, vector: str, queries: DataFrame, k: int, metric: str = "cosine") -> DataFrame:
    """(query_id, rank, key, score): each query against all rows of its dimension, exactly; ties by key; rows equal to the
    query's key are left out. Rows lie in GROUPS groups; each group meets every block of queries once, by a join on the group,
    so nothing is collected and nothing broadcast but what the planner finds small."""
    kind = df.schema[key].dataType.simpleString()
    rows = _packed(df, key, vector, [F.pmod(F.xxhash64(F.lit(13), F.col(key)), F.lit(GROUPS))])
    blocks = _packed(queries, key, vector, [F.pmod(F.xxhash64(F.lit(17), F.col(key)), F.lit(8))]).select(F.col("ids").alias("qids"), F.col("data").alias("qdata"), "dim")
    blocks = blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1)))).withColumn("g", F.concat_ws("/", "g", "dim"))
    return _best(rows.join(blocks.drop("dim"), "g"), key, kind, k, metric)


class Cells:
    """An inverted index: about the square root of the rows as k-means cells, fitted on at most ``sample`` rows, all rows
    assigned to their cell. How many cells a search probes is measured on the sample: the fewest with which it finds the share
    ``recall`` of its own true neighbours. Where vectors cluster these are few; where they don't, no fewer will do."""

    def __init__(self, df: DataFrame, key: str, vector: str, cells: int | None = None, sample: int = 20_000, seed: int = 5, recall: float = 0.95, k: int = 10):
        self.key, self.vector = key, vector
        rows = df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(key, vector)
        head = rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(sample).collect()
        data = np.array([r[1] for r in head], np.float64)
        n = cells or int(min(max(4, round(rows.count() ** 0.5)), max(4, len(data) // 20)))
        rng = np.random.default_rng(seed)
        centres = data[rng.choice(len(data), min(n, len(data)), replace=False)] if len(data) else np.zeros((0, 0))
        for _ in range(15):
            if not len(data):
                break
            nearest = self._distances(data, centres).argmin(1)
            centres = np.array([data[nearest == c].mean(0) if (nearest == c).any() else centres[c] for c in range(len(centres))])
        self.centres = centres
        self.probes = self._probes(data, k, recall)

    @staticmethod
    def _distances(data: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return (data**2).sum(1)[:, None] - 2 * data @ centres.T + (centres**2).sum(1)[None, :]

    def _probes(self, data: np.ndarray, k: int, recall: float, most: int = 500) -> int:
        """The fewest cells in which at most ``most`` rows of the sample find the share ``recall`` of their neighbours."""
        if len(data) <= k:
            return max(1, len(self.centres))
        asked = data[:most]
        score = _scores(asked, data, "cosine")
        score[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
        true = np.argpartition(-score, k, axis=1)[:, :k]
        home = self._distances(data, self.centres).argmin(1)
        rank = np.argsort(np.argsort(self._distances(asked, self.centres), axis=1), axis=1)
        needed = np.sort(np.take_along_axis(rank, home[true], axis=1).ravel())
        return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1

    def save(self, spark, path: str) -> None:
        """Writes the centres (as many rows as there are cells)."""
        rows = [(i, [float(x) for x in c], self.probes) for i, c in enumerate(self.centres)]
        spark.createDataFrame(rows, "cell int, centre array<double>, probes int").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str, key: str, vector: str) -> Cells:
        cells = cls.__new__(cls)
        cells.key, cells.vector = key, vector
        rows = spark.read.parquet(path).orderBy("cell").collect()
        cells.centres = np.array([r.centre for r in rows], np.float64)
        cells.probes = rows[0].probes if rows else 1
        if [r.cell for r in rows] != list(range(len(rows))) or len({len(r.centre) for r in rows}) > 1:
            raise ValueError(f"{path} is no whole index")
        return cells

    def assigned(self, df: DataFrame, probes: int = 1) -> DataFrame:
        """(key, vector, cell): each row with its ``probes`` nearest cells."""
        centres, key, vector = self.centres, self.key, self.vector

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                data = np.array(batch.column(1).to_pylist(), np.float64)
                near = np.argsort(Cells._distances(data, centres), axis=1)[:, :probes]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near.astype(np.int32).tolist(), pa.list_(pa.int32()))], names=[key, vector, "cells"])

        schema = f"`{key}` {df.schema[key].dataType.simpleString()}, `{vector}` {df.schema[vector].dataType.simpleString()}, cells array<int>"
        rows = df.filter(F.col(key).isNotNull() & (F.size(vector) == self.centres.shape[1])).select(key, vector)
        return rows.mapInArrow(run, schema).select(key, vector, F.explode("cells").alias("cell"))

    def search(self, df: DataFrame, queries: DataFrame, k: int, probes: int | None = None) -> DataFrame:
        """(query_id, rank, key, score) by cosine within the probed cells, whose rows and queries meet block by block."""
        kind = df.schema[self.key].dataType.simpleString()
        rows = _packed(self.assigned(df), self.key, self.vector, [F.col("cell")])
        asked = _packed(self.assigned(queries, probes or self.probes), self.key, self.vector, [F.col("cell")])
        asked = asked.select("g", F.col("ids").alias("qids"), F.col("data").alias("qdata"))
        return _best(rows.join(asked, "g"), self.key, kind, k, "cosine")


def embedded(chunks: DataFrame, model, name: str, batch: int = 256) -> DataFrame:
    """(vector_id, chunk_id, document_id, embedding_model, dimension, vector) of chunks(chunk_id, document_id, text).

    ``model()`` is called once per task and returns a function from a list of texts to a matrix; null texts are left
    out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = model()
        for rows in batches:
            for i in range(0, rows.num_rows, batch):
                part = rows.slice(i, batch)
                vectors = np.asarray(encode(part.column(2).to_pylist()), np.float32)
                ids = [f"{name}_{c}" for c in part.column(0).to_pylist()]
                columns = [pa.array(ids), part.column(0), part.column(1), pa.array([name] * len(ids)), pa.array([vectors.shape[1]] * len(ids), pa.int32()), pa.array(vectors.tolist(), pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["vector_id", "chunk_id", "document_id", "embedding_model", "dimension", "vector"])

    schema = "vector_id string, chunk_id string, document_id string, embedding_model string, dimension int, vector array<float>"
    return chunks.select("chunk_id", "document_id", "text").filter("text is not null").mapInArrow(run, schema)
