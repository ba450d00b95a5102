"""Operator 7: approximate nearest neighbours by collision counting over single projections.

For the largest inner product, vectors are scaled by the longest one and get one
more component, so that all lie on the unit sphere and the nearest point to a
query of length 1 is the one with the largest product. Rows are dealt into
blocks. A block keeps, for each of ``PROJECTIONS`` random lines, its vectors in
the order of their projections. Around a query's own projections windows open on
all lines and widen by ``WIDEN`` a turn (virtual rehashing); a vector counts the
lines on which it is inside. As soon as enough vectors count
``COLLISIONS`` of the lines, all of those are verified by their exact product.
Every block answers with its best ``k`` of them, and the best of all blocks stay.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import table
from tidemill.session import materialise

NEIGHBOURS = 20
PROJECTIONS = 64
#: Share of the lines on which a vector must be in the window.
COLLISIONS = 0.7
#: Half the first window, on the unit sphere, and how much wider each next one is.
FIRST = 0.8
WIDEN = 1.25
#: A query's windows stop widening in a block when this share of its vectors, and this many, would be verified.
VERIFY_SHARE = 0.2
VERIFY_LEAST = 1_500
#: Rows of a block, about. Places in it are 16-bit numbers and counts 8-bit ones.
BLOCK_ROWS = 8_192
QUERY_ROWS = 1_024


class Block:
    """Sorted projections of a block's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        unit = self.vectors / longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", unit, unit)))
        self.lines = np.random.default_rng(7).standard_normal((unit.shape[1] + 1, PROJECTIONS))
        places = unit @ self.lines[:-1] + rest[:, None] * self.lines[-1]
        by_line = np.argsort(places, axis=0)
        self.sorted = np.ascontiguousarray(np.take_along_axis(places, by_line, axis=0).T)
        #: Place of every vector in each line's order; a window is a range of places.
        self.place = np.empty((PROJECTIONS, len(ids)), np.int16)
        np.put_along_axis(self.place, by_line.T, np.arange(len(ids), dtype=np.int16)[None, :], axis=1)

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query id, vector id and exact product of each query's best ``k`` verified vectors."""
        n = len(self.ids)
        enough = min(n, max(VERIFY_LEAST, ceil(VERIFY_SHARE * n)) + k)
        least = ceil(COLLISIONS * PROJECTIONS)
        at = (queries / np.linalg.norm(queries, axis=1, keepdims=True)) @ self.lines[:-1]
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)
        active, half = np.arange(len(ids)), FIRST
        while len(active):
            low = np.stack([np.searchsorted(self.sorted[i], at[active, i] - half, "left") for i in range(PROJECTIONS)], axis=1)
            high = np.stack([np.searchsorted(self.sorted[i], at[active, i] + half, "right") for i in range(PROJECTIONS)], axis=1)
            still = []
            for row, q in enumerate(active.tolist()):
                # As unsigned numbers, places before the window are far beyond its width.
                into = (self.place - low[row, :, None].astype(np.int16)).view(np.uint16)
                inside = into < (high[row] - low[row]).astype(np.uint16)[:, None]
                hits = np.flatnonzero(np.add.reduce(inside, axis=0, dtype=np.uint8) >= least)
                if len(hits) < enough:
                    still.append(q)
                else:
                    found[q] = hits
            active, half = np.array(still, np.int64), half * WIDEN
        out: list[list[np.ndarray]] = [[], [], []]
        for q, own in enumerate(ids.tolist()):
            seen = found[q][self.ids[found[q]] != own]
            score = self.vectors[seen] @ queries[q]
            best = np.lexsort((self.ids[seen], -score))[:k] if len(seen) <= 4 * k else self._best(seen, score, k)
            out[0].append(np.full(len(best), own))
            out[1].append(self.ids[seen[best]])
            out[2].append(score[best])
        return tuple(np.concatenate(o) for o in out)

    def _best(self, seen: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Places of the k highest scores, equal ones by id."""
        floor = np.partition(score, len(score) - k)[len(score) - k]
        top = np.flatnonzero(score >= floor)
        return top[np.lexsort((self.ids[seen[top]], -score[top]))[:k]]


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = np.asarray(rows["id"])
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in rows["vector"].chunks])
    return ids, flat.astype(np.float64).reshape(len(ids), -1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id and vector (doubles) of the rows that take part, an id once."""
    whole = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("id"), whole.alias("vector")).where(
        F.col("id").isNotNull()
        & F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        & F.exists("vector", lambda x: F.coalesce(x != 0, F.lit(False)))
    )
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def nearest(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank (from 1), ``key`` and score: for each query the ``k`` found with the largest inner product.

    ``queries`` has the same two columns. Vectors that are null, empty, zero, or
    hold null or non-finite components take no part on either side, nor do null
    ids. An id stands for one vector: of rows that share it, the smallest vector.
    A query's own id is no candidate for it, nor are vectors of another length.
    Equal scores go by the smaller id. A query without candidates has no rows.
    Query blocks meet all row blocks, so the work is queries times rows.
    """
    base = materialise(usable(vectors, key, vector))
    asked = materialise(usable(queries, key, vector))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    n, longest = base.agg(F.count(F.lit(1)), F.max(norm)).first()
    blocks, turns = max(1, ceil(n / BLOCK_ROWS)), max(1, ceil(asked.count() / QUERY_ROWS))
    dim = F.size("vector").alias("dim")
    left = asked.select("id", "vector", dim, F.pmod(F.xxhash64("id"), F.lit(turns)).alias("turn"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = base.select("id", "vector", dim, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long"))).alias("turn"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))

    def meet(query_rows: pa.Table, base_rows: pa.Table) -> pa.Table:
        parts = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(query_rows) and len(base_rows):
            parts = Block(*_matrix(base_rows), longest).search(*_matrix(query_rows), k)
        return pa.table(dict(zip(["query_id", "id", "score"], parts)))

    by = ["dim", "turn", "block"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(meet, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")


def op7_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % 20 == 0))
