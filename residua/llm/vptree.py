"""Nearest neighbours by cosine: a vantage-point tree per shard, searched by blocks of queries.

Vectors are dealt to shards of about ``SHARD`` by a hash of the id, queries to blocks of about ``BLOCK``.  Each
(shard, block) pair is one task's work with a bounded amount of memory: it grows a tree over the shard and walks
all its queries down together.  The chord between unit vectors, sqrt(2 - 2 cos), is a metric, so by the
triangle inequality the far side of a node can hold nothing nearer than |d - radius|.  It is skipped if
that is more than the k-th distance so far divided by ``factor``: factor 1 searches exactly, larger
factors skip more and may miss neighbours.

Nearness is recomputed on the original vectors in double precision; ties go to the smaller id.  Vectors that are
null, zero or hold null or non-finite components take no part, and neither do vectors of another dimension than
the query's.  Rows with the same id are one vector.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from residua.llm.vectors import cosines, matrix, unit, usable
from residua.session import stored

SHARD = 4096
BLOCK = 2048
LEAF = 128
SLACK = 1e-9  # far above the rounding error of a distance


@dataclass
class Node:
    rows: np.ndarray | None = None  # of a leaf
    vantage: int = -1
    radius: float = 0.0
    inner: Node | None = None
    outer: Node | None = None


def grow(points: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> Node:
    """points: unit vectors.  The vantage point stays in the inner side."""
    if len(rows) <= leaf:
        return Node(rows=rows)
    vantage = int(rows[len(rows) // 2])
    away = chord(points[rows] @ points[vantage])
    radius = float(np.median(away))
    inside = away <= radius
    if inside.all():  # many at the same distance: nothing to divide
        inside = away < radius
        if not inside.any():
            return Node(rows=rows)
        radius = float(away[inside].max())
    return Node(None, vantage, radius, grow(points, rows[inside], leaf), grow(points, rows[~inside], leaf))


def chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


class Search:
    """The k nearest points of many queries in one tree."""

    def __init__(self, ids, points, query_ids, queries, k: int, factor: float, leaf: int = LEAF):
        self.ids, self.points, self.unit_points = ids, points, unit(points)
        self.query_ids, self.queries, self.unit_queries = query_ids, queries, unit(queries)
        self.k, self.factor = k, factor
        self.found_id = np.full((len(query_ids), k), np.iinfo(np.int64).max)
        self.found = np.full((len(query_ids), k), -np.inf)
        self.visit(grow(self.unit_points, np.arange(len(ids)), leaf), np.arange(len(query_ids)))

    def reach(self, q: np.ndarray) -> np.ndarray:
        worst = self.found[q, -1]
        return np.where(np.isfinite(worst), chord(worst), np.inf) / self.factor + SLACK

    def visit(self, node: Node, q: np.ndarray) -> None:
        if not len(q):
            return
        if node.rows is not None:
            self.look(node.rows, q)
            return
        away = chord(self.unit_queries[q] @ self.unit_points[node.vantage])
        near = away <= node.radius
        self.visit(node.inner, q[near])
        self.visit(node.outer, q[~near])
        gap = np.abs(away - node.radius)
        self.visit(node.outer, q[near & (gap <= self.reach(q))])
        self.visit(node.inner, q[~near & (gap <= self.reach(q))])

    def look(self, rows: np.ndarray, q: np.ndarray) -> None:
        rough = self.unit_queries[q] @ self.unit_points[rows].T
        rough[self.query_ids[q][:, None] == self.ids[rows][None, :]] = -np.inf
        least = np.maximum(self.found[q, -1], -2.0)
        if len(rows) > self.k:
            least = np.maximum(least, -np.partition(-rough, self.k - 1, axis=1)[:, self.k - 1])
        a, b = np.nonzero(rough >= (least - SLACK)[:, None])
        score = cosines(self.queries[q[a]], self.points[rows[b]])
        row = np.concatenate([np.repeat(np.arange(len(q)), self.k), a])
        value = np.concatenate([self.found[q].ravel(), score])
        name = np.concatenate([self.found_id[q].ravel(), self.ids[rows[b]]])
        order = np.lexsort((name, -value, row))
        row, value, name = row[order], value[order], name[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.k
        self.found[q[row[keep]], place[keep]] = value[keep]
        self.found_id[q[row[keep]], place[keep]] = name[keep]


def nearest(
    table: DataFrame, is_query: str, k: int = 5, factor: float = 1.0, id_col: str = "vec_id", vec_col: str = "embedding",
    shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of every query; ``is_query`` is a condition on ``id``."""
    points = stored(usable(table, id_col, vec_col), "vectors")
    n, n_queries = points.agg(F.count("*"), F.count(F.expr(f"CASE WHEN {is_query} THEN 1 END"))).first()
    shards, blocks = max(1, math.ceil(n / shard)), max(1, math.ceil(n_queries / block))
    deal = F.xxhash64("id")
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    each_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    sides = points.select("dim", F.pmod(deal, F.lit(shards)).cast("int").alias("shard"), each_block, "id", "vec")
    asked = points.where(is_query).select(
        "dim", each_shard, F.pmod(deal, F.lit(blocks)).cast("int").alias("block"), "id", "vec"
    )

    def work(_, here: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(here) or not len(asking):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        here = here.sort_values("id")
        s = Search(
            here["id"].to_numpy(np.int64), matrix(here["vec"]), asking["id"].to_numpy(np.int64), matrix(asking["vec"]),
            k, factor,
        )
        out = pd.DataFrame(
            {"query_id": np.repeat(s.query_ids, k), "vec_id": s.found_id.ravel(), "score": s.found.ravel()}
        )
        return out[np.isfinite(out["score"])]

    keys = ["dim", "shard", "block"]
    found = asked.groupBy(*keys).cogroup(sides.groupBy(*keys))
    found = found.applyInPandas(lambda key, a, b: work(key, b, a), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
