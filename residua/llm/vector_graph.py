"""Near-duplicate embeddings by a robust-pruned flat graph over overlapping cluster shards.

1. Vectors with the same components are one node.
2. Nodes are dealt to clusters ``DEALS`` times, each time around other centres, and each time to the ``NEAREST``
   nearest centres, so shards overlap.  Centres are nodes drawn by a hash, about one per ``SHARD`` / 2 nodes and
   at most ``CENTRES`` at once; where these are too few, shards are divided again around centres of
   their own.  Centres within the radius of another do not count, so groups of near copies stay whole;
   a shard over ``SHARD`` nodes is dealt to parts, and every two parts meet in one task, which loses no pair.
3. Each shard becomes a flat graph: every node's candidates (its nearest ones, and all within the radius however
   many) are pruned robustly: the nearest stays and removes those that are ``ALPHA`` times nearer to it
   than to the node.  Pruned edges within the radius are not capped.
   Nodes at distance 0 (scaled copies, float noise) take part as one, their first; it has edges to and from the others.
4. Every node is searched for: greedily from the medoid, then from what that found and from the node's
   own edges the search expands over all nodes within twice the radius.  Pruned paths get nearer by
   a factor at each step, so each node within the radius is reached inside that ball.
5. The adjacency lists found in all shards are united, and each link is verified by its cosine in double
   precision on the original vectors.  ``audit`` measures recall on a bounded sample against all rows.

A pair is missed only if no deal brings both into one shard; for cosines of 0.95 and more that is rarer than
1e-3 on vectors without any structure, and the audit shows it.

Vectors that are null, zero or hold null or non-finite components link with nothing, nor do vectors of
different dimensions.  Rows that share an id are one vector; a null id is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.llm.components import components
from residua.llm.vectors import cosines, matrix, unit, usable
from residua.session import stored

COSINE = 0.95
DEALS, NEAREST = 4, 2
SHARD = 1000
CENTRES = 1024
SALT_ROWS = 20_000
DEPTH = 4
ALPHA = 1.05
CANDIDATES, DEGREE = 32, 16
SAME = 1e-14  # vectors that are no further from cosine 1 have distance 0, but for the rounding of doubles
SLACK = 1e-6  # far above the rounding of a single-precision product of unit vectors
AUDIT = 200
BLOCK = 256  # rows pruned at once
SEARCHED = 64  # queries searched for at once


def distance(cosine):
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def nearest_centres(vectors: np.ndarray, centres: np.ndarray, cosine: float) -> np.ndarray:
    """The NEAREST nearest centres of each vector; centres linked with an earlier one do not count.

    So a group of near copies keeps one centre, and is not torn apart by centres of its own.
    """
    centres = unit(centres)
    near = centres @ centres.T >= cosine
    kept: list[int] = []
    for i in range(len(centres)):
        if not near[i, kept].any():
            kept.append(i)
    near = unit(vectors) @ centres[kept].T
    n = min(NEAREST, near.shape[1])
    return np.argpartition(-near, n - 1, axis=1)[:, :n]


def dealt(nodes: DataFrame, deal: int, shard_rows: int, cosine: float) -> DataFrame:
    """(node, vec, shard) rows: shard is a path of clusters.

    A shard is divided around at most CENTRES centres of its own; only where that many are too few, again.
    Rows meet the centres in tasks of about SALT_ROWS rows, so neither a large shard nor a table of
    all centres stands in one task.
    """
    kind = nodes.schema["vec"].dataType.simpleString()
    live = nodes.select("node", "vec", F.concat_ws("/", F.lit(str(deal)), F.col("dim").cast("string")).alias("shard"))
    done: DataFrame | None = None
    for level in range(DEPTH + 1):
        limit = shard_rows if not level else shard_rows * CENTRES // 2
        sizes = stored(live.groupBy("shard").agg(F.count("*").alias("here")), "shard-sizes")
        large = sizes.where(F.col("here") > limit)
        last = level == DEPTH or large.isEmpty()
        small = live if last else live.join(sizes.where(F.col("here") <= limit).select("shard"), "shard")
        small = small.select("node", "vec", "shard")
        done = small if done is None else done.union(small)
        if last:
            return done
        salts = F.ceil(F.col("here") / SALT_ROWS).cast("int")
        drawing = F.xxhash64("node", F.lit(deal), F.lit(level))
        want = F.least(F.lit(float(CENTRES)), F.ceil(2.0 * F.col("here") / shard_rows))
        rows = live.join(large, "shard").withColumn("salt", F.pmod(F.xxhash64("node"), salts).cast("int"))
        centre = F.pmod(drawing, F.lit(1 << 30)) < F.lit(float(1 << 30)) * want / F.col("here")
        centres = rows.where(centre).select(
            F.col("shard").alias("of"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("to"),
            F.col("node").alias("centre"), F.col("vec").alias("place"),
        )

        def divide(key, part: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
            out = [part.assign(shard=f"{key[0]}/")] if len(part) and not len(centres) else []
            if len(part) and len(centres):
                near = nearest_centres(matrix(part["vec"]), matrix(centres.sort_values("centre")["place"]), cosine)
                out = [part.assign(shard=[f"{key[0]}/{c}" for c in near[:, k]]) for k in range(near.shape[1])]
            columns = ["node", "vec", "shard"]
            return pd.concat(out)[columns] if out else pd.DataFrame(columns=columns)

        both = rows.groupBy("shard", "salt").cogroup(centres.groupBy("of", "to"))
        live = stored(both.applyInPandas(divide, f"node long, vec {kind}, shard string"), "shards")
    return done


def parted(shards: DataFrame, shard_rows: int) -> DataFrame:
    """Shards still too large are dealt to parts by a hash; key (shard, one, two) holds two parts."""
    sizes = shards.groupBy("shard").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("node", F.lit("part")), F.col("parts")).cast("int")
    rows = shards.join(sizes, "shard").withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # with two parts or more, a part meets itself in its pairs with others
    rows = rows.where("parts = 1 OR own <> other")
    return rows.select(
        "shard", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "node", "vec"
    )


class FlatGraph:
    """Robust-pruned neighbours of unit vectors: those of row i are ``edges[first[i]:first[i + 1]]``."""

    def __init__(self, points: np.ndarray, cosine: float):
        near = points @ points.T
        np.fill_diagonal(near, -2.0)
        leader = self.leaders(near >= 1.0 - SAME)
        # distances are worked out in double precision: single cosines are all 1 below a distance of 3e-4
        self.near, self.apart = near.astype(np.float32), distance(near).astype(np.float32)
        self.within = np.float32(cosine - SLACK)
        self.ball = np.float32(1.0 - (2.0 * distance(cosine)) ** 2 / 2.0 - SLACK)
        self.medoid = int((points @ points.mean(axis=0)).argmax())
        alone = leader == np.arange(len(points))
        self.heads, rest = np.flatnonzero(alone), np.flatnonzero(~alone)
        blocks = [np.stack([rest, leader[rest]]), np.stack([leader[rest], rest])]
        if len(self.heads) > 1:
            blocks += [self.prune(self.heads[i : i + BLOCK]) for i in range(0, len(self.heads), BLOCK)]
        rows, edges = np.concatenate(blocks, axis=1)
        order = np.argsort(rows, kind="stable")
        self.edges = edges[order]
        self.first = np.searchsorted(rows[order], np.arange(len(points) + 1))

    @staticmethod
    def leaders(same: np.ndarray) -> np.ndarray:
        """The first row of each row's group at distance 0; no two first rows are at distance 0."""
        leader = np.arange(len(same))
        for i in np.flatnonzero(same.any(axis=1)):
            if leader[i] == i:
                others = np.flatnonzero(same[i])
                leader[others[(others > i) & (leader[others] == others)]] = i
        return leader

    def candidates(self, rows: np.ndarray) -> np.ndarray:
        """The nearest CANDIDATES first rows of each row and all within the radius, nearest first."""
        whole = len(self.heads) == len(self.near)
        apart = self.apart[rows] if whole else self.apart[np.ix_(rows, self.heads)]
        near = self.near[rows] if whole else self.near[np.ix_(rows, self.heads)]
        inside = int((near >= self.within).sum(axis=1).max(initial=0))
        n = min(near.shape[1] - 1, max(CANDIDATES, inside))
        found = np.argpartition(apart, n - 1, axis=1)[:, :n]
        order = np.argsort(np.take_along_axis(apart, found, axis=1), axis=1, kind="stable")
        return self.heads[np.take_along_axis(found, order, axis=1)]

    def prune(self, rows: np.ndarray) -> np.ndarray:
        """Edges (from, to) of the rows.  Each step takes the nearest candidate left and drops those it stands for."""
        found = self.candidates(rows)
        away = np.take_along_axis(self.apart[rows], found, axis=1)
        inside = np.take_along_axis(self.near[rows], found, axis=1) >= self.within
        alive = np.ones(found.shape, bool)
        chosen_rows, chosen, steps = [], [], 0
        while True:
            left = alive.sum(axis=1)
            live = left > 0
            if not live.any():
                break
            if not live.all() or 2 * left.max() < found.shape[1]:
                order = np.argsort(~alive[live], axis=1, kind="stable")[:, : left.max()]
                rows = rows[live]
                found, away, inside, alive = (
                    np.take_along_axis(x[live], order, axis=1) for x in (found, away, inside, alive)
                )
            pick = alive.argmax(axis=1)
            one = found[np.arange(len(rows)), pick]
            chosen_rows.append(rows)
            chosen.append(one)
            between = self.apart[one[:, None], found]
            alive &= ALPHA * between > away
            alive[np.arange(len(rows)), pick] = False
            steps += 1
            if steps >= DEGREE:
                alive &= inside  # only edges within the radius go on
        return np.stack([np.concatenate(chosen_rows), np.concatenate(chosen)])

    def neighbours(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place of ``at`` all neighbours of that row: (place, neighbour)."""
        size = self.first[at + 1] - self.first[at]
        place = np.repeat(np.arange(len(at)), size)
        within = np.arange(len(place)) - np.repeat(np.cumsum(size) - size, size)
        return place, self.edges[self.first[at][place] + within]

    def greedy(self) -> np.ndarray:
        """The row that greedy search for each row ends at, starting from the medoid."""
        at = np.full(len(self.near), self.medoid)
        best = self.near[np.arange(len(at)), at].copy()
        moving = np.flatnonzero(at != np.arange(len(at)))
        while len(moving):
            place, option = self.neighbours(at[moving])
            value = self.near[moving[place], option].copy()
            value[option == moving[place]] = 2.0
            order = np.lexsort((-value, place))
            top = order[np.concatenate([[True], place[order][1:] != place[order][:-1]])]
            better = value[top] > best[moving[place[top]]]
            top = top[better]
            moving, step = moving[place[top]], option[top]
            best[moving] = value[top]
            at[moving] = step
            moving = moving[step != moving]
        return at

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (smaller row, larger row) found within the radius, by a search that expands over the ball."""
        end = self.greedy()
        found = []
        for i in range(0, len(end), SEARCHED):
            asked = np.arange(i, min(i + SEARCHED, len(end)))
            reached = self.expand(asked, end[asked])
            a, b = np.nonzero(reached & (self.near[asked] >= self.within))
            found.append(np.stack([np.minimum(asked[a], b), np.maximum(asked[a], b)]))
        a, b = np.concatenate(found, axis=1)
        return a, b

    def expand(self, asked: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Rows of the ball around each asked row that the search reaches, as a table of flags."""
        row = np.arange(len(asked))
        unseen = self.near[asked] >= self.ball
        query, node = np.concatenate([row, row]), np.concatenate([asked, end])
        keep = (asked[query] == node) | unseen[query, node]
        query, node = query[keep], node[keep]
        reached = np.zeros_like(unseen)
        reached[query, node] = True
        unseen[query, node] = False
        while len(query):
            place, option = self.neighbours(node)
            q = query[place]
            new = unseen[q, option]
            key = np.unique(q[new] * unseen.shape[1] + option[new])
            query, node = key // unseen.shape[1], key % unseen.shape[1]
            reached[query, node] = True
            unseen[query, node] = False
        return reached


def shard_links(rows: DataFrame, cosine: float) -> DataFrame:
    """(a, b), a < b: verified links of every shard."""

    def of(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node")
        vectors = matrix(part["vec"])
        if len(vectors) < 2:
            return pd.DataFrame({"a": [], "b": []})
        a, b = FlatGraph(unit(vectors), cosine).links()
        pairs = np.unique(a * len(vectors) + b)
        a, b = pairs // len(vectors), pairs % len(vectors)
        names = part["node"].to_numpy(np.int64)
        good = [cosines(vectors[a[i : i + 50_000]], vectors[b[i : i + 50_000]]) >= cosine for i in range(0, len(a), 50_000)]
        good = np.concatenate(good) if good else np.zeros(0, bool)
        return pd.DataFrame({"a": names[a[good]], "b": names[b[good]]})

    return rows.groupBy("shard", "one", "two").applyInPandas(of, "a long, b long")


def nodes_of(table: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, node) of every vector that counts, and (node, vec, dim, copies): the different vectors."""
    vectors = stored(usable(table, id_col, vec_col), "vectors")
    nodes = vectors.groupBy("vec", "dim").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    nodes = stored(nodes, "vector-nodes")
    return vectors.join(nodes.select("vec", "node", "copies"), "vec").select("id", "node", "copies"), nodes


def links_of(
    nodes: DataFrame, cosine: float = COSINE, deals: int = DEALS, shard_rows: int = SHARD
) -> DataFrame:
    """(a, b), a < b: links between different vectors."""
    found = None
    rows = nodes.select("node", "vec", "dim")
    for deal in range(deals):
        part = stored(shard_links(parted(dealt(rows, deal, shard_rows, cosine), shard_rows), cosine), "vector-links")
        found = part if found is None else found.union(part)
    return stored(found.distinct(), "vector-graph")


def near_vectors(
    table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE, deals: int = DEALS,
    shard_rows: int = SHARD,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector."""
    members, nodes = nodes_of(table, id_col, vec_col)
    links = links_of(nodes, cosine, deals, shard_rows)
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = nodes.select(F.col("node").alias("b"), "copies")
    linked = both.join(copies, "b").groupBy("a").agg(F.sum("copies").alias("others"))
    linked = linked.withColumnRenamed("a", "node")
    hung = components(links).withColumnRenamed("id", "node")
    counted = (
        members.join(linked, "node", "left")
        .join(hung, "node", "left")
        .select(
            "id",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    everyone = table.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL").distinct()
    out = everyone.join(counted, "id", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    return out.withColumn("kept", F.col(id_col) == F.col("component_id"))


def audit(nodes: DataFrame, links: DataFrame, cosine: float = COSINE, sample: int = AUDIT) -> tuple[int, int]:
    """Links that about ``sample`` nodes, drawn by a hash, have among all nodes, and how many were found."""
    n = nodes.count()
    draw = F.pmod(F.xxhash64("node", F.lit("audit")), F.lit(1 << 30)) < F.lit(float(1 << 30) * sample / max(1, n))
    drawn = nodes.where(draw).select("node", "vec", "dim").toPandas()
    asked = nodes.sparkSession.sparkContext.broadcast(drawn)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                here = asked.value[asked.value["dim"] == dim]
                if len(here):
                    q, v = matrix(here["vec"]), matrix(part["vec"])
                    a, b = np.nonzero(unit(q) @ unit(v).T >= cosine - SLACK)
                    good = cosines(q[a], v[b]) >= cosine
                    a, b = here["node"].to_numpy()[a[good]], part["node"].to_numpy()[b[good]]
                    yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    true = nodes.select("node", "vec", "dim").mapInPandas(of, "a long, b long").where("a <> b").distinct()
    true = stored(true, "audit")
    return true.count(), true.join(links, ["a", "b"]).count()
