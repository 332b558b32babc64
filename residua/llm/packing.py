"""Packing texts into padded batches: optimal length buckets, then batches of a token budget.

The histogram of all lengths goes to the driver: one row per distinct length.  Distinct lengths add up to at most
all tokens, so there are at most sqrt(2 x tokens) of them (0.6 million for 2e11 tokens, and far fewer in any real
corpus).  Dynamic programming over it finds the ``buckets`` boundaries with the least padding when
every text is padded to its bucket's boundary; among equals, the leftmost cut counts at every step.

A batch of a bucket holds floor(budget / boundary) texts, at least one.  Places within a bucket are counted
without bringing a bucket into one task: rows are dealt to salts by a hash of their id, ranked within (bucket, salt),
and shifted by the counts of the salts before.

A null length counts as 0.  Rows with the same id stand next to each other; a null id is an id of its own.
Other columns do not matter.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residua.session import stored

BUCKETS = 8
BUDGET = 16_384
SALT_ROWS = 100_000


def word_count(text: Column) -> Column:
    """Number of runs without space, tab or line break; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\r]+")), F.lit(0)).cast("long")


def fraction(id_col: str) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    digits = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 48))


def best_cuts(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper boundaries of at most ``buckets`` buckets with the least padding; lengths ascending.

    cost[j] = least padded size of the first j lengths.  The best last cut moves right with j, so each
    layer is filled by halving: the middle first, then either side within the cuts it leaves open.
    """
    n = len(lengths)
    if not n:
        return []
    before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    cost = np.full(n + 1, np.iinfo(np.int64).max // 4)
    cost[0] = 0
    layers = []
    for _ in range(min(buckets, n)):
        after = np.full_like(cost, np.iinfo(np.int64).max // 4)
        cut = np.zeros(n + 1, np.int64)
        todo = [(1, n, 0, n - 1)]
        while todo:
            low, high, left, right = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            stop = min(right, j - 1)
            values = cost[left : stop + 1] + lengths[j - 1] * (before[j] - before[left : stop + 1])
            k = int(values.argmin())
            after[j], cut[j] = values[k], left + k
            todo += [(low, j - 1, left, left + k), (j + 1, high, left + k, right)]
        layers.append((after, cut))
        cost = after
    used = min(range(len(layers)), key=lambda b: layers[b][0][n])
    ends, j = [], n
    for b in range(used, -1, -1):
        ends.append(int(lengths[j - 1]))
        j = int(layers[b][1][j])
    return ends[::-1]


def pack(rows: DataFrame, id_col: str = "doc_id", buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """(id, n_tokens, bucket, pad_to, batch, slot) for (id, n_tokens) rows.

    bucket counts from 0 by length; batch counts from 0 within its bucket; slot from 0 within its batch.
    """
    # written out, as it is read three times and may be counted from texts
    lengths = rows.select(id_col, F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"))
    rows = stored(lengths, "lengths")
    histogram = rows.groupBy("n_tokens").agg(F.count("*").alias("n")).toPandas().sort_values("n_tokens")
    cuts = best_cuts(histogram["n_tokens"].to_numpy(np.int64), histogram["n"].to_numpy(np.int64), buckets)
    salts = max(1, math.ceil(int(histogram["n"].sum()) / SALT_ROWS))
    bucket = sum((F.when(F.col("n_tokens") > cut, 1).otherwise(0) for cut in cuts[:-1]), F.lit(0))
    pad_to = F.element_at(F.array(*[F.lit(c).cast("long") for c in cuts or [0]]), F.col("bucket") + 1)
    dealt = rows.select(
        "*", bucket.cast("int").alias("bucket"), F.floor(fraction(id_col) * salts).cast("int").alias("salt")
    )
    counts = dealt.groupBy("bucket", "salt").agg(F.count("*").alias("here"))
    so_far = F.sum("here").over(Window.partitionBy("bucket").orderBy("salt"))
    shift = counts.select("bucket", "salt", (so_far - F.col("here")).alias("shift"))
    place = F.row_number().over(Window.partitionBy("bucket", "salt").orderBy(id_col, "n_tokens")) - 1
    placed = dealt.withColumn("place", place).join(shift, ["bucket", "salt"]).withColumn("pad_to", pad_to)
    capacity = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("pad_to", F.lit(1)))).cast("long")
    at = F.col("place") + F.col("shift")
    return placed.select(
        id_col, "n_tokens", "bucket", "pad_to", F.floor(at / capacity).cast("long").alias("batch"),
        (at % capacity).cast("long").alias("slot"),
    )


def sql(buckets: int = BUCKETS, budget: int = BUDGET, table: str = "documents") -> str:
    """The same in DuckDB SQL: the dynamic program with one table per layer, every cut tried."""
    layers = ["layer1 AS MATERIALIZED (SELECT j, l * c AS cost, 0 AS cut FROM hist)"]
    for b in range(2, buckets + 1):
        layers.append(
            f"layer{b} AS MATERIALIZED (SELECT j, m.cost AS cost, m.cut AS cut FROM (SELECT h.j, "
            f"min({{'cost': p.cost + h.l * (h.c - g.c), 'cut': g.j}}) AS m FROM hist h JOIN hist g ON g.j < h.j "
            f"JOIN layer{b - 1} p ON p.j = g.j GROUP BY h.j))"
        )
    ends = [f"SELECT {b} AS b, cost FROM layer{b} WHERE j = (SELECT max(j) FROM hist)" for b in range(1, buckets + 1)]
    walk = " UNION ALL ".join(f"SELECT {b} AS b, j, cut FROM layer{b}" for b in range(1, buckets + 1))
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+')) AS BIGINT) AS n_tokens,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) / 281474976710656.0 AS u
  FROM {table}),
hist AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY n_tokens) AS BIGINT) AS j, n_tokens AS l,
    CAST(sum(count(*)) OVER (ORDER BY n_tokens) AS BIGINT) AS c FROM docs GROUP BY n_tokens),
{", ".join(layers)},
cuts AS MATERIALIZED ({walk}),
used AS (SELECT b FROM ({" UNION ALL ".join(ends)}) ORDER BY cost, b LIMIT 1),
path AS (
  SELECT c.b, c.j, c.cut FROM cuts c JOIN used u ON c.b = u.b WHERE c.j = (SELECT max(j) FROM hist)
  UNION ALL SELECT c.b, c.j, c.cut FROM path p JOIN cuts c ON c.b = p.b - 1 AND c.j = p.cut WHERE p.b > 1),
ends AS (
  SELECT CAST(row_number() OVER (ORDER BY p.j) - 1 AS INTEGER) AS bucket, h.l AS pad_to,
    coalesce(lag(h.l) OVER (ORDER BY p.j), -1) AS above FROM path p JOIN hist h ON h.j = p.j),
salted AS (SELECT d.*, floor(u * ceil((SELECT count(*) FROM docs) / {SALT_ROWS}.0)) AS salt FROM docs d),
placed AS (
  SELECT s.*, e.bucket, e.pad_to,
    row_number() OVER (PARTITION BY e.bucket ORDER BY salt, doc_id NULLS FIRST, n_tokens) - 1 AS pos,
    greatest(1, CAST(floor({budget} / greatest(e.pad_to, 1)) AS BIGINT)) AS capacity
  FROM salted s JOIN ends e ON s.n_tokens > e.above AND s.n_tokens <= e.pad_to)
SELECT doc_id, n_tokens, bucket, pad_to, CAST(pos // capacity AS BIGINT) AS batch, CAST(pos % capacity AS BIGINT) AS slot
FROM placed"""
