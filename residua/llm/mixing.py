"""Mixing sources to target weights by iterative proportional fitting.

Documents are cells of (source, language, topic); a cell weighs its tokens.  Raking multiplies the cells in turn so
that the sources, then the languages, then the topics have their target shares, ``sweeps`` times; the last margin
is met exactly, the others as closely as the sweeps bring them.  A cell's calibrated weight per token, divided by
the largest, is the probability to keep each of its documents: the expected tokens then have the raked shares,
and the sample is as large as that allows.  A document is kept if a number in [0, 1) that depends on its id
alone is below its probability.

Targets: a share per value of each margin, or by default the present token shares to the power ``TEMPER``, rescaled
to sum 1.  A value without a target, or with target 0, is not kept.  Documents are summed to cells before
anything is raked; the cells stay a table, written out every few sweeps.

Null source or language is the value ``(none)``.  A document without tokens weighs nothing and gets its cell's
probability; if its whole cell has no tokens, 1.  Rows that share an id share their fate.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residua.llm.packing import fraction, word_count
from residua.session import stored

MARGINS = ("source", "lang", "topic")
SWEEPS = 8
AT_ONCE = 4  # sweeps in one job
TEMPER = 0.85
NONE = "(none)"
#: A topic stands for the kind of text, told by the share of some characters among all.
TABLE, NUMBERS, SHOUT = 0.05, 0.05, 0.3


def profile(docs: DataFrame) -> dict[str, Column]:
    """The margins and the tokens of a document; all without nulls."""
    text = F.coalesce(docs["text"], F.lit(""))

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))

    topic = (
        F.when(share("[|]") >= TABLE, "table")
        .when(share("[0-9]") >= NUMBERS, "numbers")
        .when(share("[A-Z]") >= SHOUT, "shout")
        .otherwise("prose")
    )
    source, lang = (F.coalesce(docs[c].cast("string"), F.lit(NONE)) for c in ("source", "lang"))
    return {"source": source, "lang": lang, "topic": topic, "n_tokens": word_count(text)}


def tempered(cells: DataFrame, margin: str, power: float = TEMPER) -> DataFrame:
    shares = cells.groupBy(margin).agg(F.sum("n").alias("n"))
    raised = stored(shares.select(margin, F.pow(F.col("n"), F.lit(power)).alias("r")), "targets")
    whole = raised.agg(F.sum("r")).first()[0] or 1.0
    return raised.select(margin, (F.col("r") / F.lit(whole)).alias("target"))


def rake(
    cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, sweeps: int = SWEEPS
) -> DataFrame:
    """Cells (margins, n) with ``w``, the raked weights; n: tokens of the cell."""
    now = cells.withColumn("w", F.col("n").cast("double"))
    for margin in MARGINS:
        if targets and margin in targets:
            whole = sum(targets[margin].values())
            rows = [(value, share / whole) for value, share in targets[margin].items()]
            wanted = cells.sparkSession.createDataFrame(rows, f"{margin} string, target double")
        else:
            wanted = tempered(cells, margin)
        now = now.join(wanted, margin, "left").withColumnRenamed("target", f"to_{margin}")
    now = stored(now.fillna(0.0, [f"to_{m}" for m in MARGINS]), "raked")
    for k in range(sweeps):
        for margin in MARGINS:
            has = F.sum("w").over(Window.partitionBy(margin))
            step = F.when(has > 0, F.col("w") * (F.col(f"to_{margin}") / has)).otherwise(0.0)
            now = now.withColumn("w", step)
        if k % AT_ONCE == AT_ONCE - 1 or k == sweeps - 1:
            now = stored(now, "raked")
    return now.select(*MARGINS, "n", "w")


def probabilities(raked: DataFrame) -> DataFrame:
    """Cells with ``p``, the probability to keep a document."""
    rate = F.when(F.col("n") > 0, F.col("w") / F.col("n"))
    top = raked.agg(F.max(rate)).first()[0] or 0.0
    p = F.when(F.col("n") == 0, 1.0).otherwise(F.least(F.lit(1.0), rate / F.lit(top)) if top > 0 else F.lit(0.0))
    return raked.select(*MARGINS, "n", "w", p.alias("p"))


def chances(
    rows: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, sweeps: int = SWEEPS
) -> DataFrame:
    """(margins, p) from (margins, n_tokens) rows."""
    cells = stored(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("n")), "cells")
    return stored(probabilities(rake(cells, targets, sweeps)).select(*MARGINS, "p"), "chances")


def mix(
    docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, sweeps: int = SWEEPS
) -> DataFrame:
    """Every document with its cell, tokens, probability ``p`` and the decision ``keep``."""
    columns = [c.alias(name) for name, c in profile(docs).items()]
    rows = stored(docs.select("doc_id", *columns), "profiled")
    return rows.join(chances(rows, targets, sweeps), list(MARGINS)).select(
        "doc_id", *MARGINS, "n_tokens", "p", (fraction("doc_id") < F.col("p")).alias("keep")
    )


def sampled(
    docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, sweeps: int = SWEEPS
) -> DataFrame:
    """The kept documents, in the columns of ``docs``."""
    columns = profile(docs)
    found = chances(docs.select(*[c.alias(name) for name, c in columns.items()]), targets, sweeps)
    found = found.select(*[F.col(m).alias(f"__{m}") for m in MARGINS], F.col("p").alias("__p"))
    marked = docs.select("*", *[columns[m].alias(f"__{m}") for m in MARGINS])
    both = marked.join(found, [f"__{m}" for m in MARGINS])
    return both.where(fraction("doc_id") < F.col("__p")).select(*docs.columns)


def sql(sweeps: int = SWEEPS, table: str = "documents") -> str:
    """The same in DuckDB SQL, with one table per raking step."""

    def share(pattern: str) -> str:
        return f"(length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))) / greatest(length(t), 1)"

    steps, last = [], "start"
    for margin in MARGINS:
        steps.append(
            f"want_{margin} AS MATERIALIZED (SELECT {margin}, pow(n, {TEMPER}) / sum(pow(n, {TEMPER})) OVER () AS target "
            f"FROM (SELECT {margin}, sum(n) AS n FROM cells GROUP BY 1))"
        )
    for k in range(sweeps):
        for margin in MARGINS:
            name = f"s{k}_{margin}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.n, CASE WHEN h.has > 0 THEN "
                f"c.w * (g.target / h.has) ELSE 0 END AS w FROM {last} c "
                f"JOIN (SELECT {margin}, sum(w) AS has FROM {last} GROUP BY 1) h USING ({margin}) "
                f"JOIN want_{margin} g USING ({margin}))"
            )
            last = name
    return f"""
WITH texts AS (SELECT *, coalesce(text, '') AS t FROM {table}),
docs AS (
  SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
    CASE WHEN {share("[|]")} >= {TABLE} THEN 'table' WHEN {share("[0-9]")} >= {NUMBERS} THEN 'numbers'
      WHEN {share("[A-Z]")} >= {SHOUT} THEN 'shout' ELSE 'prose' END AS topic,
    CAST(len(regexp_extract_all(t, '[^ \\t\\n\\r]+')) AS BIGINT) AS n_tokens,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) / 281474976710656.0 AS u
  FROM texts),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens) AS n FROM docs GROUP BY ALL),
start AS (SELECT *, CAST(n AS DOUBLE) AS w FROM cells),
{", ".join(steps)},
top AS (SELECT max(CASE WHEN n > 0 THEN w / n END) AS top FROM {last}),
chances AS (
  SELECT source, lang, topic,
    CASE WHEN n = 0 THEN 1.0 WHEN top > 0 THEN least(1.0, w / n / top) ELSE 0.0 END AS p FROM {last}, top)
SELECT doc_id, source, lang, topic, n_tokens, round(p, 9) AS p, u < p AS keep
FROM docs JOIN chances USING (source, lang, topic)"""
