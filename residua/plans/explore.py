"""The aggregates behind the exploratory figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residua.functions.scalar import (
    age_in_years,
    first_token,
    present,
    sql_text,
    utc_date,
    whole_months,
)
from residua.operators.boxes import box_outliers, box_stats, place_by
from residua.plans.model import Model
from residua.specs import Stage

RUN = "[a-zA-Z]+"


# --- tags


def _tag_texts(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Each distinct tag text once, with its row count; all tag counting starts from this.

    Rows are counted per item before they meet a text.
    """
    rated = rows.groupBy("item_id").agg(F.count("*").alias("n"))
    texts = rated.join(items.select("item_id", "tags"), "item_id").filter(F.col("tags").isNotNull())
    return texts.groupBy("tags").agg(F.sum("n").alias("n"))


def _substrings(run: Column, lengths: Column) -> Column:
    """All substrings of the run that have one of the lengths."""
    fitting = F.filter(lengths, lambda length: length <= F.length(run))
    return F.flatten(
        F.transform(
            fitting,
            lambda length: F.transform(
                F.sequence(F.lit(1), F.length(run) - length + 1),
                lambda start: F.substring(run, start, length),
            ),
        )
    )


def first_tokens(texts: DataFrame) -> DataFrame:
    """The distinct first alphabetic runs of the tag texts."""
    return texts.select(first_token("tags").alias("tag")).distinct().filter("tag IS NOT NULL")


def tag_frequency_first_token(rows: DataFrame, items: DataFrame) -> DataFrame:
    """``(tag, n)``, most frequent first: for each first token the rows whose text contains it.

    A token is one alphabetic run, so it can only lie inside an alphabetic run of the text.  The
    substrings of those runs that are as long as some token are joined with the tokens by equality: no text
    meets every token.
    """
    texts = _tag_texts(rows, items)
    tokens = first_tokens(texts)
    lengths = tokens.agg(F.collect_set(F.length("tag"))).scalar()  # as many as there are different lengths
    runs = texts.withColumn("lengths", lengths).select(
        "tags", "n", "lengths", F.explode(F.array_distinct(F.regexp_extract_all("tags", F.lit(RUN), F.lit(0)))).alias("run")
    )
    parts = runs.select("tags", "n", F.explode(_substrings(F.col("run"), F.col("lengths"))).alias("tag"))
    found = parts.join(tokens, "tag", "left_semi").distinct()
    return found.groupBy("tag").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "tag")


def tag_frequency(rows: DataFrame, items: DataFrame, separator: str = "|") -> DataFrame:
    """``(tag, n)`` over the separated tags of each text, most frequent first."""
    listed = F.array_distinct(F.split("tags", F.lit(f"\\Q{separator}\\E")))
    return (
        _tag_texts(rows, items)
        .select(F.explode(listed).alias("tag"), "n")
        .groupBy("tag")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "tag")
    )


# --- tag profiles of sampled users


def profiles(
    train: DataFrame,
    model: Model,
    name: str,
    sample: DataFrame,
    stages: Sequence[Stage],
    by: Sequence[str] = ("user_id",),
) -> DataFrame:
    """``(*by, tag, x)`` for the sampled users.

    ``x`` is the mean rating of the user's rows with the tag, less the global mean, the user
    effect, and the item effect averaged over *all* rows of the user.  Tags without rows are left
    out.  ``sample`` has the columns ``by`` and may name a user more than once.
    """
    users = model.users.select("user_id", F.col(f"b_u_{name}").alias("b_u"))
    items = model.items.select("item_id", "hits", F.col(f"b_i_{name}").alias("b_i"))
    chosen = sample.select("user_id").distinct()
    per_user = (
        train.join(chosen, "user_id", "left_semi")
        .join(items, "item_id", "left")
        .groupBy("user_id")
        .agg(
            F.avg("b_i").alias("b_i"),
            *[
                F.expr(
                    f"avg(CASE WHEN array_contains(hits, {model.tokens.index(stage.token)}) THEN rating END) AS mean_{i}"
                )
                for i, stage in enumerate(stages)
            ],
        )
    )
    base = F.lit(model.mu) + F.col("b_u") + F.col("b_i")
    # Wide to long by position: tag names may differ in case only, column names may not.
    pairs = ", ".join(
        f"struct({sql_text(stage.name)} AS tag, mean_{i} - base AS x)" for i, stage in enumerate(stages)
    )
    return (
        sample.join(per_user, "user_id")
        .join(users, "user_id", "left")
        .withColumn("base", base)
        .select(*by, F.expr(f"inline(array({pairs}))"))
        .filter(present("x"))
    )


def tag_boxes(profile: DataFrame, within: Sequence[str] = (), decimals: int | None = None) -> DataFrame:
    """Box statistics per tag, with the place of the tag in the order of medians."""
    return place_by(box_stats(profile, [*within, "tag"], "x", decimals), "median", within, decimals)


def tag_box_outliers(profile: DataFrame, decimals: int | None = None) -> DataFrame:
    return box_outliers(profile, ["tag"], "x", decimals)


def placed_by_median(profile: DataFrame, within: Sequence[str], decimals: int | None = None) -> DataFrame:
    """The profile rows with the place of their tag in the order of medians."""
    medians = profile.groupBy(*within, "tag").agg(F.percentile("x", F.lit(0.5)).alias("median"))
    return profile.join(place_by(medians, "median", within, decimals).drop("median"), [*within, "tag"])


# --- residual curves, all from one table of sums


def residual_sums(fitted: DataFrame) -> DataFrame:
    """``(date, year, total, n, known)``: residuals summed by day of rating and release year.

    One pass over the fitted rows (year, ts, residual); as many rows as days and years meet.
    """
    return fitted.groupBy(utc_date("ts").alias("date"), "year").agg(
        F.sum("residual").alias("total"), F.count("*").alias("n"), F.count("residual").alias("known")
    )


def _mean_of_sums() -> Column:
    """Unknown if one of the residuals is."""
    return F.when(F.sum("known") == F.sum("n"), F.sum("total") / F.sum("n"))


def residual_by_month(sums: DataFrame) -> DataFrame:
    """Mean residual by whole months since the first rating of all."""
    first = sums.agg(F.min("date")).scalar()
    return (
        sums.withColumn("first", first)
        .groupBy(whole_months(F.col("first"), F.col("date")).alias("month"))
        .agg(_mean_of_sums().alias("b"))
    )


def residual_by_age(sums: DataFrame) -> DataFrame:
    """Mean residual by the age of the item when it was rated; unknown and negative ages are left out."""
    age = age_in_years(F.col("date"), F.col("year")).alias("age")
    return sums.withColumn("age", age).filter("age >= 0").groupBy("age").agg(_mean_of_sums().alias("b"))


def residual_by_release_year(sums: DataFrame) -> DataFrame:
    """Mean residual and row count by release year, from the rows."""
    return sums.groupBy("year").agg(_mean_of_sums().alias("b"), F.sum("n").alias("n"))


def curve_long(year_effect: DataFrame) -> DataFrame:
    """``(year, key, value)`` with the raw mean and the smoothed curve."""
    renamed = year_effect.select("year", F.col("b").alias("mean"), "knn")
    return renamed.unpivot(["year"], ["mean", "knn"], "key", "value")
