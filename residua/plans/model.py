"""Fit, score and compare."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residua.functions.metrics import PROPAGATE, SKIP, rmse
from residua.functions.scalar import or_zero
from residua.operators import effects as E
from residua.operators.joins import dealt_for, natural_left_join
from residua.operators.knn import choose_k, knn_smooth
from residua.specs import Spec
from residua.session import dealt, parts_for, stored


@dataclass(frozen=True)
class Model:
    """Effect tables of one or more specs over the same train rows and tags.

    ``items`` (effects, places of the tags found and year per item), ``users`` and ``cells`` have one column or set
    of columns per spec, named after it.
    """

    specs: tuple[Spec, ...]
    mu: float
    items: DataFrame
    users: DataFrame
    cells: DataFrame

    def spec(self, name: str) -> Spec:
        return next(s for s in self.specs if s.name == name)

    @property
    def tokens(self) -> tuple[str, ...]:
        return self.specs[0].tokens


def fit(train: DataFrame, items: DataFrame, specs: Sequence[Spec]) -> Model:
    """Two passes over the train rows fit all specs: one per item, one per cell.

    The tables are stored, each is read more than once later.
    """
    specs = tuple(specs)
    if any(set(s.tokens) != set(specs[0].tokens) for s in specs):
        raise ValueError("specs fitted together must have the same tags")
    features = E.item_features(items, specs[0].tokens)
    table = stored(E.item_table(E.item_totals(train), features), "items")
    mu = E.global_mean(table).first()["mu"]
    effects = E.item_effects(table, F.lit(mu), specs)
    cells = stored(E.cells(train, effects, F.lit(mu), specs), "cells")
    users = stored(E.user_effects(cells, specs), "users")
    return Model(specs, mu, effects, users, cells)


def with_effects(rows: DataFrame, model: Model, names: Sequence[str]) -> DataFrame:
    """Two left joins, by item and by user, bring all effects of the named specs to the rows.

    The rows are counted first, so that the tasks of the joins need not grow with the table.
    """
    items = model.items.select("item_id", "hits", "year", *[f"b_i_{n}" for n in names])
    users = model.users.select(
        "user_id", *[f"b_u_{n}" for n in names], *[f"tags_{n}" for n in names]
    )
    count = rows.count()
    items, users = dealt_for(rows, count, items, "item_id"), dealt_for(rows, count, users, "user_id")
    return rows.join(items, "item_id", "left").join(users, "user_id", "left")


@dataclass(frozen=True)
class Variant:
    """What a prediction adds up, from which spec, and which missing parts count as zero."""

    method: str
    spec: str = ""
    item: bool = False
    user: bool = False
    tags: bool = False
    year: bool = False
    fill: frozenset[str] = field(default_factory=frozenset)

    def filled(self, *parts: str) -> Variant:
        return Variant(
            self.method, self.spec, self.item, self.user, self.tags, self.year, frozenset(parts)
        )


AVERAGE = Variant("average")
ITEM = Variant("item", "plain", item=True)
ITEM_USER = Variant("item + user", "plain", item=True, user=True)
TAGS_PLAIN = Variant("item + user + tags", "plain", item=True, user=True, tags=True)
TAGS_SHRUNK = Variant("shrunk item + user + tags", "shrunk", item=True, user=True, tags=True)
FULL = Variant("shrunk item + user + tags + year", "shrunk", True, True, True, True)
FINAL = FULL.filled("item", "user")
LEADERBOARD = (AVERAGE, ITEM, ITEM_USER, TAGS_PLAIN, TAGS_SHRUNK, FULL)


def prediction(model: Model, variant: Variant) -> Column:
    """Expression over rows that carry the effects (and ``knn`` if the variant has a year part)."""

    def part(name: str, value: Column) -> Column:
        return or_zero(value) if name in variant.fill else value

    total = F.lit(model.mu)
    if variant.item:
        total = total + part("item", F.col(f"b_i_{variant.spec}"))
    if variant.user:
        total = total + part("user", F.col(f"b_u_{variant.spec}"))
    if variant.tags:
        total = total + part("tags", E.tag_adjustment(model.spec(variant.spec), model.tokens))
    if variant.year:
        total = total + part("year", F.col("knn"))
    return total


def with_parts(
    rows: DataFrame, model: Model, variants: Sequence[Variant], year_effect: DataFrame | None = None
) -> DataFrame:
    names = list(dict.fromkeys(v.spec for v in variants if v.spec))
    joined = with_effects(rows, model, names)
    if any(v.year for v in variants):
        joined = natural_left_join(joined, year_effect.select("year", "knn"))
    return joined


def score(
    rows: DataFrame, model: Model, variant: Variant, year_effect: DataFrame | None = None
) -> DataFrame:
    """``rows`` with ``pred``."""
    joined = with_parts(rows, model, [variant], year_effect)
    return joined.select(*rows.columns, prediction(model, variant).alias("pred"))


def score_error(scored: DataFrame, policy: str = PROPAGATE) -> DataFrame:
    """One row with the RMSE of a scored table; rows without a known rating cannot be scored."""
    return E.rated(scored).agg(rmse(F.col("rating"), F.col("pred"), policy).alias("rmse"))


def leaderboard(
    rows: DataFrame,
    model: Model,
    variants: Sequence[Variant] = LEADERBOARD,
    year_effect: DataFrame | None = None,
) -> DataFrame:
    """``(place, method, rmse, rmse_4, rmse_scored, scored, missing)``, one row per variant.

    ``rmse`` is missing if any prediction is, and ``rmse_4`` is the same to four decimals;
    ``rmse_scored`` leaves those rows out.  All variants are scored in one pass.
    """
    joined = with_parts(E.rated(rows), model, variants, year_effect)
    predicted = joined.select(
        "rating", *[prediction(model, v).alias(f"pred_{i}") for i, v in enumerate(variants)]
    )
    measured = predicted.agg(
        F.array(
            *[
                F.struct(
                    F.lit(i + 1).alias("place"),
                    F.lit(v.method).alias("method"),
                    rmse(F.col("rating"), F.col(f"pred_{i}"), PROPAGATE).alias("rmse"),
                    F.round(rmse(F.col("rating"), F.col(f"pred_{i}"), PROPAGATE), 4).alias("rmse_4"),
                    rmse(F.col("rating"), F.col(f"pred_{i}"), SKIP).alias("rmse_scored"),
                    F.count(f"pred_{i}").alias("scored"),
                    (F.count("*") - F.count(f"pred_{i}")).alias("missing"),
                )
                for i, v in enumerate(variants)
            ]
        ).alias("board")
    )
    return measured.select(F.inline("board"))


# --- the fitted rows and the release-year curve


def fitted(train: DataFrame, model: Model, name: str) -> DataFrame:
    """The train rows with release year, the prediction of item, user and tags, and the residual."""
    variant = Variant("fitted", name, item=True, user=True, tags=True)
    joined = with_parts(E.rated(train), model, [variant])
    scored = joined.select(*train.columns, "year", prediction(model, variant).alias("pred"))
    return scored.withColumn("residual", F.col("rating") - F.col("pred"))


def year_residuals(model: Model, name: str) -> DataFrame:
    """``(year, b, n)``: mean residual and row count per release year, from the cells.

    One unknown residual makes the mean of its year unknown.
    """
    spec = model.spec(name)
    users = model.users.select("user_id", f"b_u_{name}", f"tags_{name}")
    tags = E.tag_adjustment(spec, model.tokens)
    left = F.col(f"left_{name}") - F.col("n") * (F.col(f"b_u_{name}") + tags)
    cells = model.cells.select("user_id", "hits", "year", "n", f"left_{name}")
    parts = parts_for(cells.count())
    per_cell = dealt(cells, parts, "user_id").join(dealt(users, parts, "user_id"), "user_id", "left")
    return (
        per_cell.select("year", "n", left.alias("left"))
        .groupBy("year")
        .agg(
            F.when(F.count("left") == F.count("*"), F.sum("left") / F.sum("n")).alias("b"),
            F.sum("n").alias("n"),
        )
    )


def year_effect(model: Model, name: str, k: int | None = None) -> DataFrame:
    """``(year, b, n, knn)``: the year curve smoothed over ``k`` neighbours, or the best ``k``."""
    groups = stored(year_residuals(model, name), "years")
    if k is None:
        best = choose_k(groups).first()
        k = best["k"] if best else 1  # a lone group is always drawn, so no k has an error
    return knn_smooth(groups, k)
