"""Choosing penalties: the hold-out error of every candidate in one pass.

With ``b = total / (n + penalty)`` the squared error over the held-out rows of a key is
``sum(e^2) - 2 b sum(e) + m b^2``.  So a key needs five numbers, whatever the candidates are, and
each candidate is one more sum over keys.  Nothing is refitted and no rows are multiplied.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from residua.functions.scalar import grid
from residua.operators import effects as E
from residua.session import dealt, stored
from residua.specs import Spec

PENALTIES = tuple(grid(0, 30))  # fixed values: 0, 1, ..., 30
WRITTEN_EVERY = 4  # stages


def candidate_errors(keys: DataFrame, penalties: Sequence[float]) -> DataFrame:
    """``(penalty, rmse)``.

    ``keys`` has per key the train ``left`` and ``n``, the held-out ``m``, ``e`` and ``e2``, and
    ``fixed``, the squared error of held-out rows that the effect does not touch.  With held-out
    rows of a key that has no train rows the error is unknown.
    """
    values = [float(p) for p in penalties]
    based = keys.selectExpr("*", "CASE WHEN n > 0 THEN left END AS total")
    errors = based.agg(
        F.sum("rows").alias("rows"),
        F.sum("fixed").alias("fixed"),
        F.expr("count_if(m > 0 AND total IS NULL)").alias("unknown"),
        *[
            F.expr(f"sum(e2 - 2 * total / (n + {p!r}D) * e + m * pow(total / (n + {p!r}D), 2)) AS sse_{i}")
            for i, p in enumerate(values)
        ],
    )
    pairs = ", ".join(
        f"struct({p!r}D AS penalty, coalesce(sse_{i}, 0D) AS sse)" for i, p in enumerate(values)
    )
    rmse = F.sqrt((F.col("sse") + F.col("fixed")) / F.nullif(F.col("rows"), F.lit(0)))
    return errors.select("rows", "fixed", "unknown", F.expr(f"inline(array({pairs}))")).select(
        "penalty", F.when(F.col("unknown") == 0, rmse).alias("rmse")
    )


def _sums_by_rows(keys: DataFrame) -> list[Row]:
    """What the errors of any grid follow from: sums over the keys with the same number of train rows.

    With N train rows there are at most sqrt(2 N) such numbers, so the driver can take them.
    """
    return (
        keys.groupBy(F.coalesce("n", F.lit(0)).alias("n"))
        .agg(
            F.sum("rows").alias("rows"),
            F.sum(F.col("fixed") + F.col("e2")).alias("fixed"),
            F.expr("count_if(m > 0 AND (n > 0 AND left IS NOT NULL) IS NOT TRUE)").alias("unknown"),
            F.sum(F.col("left") * F.col("e")).alias("le"),
            F.sum(F.col("m") * F.col("left") * F.col("left")).alias("mll"),
        )
        .collect()
    )


def _best_of_sums(sums: Sequence[Row], penalties: Sequence[float]) -> tuple[float, float | None]:
    """The penalty with the lowest error and that error; the lower penalty if two are equal."""
    rows = sum(r["rows"] or 0 for r in sums)
    if not rows or any(r["unknown"] for r in sums):
        return float(min(penalties)), None
    fixed = math.fsum(r["fixed"] or 0.0 for r in sums)
    tagged = [(r["n"], r["le"] or 0.0, r["mll"] or 0.0) for r in sums if r["n"] > 0]

    def rmse(p: float) -> float:
        moved = math.fsum(mll / (n + p) ** 2 - 2 * le / (n + p) for n, le, mll in tagged)
        return math.sqrt(max(0.0, fixed + moved) / rows)

    error, penalty = min((rmse(float(p)), float(p)) for p in penalties)
    return penalty, error


def best_penalty(errors: DataFrame) -> DataFrame:
    """One row: the lowest error, and the lower penalty if two are equal."""
    return errors.orderBy(F.asc_nulls_last("rmse"), "penalty").limit(1)


def _both(train: DataFrame, test: DataFrame) -> DataFrame:
    columns = ["user_id", "item_id", "rating"]
    return (
        E.rated(train)
        .select(*columns)
        .withColumn("fits", F.lit(True))
        .unionByName(E.rated(test).select(*columns).withColumn("fits", F.lit(False)))
    )


def _key_sums(error: Column) -> list[Column]:
    """Aggregates of a key from rows of both sides."""
    fits = F.col("fits")
    return [
        F.coalesce(F.sum(F.when(fits, error)), F.lit(0.0)).alias("left"),
        F.count_if(fits).alias("n"),
        F.coalesce(F.sum(F.when(~fits, error)), F.lit(0.0)).alias("e"),
        F.count_if(~fits).alias("m"),
        F.coalesce(F.sum(F.when(~fits, error * error)), F.lit(0.0)).alias("e2"),
    ]


def sweep_item(
    train: DataFrame, test: DataFrame, mu: float, penalties: Sequence[float] = PENALTIES
) -> DataFrame:
    """Errors of the item effect; ``mu`` is where both sides are centred."""
    keys = (
        _both(train, test).groupBy("item_id").agg(*_key_sums(F.col("rating") - F.lit(mu)))
    )
    return candidate_errors(keys.select("*", F.col("m").alias("rows"), F.lit(0.0).alias("fixed")), penalties)


def item_effect(train: DataFrame, features: DataFrame, mu: float, penalty: float) -> DataFrame:
    """``(item_id, hits, b_i, n)``, stored: so the cells know how many rows the items have."""
    total = F.col("total") - F.col("n") * F.lit(mu)
    effect = E.shrunken(total, F.col("n"), penalty).alias("b_i")
    return stored(E.item_totals(train).join(features, "item_id", "full").select("item_id", "hits", effect, "n"), "item-effect")


def tuning_cells(train: DataFrame, test: DataFrame, mu: float, items: DataFrame) -> DataFrame:
    """Train and held-out sums per user and set of tags, after the item effect.

    ``items`` has ``hits``, ``b_i`` and ``n``.  ``lost`` counts the held-out rows with unknown tags.
    """
    error = F.col("rating") - F.lit(mu) - F.col("b_i")
    met, parts = E.met_by_item(_both(train, test), items.select("item_id", "hits", "b_i"), items)
    return (
        dealt(met.select("user_id", "hits", "fits", error.alias("error")), parts, "user_id", "hits")
        .groupBy("user_id", "hits")
        .agg(*_key_sums(F.col("error")))
        .withColumn("lost", F.when(F.col("hits").isNull(), F.col("m")).otherwise(0))
    )


def sweep_user(cell_rows: DataFrame, penalties: Sequence[float] = PENALTIES) -> DataFrame:
    """Errors of the user effect, from the cells."""
    keys = cell_rows.groupBy("user_id").agg(
        *[F.sum(c).alias(c) for c in ("left", "n", "e", "m", "e2")]
    )
    return candidate_errors(keys.select("*", F.col("m").alias("rows"), F.lit(0.0).alias("fixed")), penalties)


def tuning_slots(cell_rows: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Per user the train and held-out sums per tag and pair of tags."""
    return E.slot_sums(cell_rows, tokens, ["left", "e", "e2", "lost"], ["n", "m"])


# --- tag stages, one after another
#
# The state of a user is what the stages so far have left: per tag the sums of the train and held-out rows that have
# it, and the squared error of all held-out rows.  Choosing a stage's penalty moves the sums of the tags that share
# rows with it, once; nothing is solved again.

STATE = ["rows", "lost", "fixed", "some", "n", "m", "left", "e", "n_with", "m_with"]
SWEPT = ["key_left", "key_n", "key_e", "key_m"]


def tag_state(slots: DataFrame, spec: Spec) -> DataFrame:
    """One row per user after the user effect, before any tag stage; arrays run over the tokens of the spec.

    ``n_with`` and ``m_with`` split the rows of a tag by the other tags, NULL for a tag without rows.
    """
    whole = F.col("slots")[E.ALL_ROWS]
    placed = slots.select(whole.alias("whole"), F.transform(F.sequence(F.lit(0), F.lit(len(spec.tokens) - 1)), lambda i: F.col("slots")[i]).alias("s"))
    b_u = E.shrunken(F.col("whole.left"), F.col("whole.n"), spec.user_penalty)
    placed = placed.withColumn("b_u", b_u)
    b_u = F.col("b_u")

    def each(value: Callable[[Column], Column], empty: Column) -> Column:
        return F.transform("s", lambda slot: F.coalesce(value(slot), empty))

    return placed.select(
        F.col("whole.m").alias("rows"),
        F.col("whole.lost").alias("lost"),
        (F.col("whole.e2") - 2 * b_u * F.col("whole.e") + F.col("whole.m") * b_u * b_u).alias("fixed"),
        F.lit(False).alias("some"),
        each(lambda slot: slot["n"], F.lit(0).cast("bigint")).alias("n"),
        each(lambda slot: slot["m"], F.lit(0).cast("bigint")).alias("m"),
        each(lambda slot: slot["left"] - slot["n"] * b_u, F.lit(0.0)).alias("left"),
        each(lambda slot: slot["e"] - slot["m"] * b_u, F.lit(0.0)).alias("e"),
        F.transform("s", lambda slot: slot["n_with"]).alias("n_with"),
        F.transform("s", lambda slot: slot["m_with"]).alias("m_with"),
    )


def advanced(state: DataFrame, token: int, penalty: float) -> DataFrame:
    """The state after the stage of that token with the penalty chosen for it."""
    has_rows = F.get("n", F.lit(token)) > 0
    b = F.when(has_rows, F.get("left", F.lit(token)) / (F.get("n", F.lit(token)) + F.lit(float(penalty))))
    state = state.select(*STATE, b.alias("b"))

    def moved(sums: str, shared: str) -> Column:
        less = F.zip_with(sums, F.get(shared, F.lit(token)), lambda total, rows: total - rows * F.col("b"))
        return F.when(F.col("b").isNotNull(), less).otherwise(F.col(sums)).alias(sums)

    def others(shared: str) -> Column:
        return F.transform(shared, lambda rows, i: F.when(i != token, rows)).alias(shared)

    change = F.col("b") * (F.get("m", F.lit(token)) * F.col("b") - 2 * F.get("e", F.lit(token)))
    return state.select(
        "rows",
        "lost",
        (F.col("fixed") + F.coalesce(change, F.lit(0.0))).alias("fixed"),
        (F.col("some") | has_rows).alias("some"),
        "n",
        "m",
        moved("left", "n_with"),
        moved("e", "m_with"),
        others("n_with"),
        others("m_with"),
    )


def _with_key(state: DataFrame, token: int) -> DataFrame:
    """The state and the key sums of one more stage, see ``candidate_errors``.

    A held-out row whose user has no train row with the tag keeps its error.  One with unknown
    tags makes the error unknown if its user has any tag effect so far.
    """
    n, m, left, e = [F.get(c, F.lit(token)) for c in ("n", "m", "left", "e")]
    has_rows = n > 0
    lost = (F.col("lost") > 0) & (has_rows | F.col("some"))
    return state.select(
        *STATE,
        F.when(has_rows & ~lost, left).alias("key_left"),
        n.alias("key_n"),
        F.when(has_rows, e).otherwise(0.0).alias("key_e"),
        F.when(lost, F.col("lost")).when(has_rows, m).otherwise(0).alias("key_m"),
    )


def _keys(keyed: DataFrame) -> DataFrame:
    named = [F.col(c).alias(c.removeprefix("key_")) for c in SWEPT]
    return keyed.select("rows", "fixed", *named, F.lit(0.0).alias("e2"))


def sweep_tag(
    slots: DataFrame, spec: Spec, stage: int, penalties: Sequence[float] = PENALTIES
) -> DataFrame:
    """Errors of tag stage number ``stage`` of the spec, after the stages before it."""
    tokens, state = spec.tokens, tag_state(slots, spec)
    for before in spec.stages[:stage]:
        state = advanced(state, tokens.index(before.token), before.penalty)
    return candidate_errors(_keys(_with_key(state, tokens.index(spec.stages[stage].token))), penalties)


@dataclass(frozen=True)
class Choice:
    """The penalty chosen for one effect; at the edge of its grid a wider grid may do better."""

    effect: str
    penalty: float
    rmse: float | None
    at_edge: bool


def tuned(
    train: DataFrame,
    test: DataFrame,
    features: DataFrame,
    mu: float,
    spec: Spec,
    penalties: Sequence[float] | Mapping[str, Sequence[float]] = PENALTIES,
) -> tuple[Spec, list[Choice]]:
    """Chooses the penalty of each effect in turn, later ones given the earlier choices.

    ``penalties`` is one grid for all effects or a grid per effect, by ``item``, ``user`` or the name of
    the tag stage; effects without one get the default grid.  No penalty lies below 0, so 0 is no edge.
    Rows are read for the item sweep and once more for the cells.  The tag sweeps carry a state per user, which each
    chosen penalty moves once; it is written after every few stages, so that no stage is worked out more than those few times.
    """
    choices: list[Choice] = []

    def candidates(effect: str) -> Sequence[float]:
        return penalties.get(effect, PENALTIES) if isinstance(penalties, Mapping) else penalties

    def noted(effect: str, penalty: float, rmse: float | None) -> float:
        tried = candidates(effect)
        choices.append(Choice(effect, penalty, rmse, penalty in (min(tried), max(tried)) and penalty != 0))
        return penalty

    def best(effect: str, errors: DataFrame) -> float:
        found = best_penalty(errors).first()
        return noted(effect, found["penalty"], found["rmse"])

    chosen = replace(spec, item_penalty=best("item", sweep_item(train, test, mu, candidates("item"))))
    items = item_effect(train, features, mu, chosen.item_penalty)
    cell_rows = stored(tuning_cells(train, test, mu, items), "tuning-cells")
    chosen = replace(chosen, user_penalty=best("user", sweep_user(cell_rows, candidates("user"))))
    state = tag_state(tuning_slots(cell_rows, spec.tokens), chosen)
    stages = []
    for place, stage in enumerate(chosen.stages):
        if place % WRITTEN_EVERY == 0:
            state = stored(state, "tuning-state")
        token = spec.tokens.index(stage.token)
        sums = _sums_by_rows(_keys(_with_key(state, token)))
        penalty = noted(stage.name, *_best_of_sums(sums, candidates(stage.name)))
        stages.append(replace(stage, penalty=penalty))
        state = advanced(state, token, penalty)
    return replace(chosen, stages=tuple(stages)), choices


def tune(
    train: DataFrame,
    test: DataFrame,
    features: DataFrame,
    mu: float,
    spec: Spec,
    penalties: Sequence[float] | Mapping[str, Sequence[float]] = PENALTIES,
) -> Spec:
    """The spec with the penalties that ``tuned`` chooses."""
    return tuned(train, test, features, mu, spec, penalties)[0]
