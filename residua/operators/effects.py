"""Shrunken residual means: item, user and staged per-user tag effects.

A stage takes the rows it applies to, groups the residual that the stages before left, and sets
``b = sum(residual) / (n + penalty)``.

Tag stages are keyed by user, and a row is touched by a stage only through its tags.  So all rows
of a user with the same tags ("a cell") keep moving by the same amount, and ``(n, sum)`` per cell
is all that the stages need.  A hot user with a third of all ratings has as many cells as there are
combinations of tags and year, and they are spread over all tasks.  Rows of ordinary users seldom share
a cell; so a large table is not summed up before its one shuffle, only after it, in parts of a bounded
size.  From the cells each user keeps sums of a fixed number, and all stages are solved from those in
one expression: no join, window or shuffle per stage.

The tags of an item are ``hits``, the ascending places of the tokens found in its text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residua.functions.scalar import present, release_year, sql_text, token_hits
from residua.session import dealt, parts_for
from residua.specs import Spec, Stage


def rated(rows: DataFrame) -> DataFrame:
    """The rows that count in any mean, fit, sweep, curve or score: those with a known rating."""
    return rows.filter(present("rating"))


def item_totals(rows: DataFrame) -> DataFrame:
    """``(item_id, total, n)``: enough for the global mean and every item effect."""
    return rated(rows).groupBy("item_id").agg(F.sum("rating").alias("total"), F.count("*").alias("n"))


def global_mean(totals: DataFrame) -> DataFrame:
    """One row, ``mu``, from the totals of any key."""
    return totals.agg((F.sum("total") / F.sum("n")).alias("mu"))


def shrunken(total: Column, n: Column, penalty: float) -> Column:
    """NULL without rows."""
    return F.when(n > 0, total / (n + F.lit(float(penalty))))


def item_features(items: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """``(item_id, hits, year)``: all that the model takes from the text of an item.

    Worked out once per item, not once per rating.
    """
    return items.select(
        "item_id", token_hits("tags", tokens).alias("hits"), release_year("title").alias("year")
    )


def item_table(totals: DataFrame, features: DataFrame) -> DataFrame:
    """``(item_id, hits, year, total, n)`` for all rated and all listed items."""
    return totals.join(features, "item_id", "full")


def item_effects(table: DataFrame, mu: Column, specs: Sequence[Spec]) -> DataFrame:
    """``(item_id, hits, year, n, b_i_<spec>...)`` from an item table."""
    return table.select(
        "item_id",
        "hits",
        "year",
        "n",
        *[
            shrunken(F.col("total") - F.col("n") * mu, F.col("n"), s.item_penalty).alias(f"b_i_{s.name}")
            for s in specs
        ],
    )


def met_by_item(rows: DataFrame, effects: DataFrame, counts: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with the ``effects`` of their items, joined in as many parts as the rated rows need, and that number of parts.

    ``counts`` has the row count ``n`` per item.  With an item that would overfill a part the join is left to adaptive
    execution, which can split it.
    """
    size = counts.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    parts = parts_for(size["rows"] or 0)
    if parts_for(size["most"] or 0) == 1:
        effects = dealt(effects, parts, "item_id")
    return rows.join(effects, "item_id", "left"), parts


def cells(rows: DataFrame, items: DataFrame, mu: Column, specs: Sequence[Spec]) -> DataFrame:
    """``(user_id, hits, year, n, left_<spec>...)``: what the item effect leaves, summed per cell.

    The release year is part of the key so that the year curve needs no second pass over rows.  A table of more parts than
    the session has is dealt by cell first, so that no task holds more sums with more rows; a smaller one is summed up
    on both sides of the shuffle.
    """
    effects = items.select("item_id", "hits", "year", *[f"b_i_{s.name}" for s in specs])
    met, parts = met_by_item(rated(rows).select("user_id", "item_id", "rating"), effects, items)
    errors = met.select(
        "user_id", "hits", "year", *[(F.col("rating") - F.col(f"b_i_{s.name}")).alias(f"error_{s.name}") for s in specs]
    )
    return (
        dealt(errors, parts, "user_id", "hits", "year")
        .groupBy("user_id", "hits", "year")
        .agg(
            F.count("*").alias("n"),
            *[(F.sum(f"error_{s.name}") - F.count("*") * mu).alias(f"left_{s.name}") for s in specs],
        )
    )


# --- the staged fit of one user

ALL_ROWS = -1  # the slot that every row of the user is in; the others are one per token


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def slot_sums(cell_rows: DataFrame, tokens: Sequence[str], sums: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """``(user_id, slots)``: a map from slot to what the stages need to know of its rows.

    Per slot: the ``sums``, the ``counts``, and for each count an array ``<count>_with`` that
    splits it by the other tokens of the rows.  So the state per user has a fixed size, however
    many rows the user has.  The cells, a stored table, are shuffled by user once, into parts of a size that does not grow
    with the table: the sums of a part are many times as large as its cells.
    """
    hits = F.coalesce("hits", F.array().cast("array<int>"))
    slots = F.concat(F.array(F.lit(ALL_ROWS)), "hits")
    in_slots = (
        cell_rows.repartition(parts_for(cell_rows.count()), "user_id")
        .select("user_id", hits.alias("hits"), *sums, *counts)
        .select("*", F.explode(slots).alias("slot"))
    )
    per_slot = in_slots.groupBy("user_id", "slot").agg(
        *[F.sum(c).alias(c) for c in (*sums, *counts)],
        *[
            F.expr(f"sum(if(array_contains(hits, {i}), {count}, 0L)) AS {count}_{i}")
            for count in counts
            for i in range(len(tokens))
        ],
    )
    entry = F.struct(
        *sums,
        *counts,
        *[
            F.array(*[f"{count}_{i}" for i in range(len(tokens))]).alias(f"{count}_with")
            for count in counts
        ],
    )
    return (
        per_slot.select("user_id", F.struct("slot", entry.alias("entry")).alias("pair"))
        .groupBy("user_id")
        .agg(F.map_from_entries(F.collect_list("pair")).alias("slots"))
    )


def already_taken(shared: Column, before: Column) -> Column:
    """What the stages before took from the rows: per stage its ``b`` times the rows of both tags."""
    return F.aggregate(
        before,
        F.lit(0.0),
        lambda total, e: total + F.get(shared, e["slot"]) * F.coalesce(e["b"], F.lit(0.0)),
    )


def staged(slots: Column, left: str, b_u: Column, stages: Sequence[Stage], tokens: Sequence[str]) -> Column:
    """Runs the stages of one user: an array with one ``(slot, b)`` per stage.

    The residual a stage sees is the sum after the user effect less what the stages before took
    from the same rows.  That is a lower triangular system, solved from the top.  ``b`` is NULL
    where no row of the user has the tag.
    """
    nothing = F.array().cast("array<struct<slot:int,b:double>>")
    if not stages:
        return nothing
    settings = ", ".join(
        f"struct({tokens.index(stage.token)} AS slot, {float(stage.penalty)!r}D AS penalty)"
        for stage in stages
    )

    def solve(before: Column, stage: Column, rows: Column) -> Column:
        total = rows[left] - rows["n"] * b_u - already_taken(rows["n_with"], before)
        return F.struct(
            stage["slot"].alias("slot"),
            F.when(rows["n"] > 0, total / (rows["n"] + stage["penalty"])).alias("b"),
        )

    def step(before: Column, stage: Column) -> Column:
        effect = let(slots[stage["slot"]], lambda rows: solve(before, stage, rows))
        return F.concat(before, F.array(effect))

    return F.aggregate(F.expr(f"array({settings})"), nothing, step)


def user_effects(cell_rows: DataFrame, specs: Sequence[Spec]) -> DataFrame:
    """One row per user: ``(user_id, n, tag_rows, b_u_<spec>..., tags_<spec>...)``.

    ``tags_<spec>`` is an array of effects in the stage order of the spec, ``tag_rows`` an array
    of row counts in token order.
    """
    tokens = specs[0].tokens
    sums = slot_sums(cell_rows, tokens, [f"left_{s.name}" for s in specs], ["n"])
    whole = F.col("slots")[ALL_ROWS]
    return sums.select(
        "user_id",
        "slots",
        whole["n"].alias("n"),
        whole["n_with"].alias("tag_rows"),
        *[shrunken(whole[f"left_{s.name}"], whole["n"], s.user_penalty).alias(f"b_u_{s.name}") for s in specs],
    ).select(
        "user_id",
        "n",
        "tag_rows",
        *[f"b_u_{s.name}" for s in specs],
        *[
            F.transform(
                staged(F.col("slots"), f"left_{s.name}", F.col(f"b_u_{s.name}"), s.stages, tokens),
                lambda e: e["b"],
            ).alias(f"tags_{s.name}")
            for s in specs
        ],
    )


def tag_adjustment(spec: Spec, tokens: Sequence[str]) -> Column:
    """Sum of the tag effects that apply to a row or cell with ``hits`` and ``tags_<spec>``.

    A tag the user has no effect for adds nothing.  With unknown tags the sum is unknown if the
    user has any tag effect, and 0 otherwise.
    """
    tags = f"tags_{spec.name}"
    total = " + ".join(
        f"if(array_contains(hits, {tokens.index(stage.token)}), coalesce({tags}[{place}], 0D), 0D)"
        for place, stage in enumerate(spec.stages)
    )
    return F.expr(
        f"""CASE WHEN hits IS NOT NULL THEN {total or '0D'}
        WHEN coalesce(exists({tags}, b -> b IS NOT NULL), false) THEN NULL ELSE 0D END"""
    )


def tag_effects(users: DataFrame, spec: Spec, tokens: Sequence[str]) -> DataFrame:
    """Long form ``(user_id, tag, b, n)``, only tags the user has rows for."""
    pairs = ", ".join(
        f"struct({sql_text(stage.name)} AS tag, tags_{spec.name}[{place}] AS b, tag_rows[{tokens.index(stage.token)}] AS n)"
        for place, stage in enumerate(spec.stages)
    )
    return users.select("user_id", F.expr(f"inline(array({pairs}))")).filter("n > 0")


def tag_effect_maps(users: DataFrame, spec: Spec) -> DataFrame:
    """``(user_id, effects)`` with a map from tag to effect."""
    names = F.array(*[F.lit(stage.name) for stage in spec.stages])
    effects = F.map_from_arrays(names, F.col(f"tags_{spec.name}"))
    return users.select(
        "user_id", F.map_filter(effects, lambda _, b: b.isNotNull()).alias("effects")
    )
