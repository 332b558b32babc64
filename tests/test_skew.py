"""One user and one item hold a third of all rows each, and nothing may be broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from residua import session
from residua.operators import effects as E
from residua.operators import split as S
from residua.plans import model as M
from residua.plans import tuning
from residua.plans.workspace import Workspace
from residua.sources import testview
from residua.specs import Spec, Stage

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}
SPEC = Spec("shrunk", 1.75, 5.0, (Stage("a", "a", 3.0), Stage("b", "b", 2.0)))


@pytest.fixture(scope="module")
def no_broadcast(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def skewed(no_broadcast):
    spark = no_broadcast
    key = F.col("id")
    rows = spark.range(0, 90000, 1, 8).select(
        F.md5(key.cast("string")).alias("rating_key"),
        F.when(key % 3 == 0, 7).otherwise(key % 500).alias("user_id"),
        F.when(key % 3 == 1, 11).otherwise(key % 701).alias("item_id"),
        (F.pmod(F.xxhash64("id"), F.lit(10)) / 2.0 + 0.5).alias("rating"),
        key.alias("ts"),
    )
    tags = F.element_at(F.array(*[F.lit(t) for t in ("a", "b", "a|b", "c")]), (key % 4 + 1).cast("int"))
    items = spark.range(701).select(
        key.alias("item_id"), F.concat(F.lit("t ("), 1950 + key % 40, F.lit(")")).alias("title"), tags.alias("tags")
    )
    return rows, items


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_split_in_lookups(skewed):
    rows, items = skewed
    model = M.fit(rows, items, [SPEC])
    joined = M.with_effects(rows, model, ["shrunk"]).agg(F.sum("b_u_shrunk"), F.sum("b_i_shrunk"), F.sum("rating"), F.count("*"))
    plan = final_plan(joined)
    assert "Broadcast" not in plan.split("== Initial Plan ==")[0]
    assert plan.split("== Initial Plan ==")[0].count("skew=true") == 2
    assert joined.first()["count(1)"] == 90000


def test_a_hot_user_is_aggregated_before_the_shuffle(skewed):
    rows, items = skewed
    model = M.fit(rows, items, [SPEC])
    assert model.cells.filter("user_id = 7").count() <= 4 * 40
    assert model.cells.agg(F.sum("n")).first()[0] == 90000
    total = model.users.agg(F.sum("n")).first()[0]
    assert total == 90000
    plan = final_plan(E.cells(rows, model.items, F.lit(model.mu), [SPEC]))
    exchange = plan.rindex("Exchange hashpartitioning(user_id", 0, plan.index("== Initial Plan ==") if "== Initial Plan ==" in plan else None)
    assert "partial_sum" in plan[exchange:]


def test_split_of_skewed_rows_is_whole(skewed):
    rows, _ = skewed
    fold = S.split(rows, "outer").groupBy("fold").agg(F.count("*").alias("n"))
    counts = {r["fold"]: r["n"] for r in fold.collect()}
    assert sum(counts.values()) == 90000
    assert 9000 <= counts["test"] + counts.get("rejected", 0) <= 9004


def test_parts_do_not_grow_with_the_table(skewed, monkeypatch):
    """Cells meet their items, and users are summed up, in parts of a bounded size; a hot item is left to Spark."""
    rows, items = skewed
    model = M.fit(rows, items, [SPEC])
    monkeypatch.setattr(session, "ROWS_PER_PART", 100)
    assert M.fit(rows, items, [SPEC]).users.count() == model.users.count()
    slots = E.slot_sums(model.cells, SPEC.tokens, ["left_shrunk"], ["n"])
    parts = session.parts_for(model.cells.count())
    assert parts > 4 and re.search(rf"hashpartitioning\(user_id#\d+L?, {parts}\), REPARTITION_BY_NUM", final_plan(slots))

    def joined(effects):
        return final_plan(E.cells(rows, effects, F.lit(model.mu), [SPEC]))

    assert "skew=true" in joined(model.items)
    monkeypatch.setattr(session, "ROWS_PER_PART", 31_000)
    assert ", 3), REPARTITION_BY_NUM" not in joined(model.items)  # fewer than the session has
    monkeypatch.setattr(session, "ROWS_PER_PART", 100)
    even = model.items.withColumn("n", F.lit(90).cast("bigint"))
    assert f", {session.parts_for(701 * 90)}), REPARTITION_BY_NUM" in joined(even)


def test_cells_are_summed_in_bounded_parts(skewed, monkeypatch):
    """Also the cells of a hot user: they go to many parts; the sums stay the same, no other shuffle follows."""
    rows, items = skewed
    model = M.fit(rows, items, [SPEC])
    features = E.item_features(items, SPEC.tokens)
    train, test = rows.filter("ts % 10 > 0"), rows.filter("ts % 10 = 0")
    effects = tuning.item_effect(train, features, model.mu, SPEC.item_penalty)

    def fitted():
        return E.cells(rows, model.items, F.lit(model.mu), [SPEC])

    def tuned():
        return tuning.tuning_cells(train, test, model.mu, effects)

    def sums(df):
        places = [F.round(c, 9).alias(c) if kind == "double" else c for c, kind in df.dtypes]
        return {(r["user_id"], *(r["hits"] or [None]), r.asDict().get("year")): r for r in df.select(*places).collect()}

    before = [sums(cells()) for cells in (fitted, tuned)]
    monkeypatch.setattr(session, "ROWS_PER_PART", 10_000)
    for cells, same, key, parts in zip((fitted, tuned), before, ("user_id#\\d+L?, hits#\\d+, year#\\d+", "user_id#\\d+L?, hits#\\d+"), (9, 9), strict=True):
        assert sums(cells()) == same
        plan = final_plan(cells())
        assert re.search(rf"hashpartitioning\({key}, {parts}\), REPARTITION_BY_NUM", plan)
        assert not re.search(r"hashpartitioning\(user_id.*ENSURE_REQUIREMENTS", plan)
    hot = fitted().filter("user_id = 7").select(F.spark_partition_id()).distinct()
    assert hot.count() == 9


def test_effects_come_to_rows_in_bounded_parts(skewed, monkeypatch):
    """Rows meet items and users in parts of a bounded size; hot or missing keys are left to Spark; the sums stay the same."""
    rows, items = skewed
    even = rows.withColumn("user_id", F.col("ts") % 499).withColumn("item_id", F.col("ts") % 701)
    unknown = even.withColumn("user_id", F.when(F.col("ts") % 3 > 0, F.col("user_id")))
    model = M.fit(even, items, [SPEC])

    def joined(df):
        return M.with_effects(df, model, ["shrunk"]).agg(
            F.count("*"), F.count("b_u_shrunk"), F.round(F.sum("b_i_shrunk"), 9), F.round(F.sum("b_u_shrunk"), 9)
        )

    tables = (even, unknown, rows)
    before = [joined(df).first() for df in tables]
    monkeypatch.setattr(session, "ROWS_PER_PART", 10_000)
    for df, parts, same in zip(tables, (2, 1, 0), before, strict=True):
        again = joined(df)
        assert again.first() == same
        assert final_plan(again).split("== Initial Plan ==")[0].count(", 9), REPARTITION_BY_NUM") == parts


def test_a_leaderboard_of_thin_train_rows_in_bounded_parts(skewed, monkeypatch):
    """Unknown users and items stay unknown, or are filled, however the scored rows are dealt."""
    rows, items = skewed
    even = rows.withColumn("user_id", F.col("ts") % 499).withColumn("item_id", F.col("ts") % 701)
    thin = M.fit(even.filter("user_id % 5 <> 0 AND item_id % 7 <> 0"), items, [SPEC])

    def board():
        return M.leaderboard(even, thin, [M.TAGS_SHRUNK, M.TAGS_SHRUNK.filled("item", "user")])

    def values(df):
        return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()]

    before = values(board())
    seen = even.filter("user_id % 5 <> 0 AND item_id % 7 <> 0").count()
    assert [r[-2:] for r in before] == [(seen, 90000 - seen), (90000, 0)] and before[0][2] is None
    monkeypatch.setattr(session, "ROWS_PER_PART", 10_000)
    again = board()
    assert values(again) == before
    assert final_plan(again).split("== Initial Plan ==")[0].count(", 9), REPARTITION_BY_NUM") == 2


def test_year_curve_in_bounded_parts(skewed, monkeypatch):
    rows, items = skewed
    model = M.fit(rows, items, [SPEC])

    def curve():
        return {r["year"]: (round(r["b"], 9), r["n"]) for r in M.year_residuals(model, "shrunk").collect()}

    before = curve()
    monkeypatch.setattr(session, "ROWS_PER_PART", 200)
    assert curve() == before
    parts = session.parts_for(model.cells.count())
    assert f", {parts}), REPARTITION_BY_NUM" in final_plan(M.year_residuals(model, "shrunk"))


def test_rating_rows_are_joined_in_bounded_parts(no_broadcast, folder, monkeypatch):
    before = testview.ratings(no_broadcast, folder)
    monkeypatch.setattr(session, "ROWS_PER_PART", 500)
    after = testview.ratings(no_broadcast, folder)
    assert "REPARTITION_BY_NUM" in final_plan(after)
    assert after.exceptAll(before).isEmpty() and before.exceptAll(after).isEmpty()


def test_sweeps_take_the_mean_without_a_fit(no_broadcast, folder):
    w = Workspace(no_broadcast, folder)
    assert w.tuning_cells.count() > 0 and "model" not in w.__dict__
    assert w.mu == pytest.approx(w.model.mu, abs=1e-12)
