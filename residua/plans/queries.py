"""One query per operator over the generated tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residua.functions import scalar as X
from residua.functions.metrics import PROPAGATE, SKIP
from residua.operators import effects as E
from residua.operators import split as S
from residua.operators.histogram import histogram
from residua.operators.joins import natural_anti_join, natural_left_join, with_known_keys
from residua.operators.knn import choose_k, k_errors, knn_smooth
from residua.plans import explore, job, tuning
from residua.plans import model as M
from residua.plans.workspace import Workspace
from residua.session import new_path
from residua.sources import delimited, tables, testview
from residua.specs import Spec, VIEW_PLAIN, VIEW_SHRUNK

Query = Callable[[SparkSession, str], DataFrame]

SHOWN_DECIMALS = 7
BOX_DECIMALS = 9  # profile values are sums, equal up to their last bits
NOISE_DECIMALS = 12
SMALL_K = 5
SWEPT_STAGE = 2
RATING_FIELDS = ["user_id", "item_id", "rating", "ts"]
ITEM_FIELDS = ["item_id", "title", "tags"]

_QUERIES: dict[str, Query] = {}


def shown(df: DataFrame) -> DataFrame:
    """Doubles to seven decimals: sums of doubles differ in the last bits from run to run.

    Rounding to twelve first takes those bits away, so that a value half-way between two results
    always goes the same way.
    """
    columns = [
        (F.round(F.round(f.name, NOISE_DECIMALS), SHOWN_DECIMALS) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*columns)


def query(name: str):
    def register(body: Callable[[Workspace], DataFrame]):
        _QUERIES[name] = lambda spark, folder: shown(body(Workspace.of(spark, folder)))
        return body

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- sources and sinks


@query("ratings_view")
def _(w: Workspace) -> DataFrame:
    return delimited.join_items(testview.ratings(w.spark, w.folder), w.items)


def _ratings_file(w: Workspace) -> str:
    path = new_path(w.spark, "ratings-text")
    delimited.write_delimited(testview.ratings(w.spark, w.folder).select(*RATING_FIELDS), path)
    return path


def _items_file(w: Workspace) -> str:
    path = new_path(w.spark, "items-text")
    delimited.write_delimited(w.items.select(*ITEM_FIELDS), path)
    return path


def _delimited_ratings(w: Workspace) -> DataFrame:
    return delimited.read_ratings(w.spark, _ratings_file(w))


def _delimited_items(w: Workspace) -> DataFrame:
    return delimited.read_items(w.spark, _items_file(w))


@query("ingest_ratings_delimited")
def _(w: Workspace) -> DataFrame:
    return _delimited_ratings(w)


@query("ingest_items_delimited")
def _(w: Workspace) -> DataFrame:
    return _delimited_items(w)


@query("ingest_joined")
def _(w: Workspace) -> DataFrame:
    return delimited.join_items(_delimited_ratings(w), _delimited_items(w))


@query("roundtrip_parquet")
def _(w: Workspace) -> DataFrame:
    path = new_path(w.spark, "folds")
    tables.save_table(w.splits.outer, path, ["fold"])
    return tables.load_table(w.spark, path, w.splits.outer.schema)


@query("peek_rows")
def _(w: Workspace) -> DataFrame:
    return delimited.join_items(tables.peek(w.splits.development, ["rating_key"]), w.items)


@query("fold_counts")
def _(w: Workspace) -> DataFrame:
    def counted(name: str, df: DataFrame) -> DataFrame:
        return tables.row_counts(df, "fold").select(F.lit(name).alias("split"), "fold", "n")

    s = w.splits
    return (
        counted("outer", s.outer)
        .unionByName(counted("inner", s.inner))
        .unionByName(counted("tuning", s.tuning))
    )


# --- splits


@query("strata_edges")
def _(w: Workspace) -> DataFrame:
    edges, rows = S.strata_edges(w.rows)
    places = [(place, edge, rows) for place, edge in enumerate(edges)]
    return w.spark.createDataFrame(places, "place int, edge double, rows bigint")


@query("strata_assignment")
def _(w: Workspace) -> DataFrame:
    stratum = S.stratum_of("rating", S.strata_edges(w.rows)[0])
    marked = S.stratified_holdout(w.rows, "outer")
    return marked.select("rating_key", stratum.alias("stratum"), "held_out")


@query("split_outer")
def _(w: Workspace) -> DataFrame:
    return w.splits.outer.select("rating_key", "fold")


@query("split_inner")
def _(w: Workspace) -> DataFrame:
    return w.splits.inner.select("rating_key", "fold")


@query("split_tuning")
def _(w: Workspace) -> DataFrame:
    return w.splits.tuning.select("rating_key", "fold")


@query("split_bernoulli")
def _(w: Workspace) -> DataFrame:
    return S.bernoulli_holdout(w.rows, "chance").select("rating_key", "held_out")


def _inner_holdout(w: Workspace) -> tuple[DataFrame, DataFrame]:
    """Train rows and unrepaired held-out rows of the inner split."""
    held_out = w.splits.inner.filter(F.col("fold") != S.TRAIN).drop("fold")
    return w.splits.train, held_out


@query("semi_known_items_users")
def _(w: Workspace) -> DataFrame:
    train, held_out = _inner_holdout(w)
    return with_known_keys(held_out, train, "item_id", "user_id")


@query("anti_rejected_rows")
def _(w: Workspace) -> DataFrame:
    _, held_out = _inner_holdout(w)
    return natural_anti_join(held_out, w.splits.test)


@query("natural_anti_join")
def _(w: Workspace) -> DataFrame:
    """Development rows that are no train rows: what the inner split held out."""
    return natural_anti_join(w.splits.development, w.splits.train)


# --- effects


@query("global_mean")
def _(w: Workspace) -> DataFrame:
    return E.global_mean(E.item_totals(w.splits.train))


def _item_effect(w: Workspace, spec: Spec) -> DataFrame:
    totals = E.item_totals(w.splits.train)
    b_i = E.shrunken(F.col("total") - F.col("n") * F.lit(w.model.mu), F.col("n"), spec.item_penalty)
    return totals.select("item_id", b_i.alias("b_i"), "n")


def _user_effect(w: Workspace, spec: Spec) -> DataFrame:
    return w.model.users.select("user_id", F.col(f"b_u_{spec.name}").alias("b_u"), "n")


for _spec in (VIEW_PLAIN, VIEW_SHRUNK):
    query(f"item_effect_{_spec.name}")(lambda w, s=_spec: _item_effect(w, s))
    query(f"user_effect_{_spec.name}")(lambda w, s=_spec: _user_effect(w, s))
    query(f"tag_effects_{_spec.name}")(
        lambda w, s=_spec: E.tag_effects(w.model.users, s, w.model.tokens)
    )


@query("staged_fit")
def _(w: Workspace) -> DataFrame:
    """The whole fit of the shrunk spec from the train rows, nothing reused."""
    model = M.fit(w.splits.train, w.items, [VIEW_SHRUNK])
    return E.tag_effects(model.users, VIEW_SHRUNK, model.tokens)


@query("global_mean_unknown")
def _(w: Workspace) -> DataFrame:
    return E.global_mean(E.item_totals(w.partly_rated))


@query("item_effect_unknown")
def _(w: Workspace) -> DataFrame:
    rated = w.partly_rated_model.items.filter("n > 0")
    return rated.select("item_id", F.col("b_i_shrunk").alias("b_i"), "n")


@query("user_effect_unknown")
def _(w: Workspace) -> DataFrame:
    return w.partly_rated_model.users.select("user_id", F.col("b_u_shrunk").alias("b_u"))


@query("tag_effects_unknown")
def _(w: Workspace) -> DataFrame:
    model = w.partly_rated_model
    return E.tag_effects(model.users, VIEW_SHRUNK, model.tokens)


@query("leaderboard_unknown")
def _(w: Workspace) -> DataFrame:
    """Scored on rows of which some have no rating; the errors count the others."""
    return M.leaderboard(w.partly_rated, w.partly_rated_model, [M.TAGS_SHRUNK])


@query("unreadable_ratings")
def _(w: Workspace) -> DataFrame:
    """Lines without a rating in a file of the whole view."""
    path = new_path(w.spark, "ratings-text")
    delimited.write_delimited(w.partly_rated.select(*RATING_FIELDS), path)
    return delimited.unreadable_ratings(w.spark, path).select("value")


@query("parsed_lines")
def _(w: Workspace) -> DataFrame:
    """A file of the whole view in which most lines are spoilt, each in one of six ways; all its lines, read or rejected."""
    path = new_path(w.spark, "spoilt-text")
    u, i, r, t = (F.col(c).cast("string") for c in RATING_FIELDS)
    spoilt = [(u, i, F.lit(""), t), (u, i, F.lit("4"), t, F.lit("extra")), (u, i, F.lit("NaN"), t), (F.lit("x"), i, F.lit("4"), t),
              (u, i, F.lit("4"), F.lit("soon"))]
    way = F.pmod(F.col("user_id") + F.col("item_id"), F.lit(7))
    line = F.when(way == len(spoilt), "")
    for number, fields in enumerate(spoilt):
        line = line.when(way == number, F.concat_ws(delimited.SEPARATOR, *fields))
    line = line.otherwise(F.concat_ws(delimited.SEPARATOR, u, i, r, t))
    testview.ratings(w.spark, w.folder).select(line.alias("value")).write.text(path)
    lines = delimited.parse_ratings(w.spark, path)
    return lines.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))


# Held-out rows against train rows without a seventh of the items and a fifth of the users, so that the joins,
# the return to train and the fill have rows to act on.


@query("semi_thin")
def _(w: Workspace) -> DataFrame:
    return with_known_keys(w.splits.test, w.thin_train, "item_id", "user_id")


@query("anti_thin")
def _(w: Workspace) -> DataFrame:
    known = with_known_keys(w.splits.test, w.thin_train, "item_id", "user_id")
    return natural_anti_join(w.splits.test, known)


@query("judged_thin")
def _(w: Workspace) -> DataFrame:
    rejected = S.judged(w.thin_train, w.splits.test, False).select("rating_key", "fold")
    returned = S.judged(w.thin_train, w.splits.test, True).select("rating_key", F.col("fold").alias("returned"))
    return rejected.join(returned, "rating_key")


@query("score_thin")
def _(w: Workspace) -> DataFrame:
    """Unknown items and users make a prediction unknown, unless they are filled."""
    scored = M.score(w.splits.test, w.thin_model, M.TAGS_SHRUNK).select("rating_key", "pred")
    filled = M.score(w.splits.test, w.thin_model, M.TAGS_SHRUNK.filled("item", "user"))
    return filled.select("rating_key", F.col("pred").alias("filled")).join(scored, "rating_key")


@query("leaderboard_thin")
def _(w: Workspace) -> DataFrame:
    variants = [M.TAGS_SHRUNK, M.TAGS_SHRUNK.filled("item", "user")]
    return M.leaderboard(w.splits.test, w.thin_model, variants)


@query("tag_effect_map")
def _(w: Workspace) -> DataFrame:
    maps = E.tag_effect_maps(w.model.users, VIEW_SHRUNK)
    return maps.select(
        "user_id",
        F.size("effects").cast("bigint").alias("tags"),
        F.array_join(F.array_sort(F.map_keys("effects")), ",").alias("names"),
        F.aggregate(F.map_values("effects"), F.lit(0.0), lambda a, b: a + b).alias("total"),
    )


@query("fitted_table")
def _(w: Workspace) -> DataFrame:
    return w.fitted().select("rating_key", "pred", "residual")


# --- scores


def _scored(w: Workspace, rows: DataFrame, variant: M.Variant) -> DataFrame:
    years = w.year_effect if variant.year else None
    return M.score(rows, w.model, variant, years).select("rating_key", "rating", "pred")


for _name, _variant in {
    "score_average": M.AVERAGE,
    "score_item": M.ITEM,
    "score_item_user": M.ITEM_USER,
    "score_tags_plain": M.TAGS_PLAIN,
    "score_tags_shrunk": M.TAGS_SHRUNK,
    "score_full_test": M.FULL,
}.items():
    query(_name)(lambda w, v=_variant: _scored(w, w.splits.test, v))

query("score_full_validation")(lambda w: _scored(w, w.splits.validation, M.FINAL))
query("rmse_propagate")(
    lambda w: M.score_error(_scored(w, w.splits.test, M.FULL), PROPAGATE)
)
query("rmse_skip")(lambda w: M.score_error(_scored(w, w.splits.test, M.FULL), SKIP))


@query("leaderboard")
def _(w: Workspace) -> DataFrame:
    return M.leaderboard(w.splits.test, w.model, year_effect=w.year_effect)


@query("final_holdout")
def _(w: Workspace) -> DataFrame:
    """The last model on the validation rows, as published and with an unknown year as zero."""
    variants = [M.FINAL, M.FINAL.filled("item", "user", "year")]
    return M.leaderboard(w.splits.validation, w.model, variants, w.year_effect)


@query("job_from_files")
def _(w: Workspace) -> DataFrame:
    """From two delimited files to the errors of all models, nothing reused."""
    outcome = job.run(w.spark, _ratings_file(w), _items_file(w), (VIEW_PLAIN, VIEW_SHRUNK))
    test = outcome.leaderboard().select(F.lit("test").alias("rows"), "*")
    return test.unionByName(outcome.final().select(F.lit("validation").alias("rows"), "*"))


# --- penalties


@query("sweep_item")
def _(w: Workspace) -> DataFrame:
    return tuning.sweep_item(w.splits.tune_train, w.splits.tune_test, w.mu)


@query("best_lambda")
def _(w: Workspace) -> DataFrame:
    return tuning.best_penalty(
        tuning.sweep_item(w.splits.tune_train, w.splits.tune_test, w.mu)
    )


@query("sweep_user")
def _(w: Workspace) -> DataFrame:
    return tuning.sweep_user(w.tuning_cells)


@query("sweep_tag")
def _(w: Workspace) -> DataFrame:
    slots = tuning.tuning_slots(w.tuning_cells, VIEW_SHRUNK.tokens)
    return tuning.sweep_tag(slots, VIEW_SHRUNK, SWEPT_STAGE)


@query("tuned_penalties")
def _(w: Workspace) -> DataFrame:
    spec = tuning.tune(
        w.splits.tune_train, w.splits.tune_test, w.features, w.mu, VIEW_SHRUNK
    )
    chosen = [("item", spec.item_penalty), ("user", spec.user_penalty)]
    chosen += [(stage.name, stage.penalty) for stage in spec.stages]
    rows = [(place, effect, penalty) for place, (effect, penalty) in enumerate(chosen)]
    return w.spark.createDataFrame(rows, "place int, effect string, penalty double")


# --- release year


@query("release_year")
def _(w: Workspace) -> DataFrame:
    return w.items.select(
        "item_id", X.release_year("title").alias("year"), X.first_token("tags").alias("first_token")
    )


@query("rating_dates")
def _(w: Workspace) -> DataFrame:
    date = X.utc_date("ts")
    first = w.rows.agg(X.utc_date(F.min("ts")).alias("first")).scalar()
    dated = w.rows.join(w.features, "item_id", "left").select(
        "rating_key", date.alias("date"), first.alias("first"), "year"
    )
    return dated.select(
        "rating_key",
        F.col("date").cast("string").alias("date"),
        X.whole_weeks(F.col("first"), F.col("date")).alias("weeks"),
        X.whole_months(F.col("first"), F.col("date")).alias("months"),
        X.age_in_years(F.col("date"), F.col("year")).alias("age"),
    )


query("year_residual")(lambda w: M.year_residuals(w.model, "shrunk"))
query("knn_smooth")(lambda w: knn_smooth(w.years, SMALL_K))
query("knn_smooth_year_only")(lambda w: knn_smooth(w.years, SMALL_K, features=["year"]))
query("k_errors")(lambda w: k_errors(w.years))
query("choose_k")(lambda w: choose_k(w.years))
query("year_effect")(lambda w: knn_smooth(w.years, choose_k(w.years).first()["k"]))


@query("natural_left_join")
def _(w: Workspace) -> DataFrame:
    rows = w.splits.test.join(w.features, "item_id", "left").select("rating_key", "year")
    return natural_left_join(rows, w.year_effect.select("year", "n", "knn"))


# --- exploration

for _centred, _suffix in ((False, ""), (True, "_centred")):
    query(f"hist_item_effect{_suffix}")(
        lambda w, c=_centred: histogram(w.model.items, "b_i_plain", centred=c)
    )
    query(f"hist_user_effect{_suffix}")(
        lambda w, c=_centred: histogram(w.model.users, "b_u_plain", centred=c)
    )

query("tag_frequency_first_token")(lambda w: explore.tag_frequency_first_token(w.splits.development, w.items))
query("tag_frequency_all")(lambda w: explore.tag_frequency(w.splits.development, w.items))
query("sampled_users")(lambda w: w.sampled_users())
query("panel_users")(lambda w: w.user_panels())


def _profile(w: Workspace) -> DataFrame:
    return explore.profiles(
        w.splits.train, w.model, "plain", w.sampled_users(), VIEW_PLAIN.stages
    )


query("user_tag_profile")(_profile)
query("tag_box_stats")(lambda w: explore.tag_boxes(w.profile, decimals=BOX_DECIMALS))
query("tag_box_outliers")(lambda w: explore.tag_box_outliers(w.profile, BOX_DECIMALS))


@query("panel_profiles")
def _(w: Workspace) -> DataFrame:
    profile = explore.profiles(
        w.splits.train, w.model, "plain", w.user_panels(), VIEW_PLAIN.stages, ["panel", "user_id"]
    )
    return explore.placed_by_median(profile, ["panel"], BOX_DECIMALS)


query("residual_by_month")(lambda w: explore.residual_by_month(w.residual_sums))
query("residual_by_age")(lambda w: explore.residual_by_age(w.residual_sums))
query("residual_by_release_year")(lambda w: explore.residual_by_release_year(w.residual_sums))
query("curve_long")(lambda w: explore.curve_long(w.year_effect))
