import math
import random

import pytest
from pyspark.sql import functions as F

from residua.operators import effects as E
from residua.plans import explore, tuning
from residua.plans import model as M
from residua.specs import FILM_PLAIN, FILM_SHRUNK, Spec, Stage, VIEW_SHRUNK, unpenalised

RATING = "rating_key string, user_id bigint, item_id bigint, rating double, ts bigint"
ITEM = "item_id bigint, title string, tags string"


def frames(spark, rows):
    """Ratings and items of wide rows; an item must always have the same text."""
    ratings = spark.createDataFrame([(k, u, i, x, ts) for k, u, i, x, _, _, ts in rows], RATING)
    listed = {i: (i, title, tags) for _, _, i, _, tags, title, _ in rows}
    assert all(listed[i] == (i, title, tags) for _, _, i, _, tags, title, _ in rows)
    return ratings, spark.createDataFrame(list(listed.values()), ITEM)


def fit(spark, rows, specs):
    return M.fit(*frames(spark, rows), specs)


FIXTURE = [
    ("a", 1, 10, 4.0, "Drama|Comedy", "A (1994)", 789652009),
    ("b", 1, 20, 2.0, "Comedy", "B (1994)", 820454400),
    ("c", 1, 30, 5.0, "Drama", "C (2001)", 1000000000),
    ("d", 2, 10, 5.0, "Drama|Comedy", "A (1994)", 1000086400),
    ("e", 2, 20, 3.0, "Comedy", "B (1994)", 1000172800),
    ("f", 3, 30, 3.5, "Drama", "C (2001)", 1000259200),
]

DRAMA = Spec("shrunk", 1.75, 5.0, (Stage("drama", "Drama", 27.0),))


def close(a, b, digits=9):
    return a is not None and abs(a - b) < 10**-digits


def test_hand_computed_effects(spark):
    train, items = frames(spark, FIXTURE)
    model = M.fit(train, items, [DRAMA])
    assert model.mu == 3.75
    items = {r["item_id"]: round(r["b_i_shrunk"], 6) for r in model.items.collect()}
    assert items == {10: 0.4, 20: -0.666667, 30: 0.266667}
    users = {r["user_id"]: round(r["b_u_shrunk"], 6) for r in model.users.collect()}
    assert users == {1: -0.03125, 2: 0.109524, 3: -0.086111}
    tags = {r["user_id"]: (round(r["b"], 6), r["n"]) for r in E.tag_effects(model.users, DRAMA, model.tokens).collect()}
    assert tags == {1: (0.030891, 2), 2: (0.026446, 1), 3: (-0.015377, 1)}
    fitted = {r["rating_key"]: round(r["residual"], 6) for r in M.fitted(train, model, "shrunk").collect()}
    assert fitted == {"a": -0.149641, "b": -1.052083, "c": 0.983693, "d": 0.714031, "e": -0.192857, "f": -0.415179}
    rmse = M.score_error(M.fitted(train, model, "shrunk")).first()["rmse"]
    assert round(rmse, 6) == 0.685119


def reference_fit(rows, spec):
    """The definition, row by row: effects as dicts and the residual per row."""
    mu = sum(r[3] for r in rows) / len(rows)
    left = [r[3] - mu for r in rows]

    def stage(key, applies, penalty):
        sums = {}
        for r, e in zip(rows, left):
            if applies(r):
                s, n = sums.get(key(r), (0.0, 0))
                sums[key(r)] = (s + e, n + 1)
        b = {k: s / (n + penalty) for k, (s, n) in sums.items()}
        for i, r in enumerate(rows):
            if applies(r):
                left[i] -= b[key(r)]
        return b

    items = stage(lambda r: r[2], lambda r: True, spec.item_penalty)
    users = stage(lambda r: r[1], lambda r: True, spec.user_penalty)
    tags = {
        s.name: stage(lambda r: r[1], lambda r, t=s.token: r[4] is not None and t in r[4], s.penalty)
        for s in spec.stages
    }
    return mu, items, users, tags, left


def random_rows(seed, count, hot=None):
    rng = random.Random(seed)
    words = ["Drama", "Comedy", "Action", "Sci-Fi", "War", "Wario"]
    texts = {
        item: (
            "|".join(rng.sample(words, rng.randint(0, 4))),
            f"T{item}" if item % 7 == 0 else f"T{item} ({1980 + item})",
        )
        for item in range(1, 41)
    }
    rows = []
    for i in range(count):
        user = hot if hot is not None and i % 3 == 0 else rng.randint(1, 12)
        item = rng.randint(1, 40)
        rows.append((str(i), user, item, rng.randint(1, 10) / 2, *texts[item], 800000000 + i * 86400))
    return rows


STAGES = tuple(Stage(t.lower(), t, p) for t, p in (("Drama", 3.0), ("Comedy", 1.5), ("Action", 0.0), ("Sci", 7.0), ("War", 2.0)))
SHRUNK = Spec("shrunk", 1.75, 5.0, STAGES)
PLAIN = unpenalised(SHRUNK)


@pytest.mark.parametrize("hot", [None, 5])
def test_one_pass_fit_equals_the_definition(spark, hot):
    """Also with one user who holds a third of all rows."""
    rows = random_rows(1, 600, hot)
    train, listed = frames(spark, rows)
    model = M.fit(train.repartition(5), listed, [PLAIN, SHRUNK])
    for spec in (PLAIN, SHRUNK):
        mu, items, users, tags, left = reference_fit(rows, spec)
        assert close(model.mu, mu)
        got = {r["item_id"]: r[f"b_i_{spec.name}"] for r in model.items.collect()}
        assert all(close(got[k], v) for k, v in items.items()) and len(got) == len(items)
        got = {r["user_id"]: r[f"b_u_{spec.name}"] for r in model.users.collect()}
        assert all(close(got[k], v) for k, v in users.items()) and len(got) == len(users)
        long = {(r["user_id"], r["tag"]): r["b"] for r in E.tag_effects(model.users, spec, model.tokens).collect()}
        expected = {(u, t): b for t, effects in tags.items() for u, b in effects.items()}
        assert long.keys() == expected.keys()
        assert all(close(long[k], v) for k, v in expected.items())
        fitted = {r["rating_key"]: r["residual"] for r in M.fitted(train, model, spec.name).collect()}
        assert all(close(fitted[r[0]], e) for r, e in zip(rows, left))


def test_year_residuals_from_cells_equal_those_from_rows(spark):
    rows, items = frames(spark, random_rows(2, 500))
    model = M.fit(rows, items, [SHRUNK])
    cells = {r["year"]: (r["b"], r["n"]) for r in M.year_residuals(model, "shrunk").collect()}
    direct = {r["year"]: (r["b"], r["n"]) for r in explore.residual_by_release_year(explore.residual_sums(M.fitted(rows, model, "shrunk"))).collect()}
    assert cells.keys() == direct.keys() and None in cells
    assert all(close(cells[y][0], direct[y][0]) and cells[y][1] == direct[y][1] for y in cells)


def test_large_penalty_removes_effects_and_zero_is_the_mean(spark):
    rows, items = frames(spark, random_rows(3, 300))
    flat = Spec("flat", 1e12, 1e12, tuple(Stage(s.name, s.token, 1e12) for s in STAGES))
    model = M.fit(rows, items, [flat])
    assert model.items.agg(F.max(F.abs("b_i_flat"))).first()[0] < 1e-8
    assert E.tag_effects(model.users, flat, model.tokens).agg(F.max(F.abs("b"))).first()[0] < 1e-8
    plain = M.fit(rows, items, [PLAIN])
    means = rows.groupBy("item_id").agg((F.avg("rating") - plain.mu).alias("m")).join(plain.items, "item_id")
    assert means.filter("abs(m - b_i_plain) > 1e-9").count() == 0


def test_more_stages_never_raise_the_train_error_without_penalty(spark):
    rows, items = frames(spark, random_rows(4, 400))
    errors = []
    for k in range(len(PLAIN.stages) + 1):
        spec = Spec("plain", 0.0, 0.0, PLAIN.stages[:k])
        errors.append(M.score_error(M.fitted(rows, M.fit(rows, items, [spec]), "plain")).first()["rmse"])
    assert all(b <= a + 1e-12 for a, b in zip(errors, errors[1:]))


# --- scoring of edge rows


@pytest.fixture(scope="module")
def small(spark):
    """Items 98 and 97 are listed but not rated; 98 has no tag text, 97 no year of the fixture."""
    ratings, items = frames(spark, FIXTURE)
    more = [(98, "A (1994)", None), (97, "A (1900)", "Comedy"), (96, "A", "Comedy"), (95, "E (1994)", "Comedy")]
    return M.fit(ratings, items.unionByName(spark.createDataFrame(more, ITEM)), [DRAMA])


FIT = M.Variant("x", "shrunk", item=True, user=True, tags=True)


def predictions(spark, model, rows, variant, years=None):
    scored = M.score(spark.createDataFrame(rows, "rating_key string, user_id bigint, item_id bigint"), model, variant, years)
    return {r["rating_key"]: r["pred"] for r in scored.collect()}


def test_unknown_tags(spark, small):
    rows = [("has", 1, 98), ("new", 9, 98)]
    assert predictions(spark, small, rows, FIT) == {"has": None, "new": None}
    some = predictions(spark, small, rows, FIT.filled("item", "user"))
    assert some["has"] is None and close(some["new"], 3.75)
    filled = predictions(spark, small, rows, FIT.filled("item", "user", "tags"))
    assert close(filled["has"], 3.75 - 0.03125)


def test_unseen_item_and_user(spark, small):
    rows = [("listed", 1, 95), ("user", 77, 10)]
    assert predictions(spark, small, rows, FIT) == {"listed": None, "user": None}
    filled = predictions(spark, small, rows, FIT.filled("item", "user"))
    assert close(filled["listed"], 3.75 - 0.03125) and close(filled["user"], 3.75 + 0.4)


def test_item_in_no_list_has_no_tags_and_no_year(spark, small):
    assert predictions(spark, small, [("x", 1, 12345)], FIT.filled("item", "user")) == {"x": None}
    assert close(predictions(spark, small, [("x", 9, 12345)], FIT.filled("item", "user"))["x"], 3.75)


def test_unseen_year_poisons_the_error(spark, small):
    years = spark.createDataFrame([(1994, 0.1), (None, 0.3)], "year int, knn double")
    rows = [("old", 1, 97), ("none", 1, 96), ("ok", 1, 95)]
    full = M.Variant("x", "shrunk", True, True, True, True).filled("item")
    got = predictions(spark, small, rows, full, years)
    assert got["old"] is None
    assert close(got["ok"], 3.75 - 0.03125 + 0.1) and close(got["none"], 3.75 - 0.03125 + 0.3)
    rated = spark.createDataFrame([(*r, 4.0) for r in rows], "rating_key string, user_id bigint, item_id bigint, rating double")
    board = M.leaderboard(rated, small, [full, full.filled("item", "year")], years).collect()
    assert board[0]["rmse"] is None and board[0]["scored"] == 2 and board[0]["missing"] == 1
    assert board[1]["rmse"] is not None and board[1]["missing"] == 0


def test_unknown_tags_make_their_year_unknown(spark):
    model = fit(spark, FIXTURE + [("g", 1, 11, 3.0, None, "G (1994)", 0)], [DRAMA])
    years = {r["year"]: (r["b"], r["n"]) for r in M.year_residuals(model, "shrunk").collect()}
    assert years[1994] == (None, 5)
    assert years[2001][0] is not None


def test_specs_of_the_published_model():
    assert len(FILM_SHRUNK.stages) == 19
    assert [s.name for s in FILM_SHRUNK.stages[:2]] == ["drama", "comedy"]
    assert [s.name for s in FILM_PLAIN.stages[:2]] == ["comedy", "drama"]
    assert FILM_PLAIN.stages[2:] == tuple(Stage(s.name, s.token) for s in FILM_SHRUNK.stages[2:])


def test_a_hundred_tags(spark):
    words = [f"t{i:03d}" for i in range(100)]
    rng = random.Random(11)
    texts = {i: "|".join(rng.sample(words, 4)) for i in range(60)}
    rows = [
        (str(k), rng.randint(1, 8), i, rng.randint(1, 10) / 2, texts[i], f"T{i} (1990)", 0)
        for k, i in enumerate(rng.randrange(60) for _ in range(400))
    ]
    spec = Spec("shrunk", 1.75, 5.0, tuple(Stage(w, w, float(n % 7)) for n, w in enumerate(words)))
    train, items = frames(spark, rows)
    model = M.fit(train, items, [spec])
    *_, left = reference_fit(rows, spec)
    got = {r["rating_key"]: r["residual"] for r in M.fitted(train, model, "shrunk").collect()}
    assert len(got) == 400 and all(close(got[r[0]], e) for r, e in zip(rows, left))


def test_specs_of_one_fit_must_share_tags(spark):
    with pytest.raises(ValueError):
        fit(spark, FIXTURE, [DRAMA, SHRUNK])


# --- tuning


def refit_error(train, test, mu, key, has, penalty):
    """train, test: (row, residual) lists; error of the test rows after one more effect."""
    sums = {}
    for r, e in train:
        if has(r):
            s, n = sums.get(key(r), (0.0, 0))
            sums[key(r)] = (s + e, n + 1)
    b = {k: s / (n + penalty) for k, (s, n) in sums.items()}
    errors = [e - (b.get(key(r), 0.0) if has(r) else 0.0) for r, e in test]
    return math.sqrt(sum(e * e for e in errors) / len(errors)), b


def test_sweeps_equal_refits(spark):
    rows = random_rows(7, 900)
    train, test = rows[:700], rows[700:]
    ratings, items = frames(spark, rows)
    a, b = ratings.filter("int(rating_key) < 700"), ratings.filter("int(rating_key) >= 700")
    features = E.item_features(items, SHRUNK.tokens)
    mu = 2.7
    penalties = [0.0, 0.5, 4.0, 20.0]
    tr, te = [(r, r[3] - mu) for r in train], [(r, r[3] - mu) for r in test]

    def follow(key, has, penalty):
        _, effect = refit_error(tr, te, mu, key, has, penalty)
        move = lambda side: [(r, e - (effect.get(key(r), 0.0) if has(r) else 0.0)) for r, e in side]
        return move(tr), move(te)

    def agrees(errors, key, has):
        got = {r["penalty"]: r["rmse"] for r in errors.collect()}
        return all(close(got[p], refit_error(tr, te, mu, key, has, p)[0]) for p in penalties)

    item, user, always = (lambda r: r[2]), (lambda r: r[1]), (lambda r: True)
    assert agrees(tuning.sweep_item(a, b, mu, penalties), item, always)
    tr, te = follow(item, always, 1.75)
    cells = tuning.tuning_cells(a, b, mu, tuning.item_effect(a, features, mu, 1.75))
    assert agrees(tuning.sweep_user(cells, penalties), user, always)
    tr, te = follow(user, always, 5.0)
    slots = tuning.tuning_slots(cells, SHRUNK.tokens)
    for place, stage in enumerate(STAGES):
        has = lambda r, t=stage.token: t in r[4]
        assert agrees(tuning.sweep_tag(slots, SHRUNK, place, penalties), user, has)
        tr, te = follow(user, has, stage.penalty)


def test_held_out_key_without_train_rows_makes_the_error_unknown(spark):
    a, _ = frames(spark, FIXTURE[:3])
    b, _ = frames(spark, [("x", 1, 99, 3.0, "Drama", "Z", 0)])
    assert {r["rmse"] for r in tuning.sweep_item(a, b, 3.0, [0.0, 1.0]).collect()} == {None}


def test_unknown_tags_of_a_held_out_row_make_the_tag_error_unknown(spark):
    a, items = frames(spark, FIXTURE)
    b = spark.createDataFrame([("x", 1, 98, 3.0, 0), ("y", 2, 20, 3.0, 0)], RATING)
    items = items.unionByName(spark.createDataFrame([(98, "Z", None)], ITEM))
    effects = tuning.item_effect(a, E.item_features(items, DRAMA.tokens), 3.0, 1.0).fillna({"b_i": 0.0})

    def errors(held_out):
        slots = tuning.tuning_slots(tuning.tuning_cells(a, held_out, 3.0, effects), DRAMA.tokens)
        return {r["rmse"] is None for r in tuning.sweep_tag(slots, DRAMA, 0, [1.0, 2.0]).collect()}

    assert errors(b) == {True}
    assert errors(b.filter("item_id = 20")) == {False}


def test_best_penalty_prefers_the_lower_of_equals(spark):
    errors = spark.createDataFrame([(2.0, 0.5), (1.0, 0.5), (0.0, None)], "penalty double, rmse double")
    assert tuning.best_penalty(errors).first()["penalty"] == 1.0


def test_tune_reaches_every_effect(spark):
    rows = random_rows(8, 500)
    ratings, items = frames(spark, rows)
    a, b = ratings.filter("int(rating_key) < 400"), ratings.filter("int(rating_key) >= 400")
    spec = Spec("s", 0.0, 0.0, tuple(Stage(s.name, s.token, -1.0) for s in STAGES[:2]))
    tuned = tuning.tune(a, b, E.item_features(items, spec.tokens), 2.7, spec, [0.0, 5.0, 50.0])
    assert {tuned.item_penalty, tuned.user_penalty, *[s.penalty for s in tuned.stages]} <= {0.0, 5.0, 50.0}
    assert VIEW_SHRUNK.item_penalty == 1.75
    grids = {"item": [1.75], "user": [0.0, 5.5, 11.0], STAGES[0].name.lower(): [62.0, 36.0]}
    spec, choices = tuning.tuned(a, b, E.item_features(items, spec.tokens), 2.7, spec, grids)
    assert [c.effect for c in choices] == ["item", "user", *[s.name for s in spec.stages]]
    assert spec.item_penalty == 1.75 and choices[0].at_edge
    assert spec.user_penalty in grids["user"] and choices[1].at_edge == (spec.user_penalty == 11.0)
    assert spec.stages[0].penalty in (36.0, 62.0) and choices[2].at_edge
    assert spec.stages[1].penalty in tuning.PENALTIES
