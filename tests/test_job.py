"""The whole job on two small files in the published format, with the published settings."""

import os
import random

import pytest

from residua.plans import job
from residua.session import new_path, shared_folder
from residua.specs import FILM_SHRUNK


@pytest.fixture(scope="module")
def files(spark):
    rng = random.Random(5)
    tokens = [s.token for s in FILM_SHRUNK.stages]
    items = [f"{i}::Film {i} ({1960 + i % 40})::" + "|".join(rng.sample(tokens, 1 + i % 3)) for i in range(1, 61)]
    pairs = {(rng.randint(1, 40), rng.randint(1, 60)) for _ in range(1500)}
    # Items differ in level, so that the item effect helps on held-out rows.
    ratings = [
        f"{u}::{i}::{min(5, max(1, 1 + i % 4 + rng.randint(0, 1)))}::{900000000 + 86400 * u + i}" for u, i in sorted(pairs)
    ]
    paths = []
    for label, lines in (("ratings", ratings), ("items", items)):
        path = new_path(spark, label)
        spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
        paths.append(path)
    return paths, len(pairs)


def test_job(spark, files):
    paths, count = files
    done = job.run(spark, *paths, k=5)
    s = done.splits
    assert s.development.count() + s.validation.count() == count
    board = {r["method"]: r["rmse"] for r in done.leaderboard().collect()}
    assert len(board) == 6 and all(v is not None for v in board.values())
    assert board["item"] < board["average"] / 2
    assert board["shrunk item + user + tags"] < board["item + user + tags"]
    final = done.final().first()
    assert final["scored"] == s.validation.count() and final["rmse"] < board["average"] / 2
    assert done.model.users.selectExpr("size(tags_shrunk) AS k").distinct().collect()[0]["k"] == 19


def test_saved_run_gives_the_same_boards_in_another_session(spark, files):
    done = job.run(spark, *files[0], k=5, tune=True)
    assert any(s.item_penalty != FILM_SHRUNK.item_penalty for s in done.model.specs if s.name == "shrunk")
    path = new_path(spark, "run")
    done.save(path)
    again = job.load_run(spark.newSession(), path)
    assert again.model.specs == done.model.specs
    for ours, theirs in ((done.leaderboard(), again.leaderboard()), (done.final(), again.final())):
        rounded = [[(r["method"], r["missing"], round(r["rmse"], 9)) for r in board.collect()] for board in (ours, theirs)]
        assert rounded[0] == rounded[1]


def test_a_save_that_breaks_off_is_no_run_and_can_be_repeated(spark, files, monkeypatch):
    done = job.run(spark, *files[0], k=5)
    path, real, left = new_path(spark, "broken"), job.tables.save_table, [4]

    def failing(*arguments):
        left[0] -= 1
        if not left[0]:
            raise OSError("lost")
        real(*arguments)

    monkeypatch.setattr(job.tables, "save_table", failing)
    with pytest.raises(OSError):
        done.save(path)
    with pytest.raises(ValueError, match="no whole run"):
        job.load_run(spark, path)
    left[0] = -1
    done.save(path)
    assert job.load_run(spark, path).items.count() == 60
    with pytest.raises(ValueError, match="already"):
        done.save(path)


def test_a_run_with_a_path_leaves_nothing_else(spark, files):
    home = f"{shared_folder(spark)}/residua/{spark.sparkContext.applicationId}".removeprefix("file:")
    path = new_path(spark, "kept")
    before = set(os.listdir(home))
    done = job.run(spark, *files[0], k=5, path=path)
    assert set(os.listdir(home)) - before == {os.path.basename(path)}
    assert done.final().first()["scored"] == done.splits.validation.count() > 0
    with pytest.raises(Exception):
        job.run(spark, "/nowhere/ratings", files[0][1], path=new_path(spark, "never"))
    assert set(os.listdir(home)) - before == {os.path.basename(path)}


def test_no_shared_folder_is_one_clear_error():
    class Bare:
        class conf:
            @staticmethod
            def get(name, default):
                return default

        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Bare())
