"""The whole job: two delimited files to the errors of all models."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from residua.operators.effects import global_mean, item_features, item_totals
from residua.operators.nested import nested_split
from residua.operators.split import NestedSplit
from residua.plans import model as M
from residua.plans import tuning
from residua.session import scratch, stored
from residua.sources import tables
from residua.sources.delimited import read_items, read_ratings, with_key
from residua.specs import FILM_PLAIN, FILM_SHRUNK, Spec, Stage


MANIFEST = "manifest"
SPLITS = [f.name for f in fields(NestedSplit)]


@dataclass(frozen=True)
class Outcome:
    items: DataFrame
    splits: NestedSplit
    model: M.Model
    year_effect: DataFrame

    def leaderboard(self) -> DataFrame:
        """All models on the test rows."""
        return M.leaderboard(self.splits.test, self.model, year_effect=self.year_effect)

    def tables(self) -> dict[str, DataFrame]:
        """All that a saved run consists of, by name."""
        return {
            "items": self.items,
            **{name: getattr(self.splits, name) for name in SPLITS},
            "model_items": self.model.items,
            "model_users": self.model.users,
            "model_cells": self.model.cells,
            "year_effect": self.year_effect,
        }

    def save(self, path: str) -> None:
        """The tables and, when all are written, a manifest that names them; ``load_run`` reads it in any session.

        Tables go to a new folder under ``path`` each time, so a save that broke off can be repeated; a path that holds a
        whole run is an error.
        """
        spark = self.items.sparkSession
        if _manifest(spark, path):
            raise ValueError(f"{path} holds a run already")
        folder = f"tables-{uuid.uuid4().hex[:12]}"
        found = self.tables()
        for name, table in found.items():
            tables.save_table(table, f"{path}/{folder}/{name}", ["fold"] if name in SPLITS else ())
        manifest = {
            "folder": folder,
            "schemas": {name: table.schema.jsonValue() for name, table in found.items()},
            "mu": self.model.mu,
            "specs": [asdict(s) for s in self.model.specs],
        }
        text = spark.createDataFrame([(json.dumps(manifest),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{path}/{MANIFEST}")

    def final(self) -> DataFrame:
        """The last model on the validation rows."""
        return M.leaderboard(self.splits.validation, self.model, [M.FINAL], self.year_effect)


def run(
    spark: SparkSession,
    ratings_path: str,
    items_path: str,
    specs: Sequence[Spec] = (FILM_PLAIN, FILM_SHRUNK),
    k: int | None = None,
    tune: bool = False,
    path: str | None = None,
) -> Outcome:
    """``specs`` are a plain and a shrunk one; ``k`` fixes the number of neighbours.

    ``tune`` chooses the penalties of the shrunk one on the tuning split before anything is fitted.  With a ``path`` the
    run is saved there, all other tables that it stored are removed, and what is returned reads from there.
    """
    if path is not None:
        with scratch(spark):
            run(spark, ratings_path, items_path, specs, k, tune).save(path)
        return load_run(spark, path)
    rows = stored(with_key(read_ratings(spark, ratings_path)), "rows")
    items = stored(read_items(spark, items_path), "item-texts")
    splits = nested_split(rows)
    if tune:
        mu = global_mean(item_totals(splits.train)).first()["mu"]
        shrunk = next(s for s in specs if s.name == "shrunk")
        features = item_features(items, shrunk.tokens)
        chosen = tuning.tune(splits.tune_train, splits.tune_test, features, mu, shrunk)
        specs = [chosen if s is shrunk else s for s in specs]
    model = M.fit(splits.train, items, specs)
    return Outcome(items, splits, model, stored(M.year_effect(model, "shrunk", k), "year-effect"))


def _manifest(spark: SparkSession, path: str) -> dict | None:
    """What a whole run says of itself; None if there is none."""
    try:
        lines = spark.read.text(f"{path}/{MANIFEST}").take(1)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return json.loads(lines[0]["value"]) if lines else None


def load_run(spark: SparkSession, path: str) -> Outcome:
    """A run that ``Outcome.save`` wrote; one without a manifest is not whole, and an error."""
    manifest = _manifest(spark, path)
    if manifest is None:
        raise ValueError(f"{path} holds no whole run")
    specs = tuple(
        Spec(**{**s, "stages": tuple(Stage(**stage) for stage in s["stages"])}) for s in manifest["specs"]
    )

    def read(name: str) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schemas"][name])
        return tables.load_table(spark, f"{path}/{manifest['folder']}/{name}", schema).select(*schema.names)

    model = M.Model(specs, manifest["mu"], *[read(f"model_{name}") for name in ("items", "users", "cells")])
    return Outcome(read("items"), NestedSplit(**{name: read(name) for name in SPLITS}), model, read("year_effect"))
