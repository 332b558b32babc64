"""The tables that many queries of one session start from, each made once and stored.

The job this package reproduces saves its splits and reads them back in every later step; this is
the same, in the shared folder of the cluster.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.operators import effects as E
from residua.operators.knn import choose_k, knn_smooth
from residua.operators.sampling import draw_with_replacement, panels
from residua.operators.nested import nested_split
from residua.operators.split import NestedSplit
from residua.plans import explore, tuning
from residua.plans import model as M
from residua.session import stored
from residua.sources import testview
from residua.specs import VIEW_PLAIN, VIEW_SHRUNK

SAMPLED_USERS = 1000  # fixed value
PANELS, PANEL_SIZE = 5, 5  # fixed values
UNKNOWN_EVERY = 5


class Workspace:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    _open: dict[tuple[str, str], Workspace] = {}

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Workspace:
        key = (spark.sparkContext.applicationId, folder)
        if key not in cls._open:
            cls._open[key] = cls(spark, folder)
        return cls._open[key]

    @cached_property
    def rows(self) -> DataFrame:
        return stored(testview.ratings(self.spark, self.folder), "rows")

    @property
    def items(self) -> DataFrame:
        return testview.items(self.spark, self.folder)

    @property
    def features(self) -> DataFrame:
        return E.item_features(self.items, VIEW_SHRUNK.tokens)

    @cached_property
    def splits(self) -> NestedSplit:
        return nested_split(self.rows)

    @cached_property
    def model(self) -> M.Model:
        """Both specs, fitted on the train rows."""
        return M.fit(self.splits.train, self.items, [VIEW_PLAIN, VIEW_SHRUNK])

    @cached_property
    def mu(self) -> float:
        """The mean of the model, for what needs no more of it."""
        totals = E.item_totals(self.splits.train)
        return E.global_mean(E.item_table(totals, self.features)).first()["mu"]

    @property
    def partly_rated(self) -> DataFrame:
        """The whole view, the ratings of a fixed fifth of its rows unknown."""
        unknown = (F.col("user_id") + F.col("item_id")) % UNKNOWN_EVERY == 0
        return self.rows.withColumn("rating", F.when(~unknown, F.col("rating")))

    @cached_property
    def partly_rated_model(self) -> M.Model:
        return M.fit(self.partly_rated, self.items, [VIEW_SHRUNK])

    @property
    def thin_train(self) -> DataFrame:
        """Train rows without every fifth user and every seventh item."""
        return self.splits.train.filter("user_id % 5 <> 0 AND item_id % 7 <> 0")

    @cached_property
    def thin_model(self) -> M.Model:
        return M.fit(self.thin_train, self.items, [VIEW_SHRUNK])

    @cached_property
    def residual_sums(self) -> DataFrame:
        return stored(explore.residual_sums(self.fitted()), "residual-sums")

    @cached_property
    def years(self) -> DataFrame:
        return stored(M.year_residuals(self.model, "shrunk"), "years")

    @cached_property
    def year_effect(self) -> DataFrame:
        return stored(knn_smooth(self.years, choose_k(self.years).first()["k"]), "year-effect")

    @cached_property
    def tuning_cells(self) -> DataFrame:
        train, test = self.splits.tune_train, self.splits.tune_test
        items = tuning.item_effect(train, self.features, self.mu, VIEW_SHRUNK.item_penalty)
        return stored(tuning.tuning_cells(train, test, self.mu, items), "tuning-cells")

    def fitted(self) -> DataFrame:
        return M.fitted(self.splits.train, self.model, "shrunk")

    @cached_property
    def profile(self) -> DataFrame:
        """Tag profiles of the sampled users: at most as many rows as draws times tags."""
        sample = self.sampled_users()
        return stored(
            explore.profiles(self.splits.train, self.model, "plain", sample, VIEW_PLAIN.stages), "profile"
        )

    def sampled_users(self) -> DataFrame:
        return draw_with_replacement(self.model.users, "user_id", SAMPLED_USERS, "profile")

    def user_panels(self) -> DataFrame:
        return panels(self.model.users, "user_id", PANELS, PANEL_SIZE, "panel")
