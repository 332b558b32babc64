"""Times the headline queries; prints one JSON line.

``prepare`` reads the tables, joins them to rating rows and makes the three nested splits;
``fit`` fits both models.  The queries after that start from those stored tables, as every step of
the job does.  ``staged_fit`` fits again from the stored train rows, nothing reused.
"""

from __future__ import annotations

import json
import os
import time

from residua.plans.queries import all_queries
from residua.plans.workspace import Workspace
from residua.session import local_session

HEADLINE = [
    "ratings_view",
    "ingest_joined",
    "split_outer",
    "strata_assignment",
    "item_effect_shrunk",
    "staged_fit",
    "tag_effects_shrunk",
    "fitted_table",
    "score_full_validation",
    "leaderboard",
    "final_holdout",
    "sweep_item",
    "sweep_user",
    "sweep_tag",
    "year_residual",
    "knn_smooth",
    "choose_k",
    "hist_user_effect",
    "tag_frequency_first_token",
    "user_tag_profile",
    "tag_box_stats",
    "panel_profiles",
    "residual_by_month",
    "residual_by_age",
    "tuned_penalties",
    "job_from_files",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=8, memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, body) -> None:
        start = time.perf_counter()
        body()
        times[name] = round(time.perf_counter() - start, 3)

    spark.range(1000).selectExpr("sum(id)").collect()  # the session itself is not measured
    work = Workspace.of(spark, folder)
    timed("prepare", lambda: work.splits)
    timed("fit", lambda: (work.model, work.year_effect, work.tuning_cells))
    queries = all_queries()
    for name in HEADLINE:
        timed(name, lambda: queries[name](spark, folder).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
