import datetime as dt

from pyspark.sql import functions as F

from residua.functions import scalar as X
from residua.functions.metrics import PROPAGATE, SKIP, rmse


def one(spark, column, **values):
    types = {int: "bigint", str: "string", float: "double", type(None): "string"}
    schema = ", ".join(f"{k} {types[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def test_release_year_must_end_the_title(spark):
    assert one(spark, X.release_year("t"), t="A (1994)") == 1994
    assert one(spark, X.release_year("t"), t="D") is None
    assert one(spark, X.release_year("t"), t="D (1994) x") is None
    assert one(spark, X.release_year("t"), t="D (94)") is None
    assert one(spark, X.release_year("t"), t="D (1990) (2001)") == 2001


def test_first_token_is_the_first_alphabetic_run(spark):
    assert one(spark, X.first_token("t"), t="(no genres listed)") == "no"
    assert one(spark, X.first_token("t"), t="Sci-Fi|War") == "Sci"
    assert one(spark, X.first_token("t"), t="123") is None


def test_tag_test_is_by_substring_and_case(spark):
    assert one(spark, X.has_tag("t", "Sci"), t="Sci-Fi|War") is True
    assert one(spark, X.has_tag("t", "old"), t="STANDARD|cold|bolt") is True
    assert one(spark, X.has_tag("t", "war"), t="Sci-Fi|War") is False


def test_hits_are_the_places_of_the_tokens(spark):
    tokens = ["Drama", "War", "it's", "a\\b"]
    assert one(spark, X.token_hits("t", tokens), t="War|Drama") == [0, 1]
    assert one(spark, X.token_hits("t", tokens), t="it's|a\\b") == [2, 3]
    assert one(spark, X.token_hits("t", tokens), t="none") == []
    assert one(spark, X.token_hits("t", tokens), t=None) is None


def test_dates_are_utc(spark):
    assert one(spark, X.utc_date("s"), s=789652009) == dt.date(1995, 1, 9)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert one(spark, X.utc_date("s"), s=820454400) == dt.date(1996, 1, 1)
        assert one(spark, X.utc_date("s"), s=-1) == dt.date(1969, 12, 31)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_whole_months_at_month_ends(spark):
    def months(a, b):
        start, end = F.to_date(F.lit(a)), F.to_date(F.lit(b))
        return one(spark, X.whole_months(start, end), x=1)

    assert months("1995-01-31", "1995-03-01") == 1
    assert months("1995-01-30", "1995-02-28") == 0
    assert months("1995-01-09", "1995-02-09") == 1


def test_whole_weeks(spark):
    start, end = F.to_date(F.lit("2000-01-01")), F.to_date(F.lit("2000-01-20"))
    assert one(spark, X.whole_weeks(start, end), x=1) == 2


def test_bad_number_is_null(spark):
    assert one(spark, X.number("t"), t="x1") is None
    assert one(spark, X.number("t"), t="1.5") == 1.5


def test_grid_includes_both_ends():
    assert X.grid(0, 30) == [float(i) for i in range(31)]
    assert X.grid(0, 1, 0.25) == [0.0, 0.25, 0.5, 0.75, 1.0]


def test_rmse_policies(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None), (3.0, 1.0)], "t double, p double")
    both = df.select("t", "p").agg(
        rmse(F.col("t"), F.col("p"), PROPAGATE).alias("a"), rmse(F.col("t"), F.col("p"), SKIP).alias("b")
    ).first()
    assert both["a"] is None
    assert abs(both["b"] - 2.5**0.5) < 1e-12
