from pyspark.sql import functions as F

from residua.session import new_path, shared_folder, stored
from residua.sources import delimited, tables


def write(spark, lines):
    path = new_path(spark, "lines")
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    return path


def test_items_keep_separators_in_the_last_field(spark):
    path = write(spark, ["1::A::B::C", '2::"Q" (1990)::War', "x::T::U", "3::only title", "4::É (2000)::"])
    rows = {r["title"]: r for r in delimited.read_items(spark, path).collect()}
    assert (rows["A"]["item_id"], rows["A"]["tags"]) == (1, "B::C")
    assert (rows['"Q" (1990)']["item_id"], rows['"Q" (1990)']["tags"]) == (2, "War")
    assert rows["T"]["item_id"] is None
    assert rows["only title"]["tags"] is None
    assert rows["É (2000)"]["tags"] == ""


def test_ratings_are_typed(spark):
    path = write(spark, ["1::122::5::838985046", "2::185::3.5::838983525"])
    rows = sorted(map(tuple, delimited.read_ratings(spark, path).collect()))
    assert rows == [(1, 122, 5.0, 838985046), (2, 185, 3.5, 838983525)]


def test_every_line_is_read_or_rejected_with_a_reason(spark):
    bad = {
        "1::2::x::4": "rating", "1::2::::4": "rating", "1::2::NaN::4": "rating", "1::2::-Infinity::4": "rating",
        "1::3::4::100::extra": "fields", "1::2::3": "fields", "": "blank", "  ": "blank", "a::b::c::d": "user_id",
        "1::2.5::3::4": "item_id", "1::2::3::": "ts", "1::99999999999999999999::3::4": "item_id", ":::::": "fields",
    }
    good = ["1::122::5::838985046", "1::122::5::838985046", "2::185::3.5::0", "-1::0::-0.5::-7", " 3 ::4::1e0::5"]
    path = write(spark, [*bad, *good])
    rows = sorted(map(tuple, delimited.read_ratings(spark, path).collect()))
    assert rows == [(-1, 0, -0.5, -7), (1, 122, 5.0, 838985046), (1, 122, 5.0, 838985046), (2, 185, 3.5, 0), (3, 4, 1.0, 5)]
    assert dict(map(tuple, delimited.unreadable_ratings(spark, path).collect())) == bad
    assert delimited.parse_ratings(spark, path).count() == len(bad) + len(good)


def test_join_keeps_ratings_of_unknown_items(spark):
    ratings = spark.createDataFrame([(1, 10, 4.0, 0), (1, 11, 3.0, 0)], delimited.RATINGS)
    items = spark.createDataFrame([(10, "A (1990)", "x")], delimited.ITEMS)
    rows = {r["item_id"]: r["title"] for r in delimited.join_items(ratings, items).collect()}
    assert rows == {10: "A (1990)", 11: None}


def test_saved_table_reads_back_by_fold(spark):
    df = spark.createDataFrame([(1, "train"), (2, "test"), (3, "train")], "id bigint, fold string")
    path = new_path(spark, "saved")
    tables.save_table(df, path, ["fold"])
    back = tables.load_table(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    train = back.filter("fold = 'train'")
    assert "PartitionFilters: [isnotnull(fold" in train._jdf.queryExecution().toString()
    assert {r["fold"]: r["n"] for r in tables.row_counts(back, "fold").collect()} == {"train": 2, "test": 1}
    assert [r["id"] for r in tables.peek(back, ["id"], 2).collect()] == [1, 2]


def test_stored_goes_to_the_named_folder(spark):
    df = stored(spark.range(3).withColumn("x", F.lit(None).cast("double")), "t")
    assert shared_folder(spark).rstrip("/") in df.inputFiles()[0]
    assert df.count() == 3
