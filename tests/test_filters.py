import pytest
from pyspark.sql import functions as F

from wayfare.operators import columns, filters, reports, sampling, splits
from wayfare.operators.sides import bounded_side, require_unique


def test_codes_drop_nulls_and_unknown(spark):
    rows = [(1, 1, 1), (2, 6, 6), (3, 1, 1), (1, 7, 1), (1, 1, 2), (None, 1, 1)]
    df = spark.createDataFrame(rows, "VendorID int, payment_type int, RatecodeID int")
    assert filters.keep(df, *filters.code_rules()).count() == 2
    assert filters.keep(df, *filters.code_rules(rate_codes=(2,))).count() == 1


def test_names_resolve_in_any_case(spark):
    df = spark.createDataFrame([(1, 3, 5)], "vendorid int, Payment_type int, RateCodeID int")
    assert filters.keep(df, *filters.code_rules()).count() == 1


def test_limits_are_open(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (4.0,), (5.0,)], "passenger_count double")
    assert filters.keep(df, filters.passenger_rule()).count() == 2
    df = spark.createDataFrame([(0.0,), (24.9,), (25.0,)], "trip_distance double")
    assert filters.keep(df, filters.distance_rule()).count() == 1


def test_duration_modes(spark):
    df = spark.createDataFrame([(-5,), (0,), (1,), (10799,), (10800,)], "d long")
    assert filters.keep(df, filters.duration_rule("d")).count() == 2
    assert filters.keep(df, filters.duration_rule("d", positive=False)).count() == 4


def test_origin_band_is_half_open(spark):
    df = spark.createDataFrame([(239, 7), (239, 9), (239, 10), (1, 8)], "PULocationID int, time_bin int")
    assert filters.keep(df, filters.origin_band_rule(239, 7, 10)).count() == 2


def test_null_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, `b c` string")
    assert filters.drop_null_rows(df).count() == 1
    assert [r["a"] for r in filters.rows_with_nulls(df).collect()] == [1]
    report = {r["column"]: tuple(r)[1:] for r in reports.null_report(df).collect()}
    assert report == {"a": (2, 0, False), "b c": (1, 1, True)}


def test_log_of_zero_is_not_kept(spark):
    df = spark.createDataFrame([(0,), (2,), (100_000,)], "count long")
    assert [r[0] for r in filters.log_below(df, "count", 10).collect()] == [2]


def test_rule_report_counts_survivors_in_order(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 30.0), (9, 1.0), (None, 2.0)], "VendorID int, trip_distance double")
    rules = [("vendor", F.col("VendorID").isin(1, 2)), filters.distance_rule()]
    assert [tuple(r) for r in reports.rule_report(df, rules).orderBy("step").collect()] == [
        (1, "vendor", 4, 2),
        (2, "distance", 2, 1),
    ]


def test_keyed_sample_does_not_depend_on_layout(spark):
    df = spark.range(5000)
    few = sampling.keyed_sample(df.coalesce(1), ["id"], 0.3)
    many = sampling.keyed_sample(df.repartition(13), ["id"], 0.3)
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()
    assert 0.25 < few.count() / 5000 < 0.35
    assert sampling.keyed_sample(df, ["id"], 1.0).count() == 5000


def test_bernoulli_sample_is_seeded(spark):
    df = spark.range(0, 1000, 1, 4)
    assert sampling.bernoulli_sample(df, 0.5).collect() == sampling.bernoulli_sample(df, 0.5).collect()


def test_splits(spark):
    rows = [(2020, 12), (2021, 8), (2021, 9), (2022, 1), (2019, 3)]
    df = spark.createDataFrame(rows, "year int, month int")
    three = [r["split"] for r in splits.three_way_split(df).collect()]
    assert three == ["train", "train", "validation", "test", None]
    two = [r["split"] for r in splits.two_way_split(df).collect()]
    assert two == ["train", "train", "validation", "train", "train"]


def test_side_over_the_limit_has_no_hint(spark):
    df = spark.range(1000).withColumn("text", F.lit("abc"))
    def hinted(side):
        return "ResolvedHint" in side._jdf.queryExecution().analyzed().toString()
    assert hinted(bounded_side(df))
    assert not hinted(bounded_side(df, limit=100))
    assert bounded_side(df.limit(0)).count() == 0


def test_duplicate_dimension_key_is_refused(spark):
    with pytest.raises(ValueError):
        require_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])


def test_first_rows_and_first_per_key(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (2, 9)], "k int, v int")
    assert [tuple(r) for r in reports.first_rows(df, 1, "v", skip=1).collect()] == [(1, 3)]
    assert sorted(tuple(r) for r in reports.first_per_key(df, ["k"], "v").collect()) == [(1, 2), (2, 9)]


def test_columns_by_place(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, `b c` int, d int, e int")
    assert columns.by_place(df, 1, 3).columns == ["b c", "d"]
    assert columns.by_place(df, stop=-1).columns == ["a", "b c", "d"]
    assert columns.relabelled(columns.by_place(df, 0, 2), ["x", "y"]).columns == ["x", "y"]
    assert columns.tagged(df, "hue", "Actual").first()["hue"] == "Actual"
