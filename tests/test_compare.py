"""Pairing by counts must give what the trip-by-trip join gives."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wayfare.functions.calendar import with_calendar
from wayfare.operators import compare, enrich, filters, reports
from wayfare.operators.compare import PAIR_KEYS

SCHEMA = "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, PULocationID int, DOLocationID int"


@pytest.fixture(scope="module")
def modes(spark):
    """A third of all trips lies in one hour between one pair of zones; some durations are
    out of bounds, some zones missing."""
    rng = random.Random(7)

    def trips(n):
        rows = []
        for i in range(n):
            hot = i % 3 == 0
            start = datetime(2021, 3, 1, 8) if hot else datetime(2021, 3, 1) + timedelta(hours=rng.randrange(200))
            seconds = rng.choice([-5, 0, 10800, 20000]) if i % 11 == 0 else rng.randrange(1, 60)
            zone = None if i % 17 == 0 else 1 if hot else rng.randrange(3)
            rows.append((start, start + timedelta(seconds=seconds), zone, 2))
        return spark.createDataFrame(rows, SCHEMA).repartition(4)

    return trips(300), trips(200)


@pytest.fixture(scope="module")
def weather(spark):
    return enrich.weather_side(
        enrich.prepare_weather(
            spark.createDataFrame(
                [(datetime(2021, 3, 1).date(), 8, 50.0, "Fair")],
                "Date date, `Time bin` int, Temperature double, Condition string",
            )
        )
    )


def _full_join(modes):
    """The pairs one by one, small enough here."""
    def kept(trips, name):
        named = with_calendar(trips, f"trip_duration_{name}").drop("pickup_datetime", "dropoff_datetime")
        return filters.keep(named, filters.weekday_rule(), filters.duration_rule(f"trip_duration_{name}"))

    pairs = kept(modes[0], "taxis").join(kept(modes[1], "bikes"), PAIR_KEYS)
    return pairs.withColumn("d", F.col("trip_duration_taxis") - F.col("trip_duration_bikes")).persist()


@pytest.fixture(scope="module")
def pairs(modes):
    return _full_join(modes)


def _same(a, b):
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("key_product", [compare.KEY_PRODUCT, 50])
def test_merged_expands_to_all_pairs(modes, weather, pairs, key_product):
    merged = compare.merged_trips(*modes, weather, key_product=key_product)
    columns = [*PAIR_KEYS, "trip_duration_taxis", "trip_duration_bikes"]
    expanded = compare.expand_pairs(merged, chunk=7)
    assert _same(expanded.select(*columns), pairs.select(*columns))
    assert merged.groupBy(*columns).count().filter("count > 1").isEmpty()


def test_merged_traffic_and_weather(modes, weather):
    merged = compare.merged_trips(*modes, weather)
    hot = merged.filter("day = 60 AND time_bin = 8").first()
    taxis = with_calendar(modes[0]).filter("day = 60 AND time_bin = 8").count()
    assert hot["count_taxis"] == taxis and hot["Temperature"] == 50.0
    assert "Date" not in merged.columns and "Condition" not in merged.columns
    assert not merged.filter("Temperature IS NULL").isEmpty()


def test_means_equal_the_mean_of_pairs(modes, pairs):
    fast = compare.pair_means(compare.key_sums(*modes), "time_bin")
    slow = pairs.groupBy("time_bin").agg(
        F.count(F.lit(1)).cast("decimal(38,0)").alias("pairs"),
        (F.sum("trip_duration_taxis").cast("double") / F.count(F.lit(1))).alias("avg_taxis"),
        (F.sum("trip_duration_bikes").cast("double") / F.count(F.lit(1))).alias("avg_bikes"),
        (F.sum("d").cast("double") / F.count(F.lit(1))).alias("avg_difference"),
    )
    assert _same(fast, slow)


def test_outcomes_balance_and_spread(modes, pairs):
    outcomes = compare.key_outcomes(compare.duration_counts(*modes))
    slow = pairs.groupBy(*PAIR_KEYS).agg(
        F.count(F.lit(1)).cast("decimal(38,0)").alias("pairs"),
        F.sum("d").cast("decimal(38,0)").alias("difference_sum"),
        F.sum(F.col("d") * F.col("d")).cast("decimal(38,0)").alias("difference_squares"),
        F.count_if(F.col("d") > 0).cast("decimal(38,0)").alias("taxi_slower_pairs"),
    )
    assert _same(outcomes, slow)
    balance = {r[0]: int(r[1]) for r in compare.class_balance(outcomes).collect()}
    slower = pairs.filter("d > 0").count()
    assert balance == {0: pairs.count() - slower, 1: slower}
    spread = compare.difference_spread(outcomes).first()
    assert spread["variance"] == pytest.approx(pairs.agg(F.var_samp("d")).first()[0])


def test_counts_do_not_overflow(spark):
    keys = (2021, 1, 4, 8, 1, 2, 2)
    n = 10**12
    sums = spark.createDataFrame(
        [keys + (n, n, n * 3000, n * 1000)],
        "year int, month int, day int, time_bin int, PULocationID int, DOLocationID int, day_of_week int, "
        "n_taxis long, n_bikes long, taxi_seconds long, bike_seconds long",
    )
    row = compare.pair_means(sums, "time_bin").first()
    assert int(row["pairs"]) == 10**24 and row["avg_difference"] == 2000.0
    counts = spark.createDataFrame(
        [keys + (3000, n, 0), keys + (1000, 0, n)],
        "year int, month int, day int, time_bin int, PULocationID int, DOLocationID int, day_of_week int, "
        "trip_duration long, n_taxis long, n_bikes long",
    )
    outcome = compare.key_outcomes(counts).first()
    assert int(outcome["taxi_slower_pairs"]) == 10**24
    assert int(outcome["difference_squares"]) == 10**24 * 2000**2


def test_traffic_equals_a_window(spark, modes):
    from pyspark.sql import Window

    trips = with_calendar(modes[0])
    counted = enrich.with_traffic(trips)
    over = trips.withColumn("count", F.count(F.lit(1)).over(Window.partitionBy(*enrich.HOUR_KEYS)))
    assert _same(counted, over)


def test_weather_with_a_repeated_hour_is_refused(spark):
    raw = spark.createDataFrame([(datetime(2021, 3, 1).date(), 8), (datetime(2021, 3, 1).date(), 8)], "Date date, `Time bin` int")
    with pytest.raises(ValueError):
        enrich.weather_side(enrich.prepare_weather(raw.withColumn("Condition", F.lit("Fair"))))


def test_od_advantage_scales_by_the_peak(spark):
    rows = [(239, 7, d, v) for d, v in ((1, 100), (1, 300), (2, 500), (3, 50))]
    taxis = spark.createDataFrame(rows, "PULocationID int, time_bin int, DOLocationID int, trip_duration long")
    bikes = spark.createDataFrame([(239, 7, 1, 100), (239, 7, 2, 900)], taxis.schema)
    got = {r["DO_ID"]: (r["difference"], r["scaled"]) for r in reports.od_advantage(taxis, bikes, 7, 10).collect()}
    assert got == {1: (100.0, 0.25), 2: (-400.0, -1.0)}
    mapped = reports.with_origin_row(reports.od_advantage(taxis, bikes, 7, 10).select("DO_ID", "scaled"))
    assert sorted(tuple(r) for r in mapped.collect()) == [(1, 0.25), (2, -1.0), (239, 1.0)]


def test_cells_of_the_merged_table_equal_those_of_the_outcomes(modes, weather):
    """Training can start from the stored merged table as well as from the trips."""
    from wayfare.models import cells

    merged = compare.merged_trips(*modes, weather)
    stored = cells.label_cells(merged, "trip_difference", PAIR_KEYS, weight="pairs")
    direct = cells.difference_cells(
        compare.key_outcomes(compare.duration_counts(*modes)), weather.drop("Date"), enrich.HOUR_KEYS
    )
    columns = [*PAIR_KEYS, *(F.round(c, 6).alias(c) for c in ("weight", "label", "within"))]
    assert stored.count() > 0 and _same(stored.select(*columns), direct.select(*columns))


def test_oversized_sides_give_the_same_rows(spark, modes, weather, monkeypatch):
    """Without the broadcast hint the joins are shuffled instead, with equal results."""
    from wayfare.operators import sides
    from wayfare.plans import process

    expected = process.mode_trips(modes[0], weather)
    monkeypatch.setattr(
        enrich, "bounded_side", lambda df: sides.bounded_side(df, limit=-1)
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = process.mode_trips(modes[0], weather.hint("merge"))
        assert _same(shuffled, expected) and not shuffled.isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_row_with_very_many_pairs_begins_to_expand(spark, modes, weather):
    row = compare.merged_trips(*modes, weather).limit(1)
    huge = row.withColumn("pairs", F.lit(4 * 10**13).cast("decimal(38,0)"))
    assert len(compare.expand_pairs(huge.coalesce(1), chunk=10**7).limit(3).collect()) == 3


def test_pages_of_pairs_equal_slices_of_all(spark):
    rng = random.Random(12)
    rows = [
        (2021, 1, 4, k % 3, 10 + k % 2, 20, 2, rng.choice([None, 5, 6, 60, 61, 600]) if k % 9 else 70 + k, rng.randrange(4), rng.randrange(4))
        for k in range(60)
    ]
    keys = ", ".join(f"{c} int" for c in compare.PAIR_KEYS)
    counts = spark.createDataFrame(rows, f"{keys}, trip_duration long, n_taxis long, n_bikes long")
    counts = counts.groupBy(*compare.PAIR_KEYS, "trip_duration").agg(F.sum("n_taxis").alias("n_taxis"), F.sum("n_bikes").alias("n_bikes"))
    grouped = {}
    for r in counts.collect():
        if r["trip_duration"] is not None:
            own = grouped.setdefault(tuple(r[c] for c in compare.PAIR_KEYS), ([], []))
            own[0].extend([r["trip_duration"]] * r["n_taxis"])
            own[1].extend([r["trip_duration"]] * r["n_bikes"])
    every = [(*key, t, b) for key, (ts, bs) in sorted(grouped.items()) for t in sorted(ts) for b in sorted(bs)]
    assert len(every) > 100
    for first, size in ((0, 7), (3, 1), (len(every) // 2, 40), (len(every) - 5, 50), (0, len(every)), (len(every), 5)):
        found = sorted(map(tuple, compare.pair_page(counts, first, size, chunk=9).collect()))
        assert found == [(first + k, *row) for k, row in enumerate(every[first : first + size])], (first, size)


def test_a_page_of_very_many_pairs(spark):
    """10**8 pairs of one key: a page from their middle."""
    keys = ", ".join(f"{c} int" for c in compare.PAIR_KEYS)
    counts = spark.createDataFrame(
        [(2021, 1, 4, 9, 10, 20, 2, 100, 5_000, 4_000), (2021, 1, 4, 9, 10, 20, 2, 200, 5_000, 6_000)],
        f"{keys}, trip_duration long, n_taxis long, n_bikes long",
    )
    found = compare.pair_page(counts, 49_999_990, 20).orderBy("number").collect()
    assert [(r["trip_duration_taxis"], r["trip_duration_bikes"]) for r in found] == [(100, 200)] * 10 + [(200, 100)] * 10


def test_pairs_are_spread_by_their_number_and_counts_of_any_size_multiply(spark, modes, weather):
    few = compare.merged_trips(*modes, weather, key_product=20)
    assert few.rdd.getNumPartitions() > 8  # more than the session's, though the counts are a few bytes
    key = (2021, 3, 60, 8, 1, 2, 2)
    schema = "year int, month int, day int, time_bin int, PULocationID int, DOLocationID int, day_of_week int"
    counts = spark.createDataFrame(
        [(*key, 5, 2**40, 0), (*key, 7, 3, 2**41)], schema + ", trip_duration long, n_taxis long, n_bikes long"
    )
    found = compare.merged_counts(counts, weather).select("trip_duration_taxis", "pairs", "count_bikes").collect()
    assert sorted(tuple(x) for x in found) == [(5, 2**81, 2**41), (7, 3 * 2**41, 2**41)]


def test_a_taxi_row_meets_one_row_of_its_key_and_lists_the_pairs(spark, weather):
    """A key of 300 x 200 durations, one of a single pair, one without bikes and one without zone."""
    schema = "year int, month int, day int, time_bin int, PULocationID int, DOLocationID int, day_of_week int"
    busy, small, alone, lost = ((2021, 3, 60, hour, zone, 2, 2) for hour, zone in ((8, 1), (9, 1), (8, 2), (8, None)))
    rows = [(*busy, d, 1 + d % 3 if d <= 300 else 0, d % 2) for d in range(1, 401)]
    rows += [(*small, 7, 2, 5), (*alone, 7, 2, 0), (*lost, 7, 2, 5), (*busy, None, 9, 9)]
    counts = spark.createDataFrame(rows, schema + ", trip_duration long, n_taxis long, n_bikes long").repartition(4)
    expected = sorted(
        [(8, t, b, float(1 + t % 3), t - b, int(t > b), 1, 50.0) for t in range(1, 301) for b in range(1, 401, 2)]
        + [(9, 7, 7, 10.0, 0, 0, 1, None)],
        key=lambda row: row[:3],
    )
    columns = ["time_bin", "trip_duration_taxis", "trip_duration_bikes", "pairs", "trip_difference"]
    columns += ["better_travel_type", "peak_hours", "Temperature"]
    for key_product in (1000, compare.KEY_PRODUCT):
        merged = compare.merged_counts(counts, weather, key_product=key_product, pairs_type="double")
        assert dict(merged.dtypes)["pairs"] == "double"
        assert sorted((tuple(r) for r in merged.select(*columns).collect()), key=lambda row: row[:3]) == expected
        wide = compare.merged_counts(counts, weather, key_product=key_product)
        assert dict(wide.dtypes)["pairs"] == compare.WIDE
        assert wide.selectExpr("sum(pairs)").first()[0] == sum(row[3] for row in expected)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "posexplode(durations" in plan
        paired = next(line for line in plan.splitlines() if "Join" in line and "Inner" in line)
        assert "SortMergeJoin" in paired  # tables this small would be broadcast otherwise
