from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wayfare.operators import compare
from wayfare.plans import clean, modelling, process
from wayfare.sources import feeds, publish, schemas, sinks


def test_months_of_the_study():
    months = feeds.expand_months()
    assert len(months) == 22 and months[0] == (2020, 7) and months[-1] == (2022, 4)


def test_month_table(spark):
    rows = feeds.month_table(spark, "2020-11-01", "2021-02-01").collect()
    assert [(r["year"], r["month"]) for r in rows] == [(2020, 11), (2020, 12), (2021, 1), (2021, 2)]
    assert rows[0]["first_day"] == date(2020, 11, 1)


def test_unknown_feed(spark):
    with pytest.raises(ValueError):
        feeds.read_feed(spark, "/nowhere", "z")


def test_bike_layout_changes_in_february_2021():
    assert feeds.bike_schema(2021, 1) is schemas.BIKES_OLD
    assert feeds.bike_schema(2021, 2) is feeds.bike_schema(2022, 1) is schemas.BIKES_NEW


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    path = str(tmp_path / "zones")
    rows = [("Queens", "1", "x"), ("Bronx", "?", "y")]
    sinks.write_csv(spark.createDataFrame(rows, "Borough string, LocationID string, extra string"), path)
    typed = feeds.read_csv(spark, path, schemas.ZONE_LOOKUP)
    assert typed.columns == ["LocationID", "Borough"]
    assert sorted(map(tuple, typed.collect()), key=str) == [(1, "Queens"), (None, "Bronx")]
    assert {r["LocationID"] for r in feeds.read_csv(spark, path).collect()} == {"1", "?"}
    with pytest.raises(AnalysisException):
        feeds.read_csv(spark, path, schemas.WEATHER)


def test_station_ids_stay_text(spark, tmp_path):
    path = str(tmp_path / "stations")
    row = (1, "A", 40.7, -73.9, 237, "3.10", 40.7, -73.9)
    sinks.write_csv(spark.createDataFrame([row], schemas.STATIONS), path)
    assert feeds.read_csv(spark, path, schemas.STATIONS).first()["new_id"] == "3.10"


def test_union_is_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(4, 3)], "y int, x int")
    assert sorted(tuple(r) for r in feeds.union_feeds([a, b]).collect()) == [(1, 2), (3, 4)]


def test_monthly_overwrite_keeps_other_months(spark, tmp_path):
    path = str(tmp_path / "trips")

    def trips(*moments):
        rows = [(m, m, 1, 2) for m in moments]
        return spark.createDataFrame(
            rows, "pickup_datetime timestamp, dropoff_datetime timestamp, PULocationID int, DOLocationID int"
        )

    def filed(df, month):
        return df.withColumns({"file_year": F.lit(2021), "file_month": F.lit(month)})

    def days():
        return sorted(r["pickup_datetime"].day for r in spark.read.parquet(path).collect())

    both = filed(trips(datetime(2021, 1, 5)), 1).unionByName(filed(trips(datetime(2021, 2, 5)), 2))
    assert sinks.write_months(both, path, [(2021, 1), (2021, 2)]) == 2
    # A trip dated in January comes with February's file: January keeps its own.
    strays = filed(trips(datetime(2021, 2, 7), datetime(2021, 1, 31)), 2)
    assert sinks.write_months(strays, path, [(2021, 2)]) == 2
    assert days() == [5, 7, 31]
    # A month that becomes empty keeps no stale rows.
    assert sinks.write_months(strays.limit(0), path, [(2021, 2)]) == 0
    assert days() == [5]
    with pytest.raises(Exception, match="not named"):
        sinks.write_months(strays, path, [(2021, 3)])


def test_split_write_partitions_the_input(spark, tmp_path):
    path = str(tmp_path / "split")
    df = spark.createDataFrame([(2020, 1), (2021, 2), (2022, 3)], "year int, v int")
    assert sinks.write_split(df, path) == {"train": 2, "test": 1}
    found = {(r["split"], r["v"]) for r in sinks.read_table(spark, path).collect()}
    assert found == {("train", 1), ("train", 2), ("test", 3)}


def test_schema_report(spark):
    report = feeds.schema_report(spark.createDataFrame([(1, "a")], "a int, b string"))
    assert [tuple(r)[:3] for r in report.collect()] == [(0, "a", "int"), (1, "b", "string")]


def test_two_old_stations_with_one_new_id_do_not_multiply_rides(spark):
    dims = spark.createDataFrame(
        [(5, 11, "N1"), (3, 10, "N1"), (7, 20, "N2")], "id int, `Taxi area code` int, new_id string"
    )
    rides = spark.createDataFrame(
        [("N1", "N2"), ("N1", "zzz")], "start_station_id string, end_station_id string"
    )
    side = clean.station_zone_side(dims, "new")
    got = clean.with_station_zones(rides, side, "new").select("PULocationID", "DOLocationID").collect()
    assert [tuple(r) for r in got] == [(10, 20)]


@pytest.fixture
def raw(spark, tmp_path):
    """One old-layout and one new-layout month of every feed, a few trips each."""
    root = tmp_path / "raw"
    months = [(2021, 1), (2021, 2)]
    names = "VendorID long, {p}pep_pickup_datetime timestamp_ntz, {p}pep_dropoff_datetime timestamp_ntz, " \
        "passenger_count double, trip_distance double, RatecodeID {kind}, payment_type long, PULocationID long, DOLocationID long"
    for year, month in months:
        at = datetime(year, month, 5, 9)
        late = at.replace(minute=20)
        kind = "long" if month == 1 else "double"
        code = 1 if month == 1 else 1.0
        good = (1, at, late, 1.0, 2.0, code, 1, 10, 20)
        bad = (1, at, late, 1.0, 2.0, code, 1, 10, 10)
        for folder, p, extra in (("yellow", "t", ""), ("green", "l", ", trip_type double")):
            rows = [r + ((1.0,) if extra else ()) for r in (good, bad)]
            frame = spark.createDataFrame(rows, names.format(p=p, kind=kind) + extra)
            if month == 2:  # published files gained columns over time
                frame = frame.withColumn("Airport_fee", F.lit(0.0))
            frame.write.parquet(str(root / folder / f"{folder}-{year}-{month:02d}.parquet"))
        spark.createDataFrame(
            [(at, late, 3.0, 10, 20, "N", "N"), (at, late, 3.0, 10, 20, "Y", "N")],
            "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, trip_miles double, "
            "PULocationID long, DOLocationID long, shared_match_flag string, wav_match_flag string",
        ).write.parquet(str(root / "fhvhv" / f"fhvhv-{year}-{month:02d}.parquet"))
    citi = root / "citi"
    citi.mkdir(parents=True)
    old = ",".join(schemas.BIKES_OLD.names)
    (citi / "202101-citibike-tripdata.csv").write_text(
        old + "\n600,2021-01-05 09:00:00,2021-01-05 09:10:00,1,A,40.1,-73.1,2,B,40.2,-73.2,9,s,1990,1\n"
        "600,2021-01-05 09:00:00,2021-01-05 09:10:00,1,A,40.1,-73.1,99,B,40.2,-73.2,9,s,1990,1\n"
        "600,soon,2021-01-05 09:10:00,1,A,40.1,-73.1,2,B,40.2,-73.2,9,s,\\N,1\n"
    )
    new = ",".join(schemas.BIKES_NEW.names)
    (citi / "202102-citibike-tripdata.csv").write_text(
        new + "\nr1,docked,2021-02-05 09:05:00,2021-02-05 09:30:00,A,SYS1,B,3.10,40.1,-73.1,40.2,-73.2,member\n"
    )
    (citi / "bike stations.csv").write_text(
        ",".join(schemas.STATIONS.names)
        + "\n1,A,40.1,-73.1,10,SYS1,40.1,-73.1\n2,B,40.2,-73.2,20,3.10,40.2,-73.2\n"
    )
    weather = root / "weather"
    weather.mkdir()
    (weather / "weather.csv").write_text(
        ",".join(schemas.WEATHER.names) + "\n2021-01-05,9,40,30,50,5,0,30,0,Fair\n"
    )
    return str(root), months


def test_whole_run(spark, raw, tmp_path):
    root, months = raw
    curated, out = str(tmp_path / "curated"), str(tmp_path / "out")
    lost = {}
    rows = process.clean_all(spark, root, curated, months, lost)
    assert {c: n for c, n in lost.items() if n} == {"starttime": 1, "birth year": 1}
    assert rows == {"yellow": 2, "green": 2, "fhvhv": 2, "citi": 2}
    taxis, bikes = process.curated_trips(spark, curated)
    assert taxis.count() == 6 and bikes.count() == 2
    assert taxis.columns == schemas.TRIP_COLUMNS

    rows = process.process_all(spark, root, curated, out)
    assert rows["outcomes"] == 2
    stored = process.stored_pairs(spark, root, out)
    january = spark.createDataFrame([(1,)], "month int")
    assert process.stored_pairs(spark, root, out, january).count() == 1
    assert modelling.stored_outcomes(spark, out).agg(F.sum("pairs")).first()[0] == 6
    merged = stored.orderBy("month").collect()
    # Three equal taxi trips meet one bike trip in both months; weather exists in January only.
    assert [(r["month"], int(r["pairs"]), r["trip_difference"]) for r in merged] == [
        (1, 3, 1200 - 600),
        (2, 3, 1200 - 1500),
    ]
    assert [r["Temperature"] for r in merged] == [40.0, None]
    assert [(r["count_taxis"], r["count_bikes"]) for r in merged] == [(3, 1), (3, 1)]
    assert compare.expand_pairs(stored).count() == 6

    rows = process.process_all(spark, root, curated, out, overall=True)
    assert rows == {"taxis": {"train": 6, "test": 0}, "bikes": {"train": 2, "test": 0}}
    modes = spark.read.parquet(f"{out}/taxis")
    assert modes.count() == 6 and {r["split"] for r in modes.collect()} == {"train"}
    assert "weather_pattern" in modes.columns and "pickup_datetime" not in modes.columns


def test_months_of_one_layout_are_one_scan(spark, tmp_path):
    """22 months of two layouts, among them one with its columns in another order."""
    months = feeds.expand_months()
    for year, month in months:
        at = datetime(year, month, 5, 9)
        code = "long" if year == 2020 else "double"
        frame = spark.createDataFrame(
            [(1, at, at, 1.0, 2.0, 1 if code == "long" else 1.0, 1, month, year)],
            "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double, "
            f"trip_distance double, RatecodeID {code}, payment_type long, PULocationID long, DOLocationID long",
        )
        if year == 2022:
            frame = frame.withColumn("airport_fee", F.lit(0.0))  # not used by cleaning
        frame.coalesce(1).write.parquet(str(tmp_path / "yellow" / f"yellow-{year}-{month:02d}.parquet"))
    trips = feeds.read_months(spark, str(tmp_path), "y", months)
    plan = trips._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    rows = trips.collect()
    assert len(rows) == 22
    assert all((r["PULocationID"], r["DOLocationID"]) == (r["file_month"], r["file_year"]) for r in rows)
    assert dict(trips.dtypes)["RatecodeID"] == "int"


def test_rejected_values(spark):
    schema = schemas.T.StructType.fromDDL("a int, b double, c string")
    text = spark.createDataFrame(
        [("1", "2.5", "x", "e"), ("one", None, "y", "e"), ("2", "much", None, "e"), ("", "1", "z", "e")],
        "a string, b string, c string, extra string",
    )
    found = {(r["column"], r["value"]) for r in feeds.rejected_values(text, schema).collect()}
    assert found == {("a", "one"), ("b", "much"), ("a", "")}
    from pyspark.sql import Observation

    lost = Observation()
    rows = feeds.typed(text, schema, lost).collect()
    assert [r["a"] for r in rows] == [1, None, 2, None] and lost.get == {"a": 2, "b": 1, "c": 0}


def test_literal_table(spark):
    table = feeds.literal_table(spark, [(1, "a"), (2, None)], "k int, v string")
    assert table.dtypes == [("k", "int"), ("v", "string")] and table.count() == 2
    with pytest.raises(Exception):
        feeds.literal_table(spark, [("x", "a")], "k int, v string").collect()


def _filed_trips(spark, *months):
    at = datetime(2021, 1, 5)
    rows = [(at, at, k, 2, year, month) for k, (year, month) in enumerate(months)]
    kinds = "pickup_datetime timestamp, dropoff_datetime timestamp, PULocationID int, DOLocationID int"
    return spark.createDataFrame(rows, f"{kinds}, file_year int, file_month int")


def test_a_run_that_dies_midway_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "curated")
    months = [(2021, 1), (2021, 2)]

    def shown():
        return {
            table: sorted((r["month"], r["PULocationID"]) for r in publish.read_months(spark, root, table).collect())
            for table in ("yellow", "citi")
        }

    first = publish.Release(spark, root)
    for table in ("yellow", "citi"):
        assert first.write_months(_filed_trips(spark, (2021, 1), (2021, 2), (2021, 2)), table, months) == 3
    with pytest.raises(ValueError):
        shown()  # nothing is there before it is published
    assert first.commit() == 1
    before = shown()
    assert before["citi"] == [(1, 0), (2, 1), (2, 2)]
    # One feed is rewritten, the next one fails: the old months of both stay.
    second = publish.Release(spark, root)
    second.write_months(_filed_trips(spark, (2021, 2)), "yellow", [(2021, 2)])
    with pytest.raises(Exception, match="not named"):
        second.write_months(_filed_trips(spark, (2021, 3)), "citi", [(2021, 2)])
    assert shown() == before
    # A later one empties a month of one feed and leaves the other feed alone.
    third = publish.Release(spark, root)
    third.write_months(_filed_trips(spark, (2021, 1)).limit(0), "citi", [(2021, 1)])
    assert third.commit() == 2
    assert shown() == {"yellow": before["yellow"], "citi": [(2, 1), (2, 2)]}
    assert len(publish.read_months(spark, root, "citi", version=1).collect()) == 3
    assert sorted(publish.delete_unused(spark, root)) == sorted([second.name, third.name])
    assert shown() == {"yellow": before["yellow"], "citi": [(2, 1), (2, 2)]}


def test_two_releases_at_once(spark, tmp_path):
    root = str(tmp_path / "curated")
    releases = [publish.Release(spark, root) for _ in range(2)]
    for k, release in enumerate(releases):
        release.write_months(_filed_trips(spark, (2021, k + 1)), "yellow", [(2021, k + 1)])
    # The second finds its number taken.
    known = publish._versions
    stale = iter([[], []])
    publish._versions = lambda spark, root: next(stale, None) or known(spark, root)
    try:
        assert [release.commit() for release in releases] == [1, 2]
    finally:
        publish._versions = known
    assert {r["month"] for r in publish.read_months(spark, root, "yellow").collect()} == {1, 2}
