"""From cleaned trips to the merged table or to one table per mode, and the whole run."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.calendar import with_calendar
from wayfare.functions.codes import peak_code, season_code
from wayfare.operators import compare, filters
from wayfare.operators.enrich import prepare_weather, weather_side, with_traffic, with_weather
from wayfare.operators.sampling import bernoulli_sample
from wayfare.plans import clean
from wayfare.sources import feeds, publish, sinks


def mode_trips(trips: DataFrame, weather: DataFrame, max_seconds: int = filters.MAX_SECONDS) -> DataFrame:
    """One mode's trips with calendar, codes, hour traffic and weather.

    Only the upper duration bound applies here; zero and negative durations stay. Weekday
    is a function of the counted hour, so filtering weekdays first leaves the counts as
    they are, and saves counting the weekends.
    """
    weekdays = filters.keep(with_calendar(trips), filters.weekday_rule())
    counted = with_traffic(weekdays, "count")
    kept = filters.keep(counted, filters.duration_rule("trip_duration", max_seconds, positive=False))
    coded = kept.withColumns(
        {"peak_hours": peak_code(F.col("time_bin")), "weather_pattern": season_code(F.col("day"))}
    )
    return with_weather(coded, weather.drop("Date")).drop("pickup_datetime", "dropoff_datetime")


def clean_all(
    spark: SparkSession, raw: str, curated: str, months=None, lost: dict[str, int] | None = None
) -> dict[str, int]:
    """Cleans every feed and publishes all of them by month below ``curated``; returns the rows per feed.

    Readers see the new months of all feeds at once, when the last one is written, or none of them.

    ``lost`` receives, per column, the values of the bike files that did not parse (see
    :func:`wayfare.sources.feeds.rejected_values`); rides without such a value are dropped.
    """
    months = months or feeds.expand_months()
    stations = feeds.read_feed(spark, raw, "b")
    zones = clean.bike_zones(stations)
    street = {"yellow": ("y", clean.clean_yellow), "green": ("g", clean.clean_green),
              "fhvhv": ("hv", clean.clean_for_hire)}
    release, rows = publish.Release(spark, curated), {}
    for name, (code, step) in street.items():
        trips = step(feeds.read_months(spark, raw, code, months), zones)
        rows[name] = release.write_months(trips, name, months)
    layouts = {
        "old": [m for m in months if m < feeds.NEW_BIKES_FROM],
        "new": [m for m in months if m >= feeds.NEW_BIKES_FROM],
    }
    counters: list = []
    cleaned = [
        clean.clean_bikes(feeds.read_months(spark, raw, "c", part, counters), stations, layout)
        for layout, part in layouts.items()
        if part
    ]
    rows["citi"] = release.write_months(feeds.union_feeds(cleaned), "citi", months)
    release.commit()
    if lost is not None:
        for counter in counters:
            for column, n in counter.get.items():
                lost[column] = lost.get(column, 0) + n
    return rows


def curated_trips(
    spark: SparkSession, curated: str, taxi_share: float = 1.0, bike_share: float = 1.0
) -> tuple[DataFrame, DataFrame]:
    """Taxis (all three feeds) and bikes, every month, whole unless a share is asked for."""

    def read(name: str, share: float) -> DataFrame:
        trips = feeds.trip_shape(publish.read_months(spark, curated, name))
        return trips if share >= 1 else bernoulli_sample(trips, share)

    taxis = feeds.union_feeds([read(n, taxi_share) for n in ("yellow", "green", "fhvhv")])
    return taxis, read("citi", bike_share)


def process_all(
    spark: SparkSession,
    raw: str,
    curated: str,
    out: str,
    overall: bool = False,
    taxi_share: float = 1.0,
    bike_share: float = 1.0,
) -> dict:
    """Writes the tables that pairing needs, or with ``overall`` one split table per mode; returns
    row counts.

    Pairs grow with the square of a busy key, so they are not stored: ``counts`` (trips per key and
    second of duration) and ``outcomes`` (what models of pairs need, one row per key) are, which
    grow with the trips. :func:`stored_pairs` builds pairs from them, for the keys asked for.
    """
    taxis, bikes = curated_trips(spark, curated, taxi_share, bike_share)
    if overall:
        weather = stored_weather(spark, raw)
        return {
            name: sinks.write_split(mode_trips(trips, weather), f"{out}/{name}")
            for name, trips in (("taxis", taxis), ("bikes", bikes))
        }
    counts = sinks.write_table(compare.duration_counts(taxis, bikes), f"{out}/counts")
    outcomes = compare.key_outcomes(spark.read.parquet(f"{out}/counts"))
    return {"counts": counts, "outcomes": sinks.write_table(outcomes, f"{out}/outcomes")}


def stored_weather(spark: SparkSession, raw: str) -> DataFrame:
    return weather_side(prepare_weather(feeds.read_feed(spark, raw, "w")))


def stored_pairs(spark: SparkSession, raw: str, out: str, keys: DataFrame | None = None) -> DataFrame:
    """The merged rows of a stored run, of all keys or of those in ``keys`` (some of the pair keys'
    columns, without repeats)."""
    counts = spark.read.parquet(f"{out}/counts")
    return compare.merged_counts(counts, stored_weather(spark, raw), keys)
