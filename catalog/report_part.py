"""Queries on reports, stations, statistics and models."""

from statistics import NormalDist

from pyspark.sql import functions as F

from catalog import inputs
from catalog.inputs import RIDES_SQL, ZONES_SQL, with_trips
from catalog.trips_part import _HOUR, _PAIRED, _mode_sql, _side, plain, query, study_mode
from wayfare.functions.calendar import HOUR_KEYS, with_calendar
from wayfare.models import cells, features, fits, statistics
from wayfare.operators import columns, compare, filters, reports, stations
from wayfare.operators.sides import materialise
from wayfare.plans import modelling
from wayfare.sources.schemas import WEATHER_MEASURES

# ---- reports ----


def kept_modes(spark, folder, study: bool = False):
    source = inputs.study_trips if study else inputs.trips
    rules = [filters.weekday_rule(), filters.duration_rule("trip_duration")]
    return tuple(
        filters.keep(with_calendar(m), *rules) for m in inputs.modes(source(spark, folder))
    )


@query(
    "hourly_profile",
    with_trips(
        """SELECT time_bin, CAST(sum(trip_duration) AS DOUBLE) / count(*) / 60 AS avg_minutes,
  CASE WHEN mode = 'taxis' THEN 1 ELSE 0 END AS hue FROM kept GROUP BY time_bin, mode"""
    ),
)
def hourly_profile(spark, folder):
    return reports.hourly_profiles(*kept_modes(spark, folder))


@query(
    "hourly_profile_merged",
    with_trips(
        f""", {_PAIRED} SELECT time_bin,
  CAST(sum(trip_duration_bikes) AS DOUBLE) / count(*) / 60 AS avg_minutes_bikes,
  CAST(sum(trip_duration_taxis) AS DOUBLE) / count(*) / 60 AS avg_minutes_taxis
FROM paired WHERE year <> 2022 GROUP BY 1""",
        study=True,
    ),
)
def hourly_profile_merged(spark, folder):
    sums = compare.key_sums(*inputs.modes(inputs.study_trips(spark, folder)))
    return reports.merged_hourly_profile(sums.filter("year <> 2022"))


@query(
    "daily_seasonality",
    with_trips(
        """SELECT day, count(*) AS count, round(ln(count(*)), 9) AS log_count
FROM bikes WHERE year = 2021 GROUP BY 1""",
        study=True,
    ),
)
def daily_seasonality(spark, folder):
    counts = reports.daily_counts(kept_modes(spark, folder, study=True)[1], 2021)
    return counts.withColumn("log_count", F.round("log_count", 9))


@query(
    "quiet_days",
    with_trips(
        """SELECT day, count(*) AS count FROM taxis WHERE year = 2021 GROUP BY 1 HAVING ln(count(*)) < 5.6""",
        study=True,
    ),
)
def quiet_days(spark, folder):
    """Days whose logarithmic count is below a bound."""
    counts = reports.daily_counts(kept_modes(spark, folder, study=True)[0], 2021)
    return filters.log_below(counts, "count", 5.6).select("day", "count")


@query(
    "daily_pairs",
    with_trips(
        f""", {_PAIRED} SELECT day, CAST(count(*) AS DOUBLE) AS pairs
FROM paired WHERE year <> 2022 GROUP BY 1""",
        study=True,
    ),
)
def daily_pairs(spark, folder):
    sums = compare.key_sums(*inputs.modes(inputs.study_trips(spark, folder)))
    return plain(reports.merged_daily_pairs(sums, 2022))


def _advantage_sql(low: int, high: int) -> str:
    def means(mode):
        return f"""SELECT DOLocationID AS DO_ID, CAST(sum(trip_duration) AS DOUBLE) / count(*) AS v FROM {mode}
  WHERE PULocationID = 239 AND time_bin >= {low} AND time_bin < {high} GROUP BY 1"""

    return f""", compared AS (
  SELECT t.DO_ID, t.v AS avg_time_for_taxis, b.v AS avg_time_for_bikes, t.v - b.v AS difference
  FROM ({means('taxis')}) t JOIN ({means('bikes')}) b ON t.DO_ID = b.DO_ID)
SELECT *, difference / (SELECT max(abs(difference)) FROM compared) AS scaled FROM compared"""


@query("od_advantage", with_trips(_advantage_sql(6, 9), study=True))
def od_advantage(spark, folder):
    return reports.od_advantage(*kept_modes(spark, folder, study=True), 6, 9)


@query(
    "od_advantage_evening",
    with_trips(
        _advantage_sql(18, 21).replace(
            "SELECT *, difference /", "SELECT DO_ID, difference /"
        )
        + " UNION ALL SELECT 239, 1.0",
        study=True,
    ),
)
def od_advantage_evening(spark, folder):
    """The evening band as the map's two columns, with the origin's constant row."""
    compared = reports.od_advantage(*kept_modes(spark, folder, study=True), 18, 21)
    return reports.with_origin_row(compared.select("DO_ID", "scaled"))


_ZONE_TABLE = """zone_table AS (
  SELECT CAST(n_nationkey + 230 AS INTEGER) AS LocationID, n_name AS name, r_name AS "Borough"
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _zone_table(spark, folder):
    nation = inputs.table(spark, folder, "nation").select(
        (F.col("n_nationkey") + 230).alias("LocationID"), F.col("n_name").alias("name"), "n_regionkey"
    )
    region = inputs.table(spark, folder, "region")
    shapes = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return shapes.select("LocationID", "name", F.col("r_name").alias("Borough"))


@query(
    "od_advantage_merged",
    with_trips(
        f""", {_PAIRED}, {_ZONE_TABLE}, compared AS (
  SELECT DOLocationID, LocationID, name, "Borough",
         CAST(sum(trip_difference) AS DOUBLE) / count(*) AS avg_difference
  FROM paired JOIN zone_table ON DOLocationID = LocationID
  WHERE PULocationID = 239 AND time_bin >= 7 AND time_bin < 10 GROUP BY ALL)
SELECT *, avg_difference / (SELECT max(abs(avg_difference)) FROM compared) AS scaled FROM compared""",
        study=True,
    ),
)
def od_advantage_merged(spark, folder):
    sums = compare.key_sums(*inputs.modes(inputs.study_trips(spark, folder)))
    return reports.merged_od_advantage(sums, _zone_table(spark, folder), 7, 10)


@query(
    "zone_attributes",
    f"WITH {_ZONE_TABLE} SELECT LocationID, name, \"Borough\" FROM zone_table WHERE \"Borough\" = 'ASIA'",
)
def zone_attributes(spark, folder):
    zones = _zone_table(spark, folder)
    return reports.zone_attributes(
        zones.select("LocationID", "Borough"), zones.select("LocationID", "name"), "ASIA"
    ).select("LocationID", "name", "Borough")


@query(
    "summary",
    with_trips(
        """SELECT count(*) AS count, CAST(sum(trip_duration) AS DOUBLE) / count(*) AS mean,
  round(stddev_samp(trip_duration), 6) AS stddev, min(trip_duration) AS min, max(trip_duration) AS max,
  quantile_disc(trip_duration, 0.25) AS q25, quantile_disc(trip_duration, 0.5) AS q50,
  quantile_disc(trip_duration, 0.75) AS q75 FROM taxis"""
    ),
)
def summary(spark, folder):
    taxis = kept_modes(spark, folder)[0]
    described = statistics.describe_counts(statistics.value_counts(taxis, "trip_duration"))
    return described.withColumn("stddev", F.round("stddev", 6))


@query(
    "distinct_dedup",
    """SELECT l_partkey, l_suppkey, l_shipdate FROM (
  SELECT l_partkey, l_suppkey, l_shipdate,
    row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_suppkey) AS place FROM lineitem)
WHERE place = 1""",
)
def distinct_dedup(spark, folder):
    items = inputs.table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
    return reports.first_per_key(items, ["l_partkey"], "l_shipdate", "l_suppkey")


@query(
    "distinct_values",
    """SELECT count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM lineitem""",
)
def distinct_values(spark, folder):
    return inputs.table(spark, folder, "lineitem").agg(
        F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct("l_partkey").alias("parts")
    )


@query(
    "sort_topk",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem "
    "ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey LIMIT 60 OFFSET 60",
)
def sort_topk(spark, folder):
    items = inputs.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_suppkey"
    )
    order = (F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_suppkey")
    return reports.first_rows(items, 60, *order, skip=60).drop("l_suppkey")


@query(
    "column_slice",
    "SELECT ts AS moment, user_id AS who, event_type AS kind, 'Event' AS hue FROM events",
)
def column_slice(spark, folder):
    """Columns by place, relabelled and tagged."""
    sliced = columns.by_place(inputs.table(spark, folder, "events"), 1, -2)
    return columns.tagged(columns.relabelled(sliced, ["moment", "who", "kind"]), "hue", "Event")


@query(
    "duration_variance",
    with_trips(
        """SELECT mode, year, count(*) AS rows, round(var_samp(trip_duration), 3) AS variance,
  round(stddev_samp(trip_duration), 6) AS naive_rmse FROM kept GROUP BY mode, year""",
        study=True,
    ),
)
def duration_variance(spark, folder):
    """Variance of single durations by mode and year; its root is the naive RMSE of a mean."""
    parts = zip(("taxis", "bikes"), kept_modes(spark, folder, study=True))
    tagged = [
        columns.tagged(trips.select("year", "trip_duration"), "mode", mode) for mode, trips in parts
    ]
    return (
        tagged[0]
        .unionByName(tagged[1])
        .groupBy("mode", "year")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.round(F.var_samp("trip_duration"), 3).alias("variance"),
            F.round(F.stddev_samp("trip_duration"), 6).alias("naive_rmse"),
        )
    )


# ---- stations ----


@query("station_dim", RIDES_SQL + "SELECT * FROM station_dim")
def station_dim(spark, folder):
    rides = inputs.rides(spark, folder)
    return stations.station_dimension(rides, inputs.RIDE_START, inputs.RIDE_END, "starttime")


_NAMED = """old AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 = 3 THEN 'Depot ' || s_nationkey ELSE s_name END AS name,
    s_acctbal AS latitude, CAST(s_nationkey AS DOUBLE) AS longtitude FROM supplier),
fresh AS (SELECT 'SYS' || s_suppkey AS new_id,
    CASE WHEN s_suppkey % 4 = 3 THEN 'Depot ' || s_nationkey WHEN s_suppkey % 7 = 0 THEN 'New ' || s_name ELSE s_name END AS name,
    s_acctbal + CASE WHEN s_suppkey % 14 = 0 THEN CAST(0.000002 AS DOUBLE) ELSE CAST(0.001 AS DOUBLE) END AS new_latitude,
    CAST(s_nationkey AS DOUBLE) AS new_longtitude FROM supplier),
named AS (SELECT old.*, m.new_id, m.new_latitude, m.new_longtitude FROM old LEFT JOIN (
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY new_id) AS place FROM fresh) m
    ON old.name = m.name AND m.place = 1)"""


def _old_and_new(spark, folder):
    """Suppliers as stations, some sharing a name; in the new list every seventh is renamed,
    half of those within the radius of the old place."""
    key = F.col("s_suppkey")
    shared = F.concat(F.lit("Depot "), F.col("s_nationkey").cast("string"))
    supplier = inputs.table(spark, folder, "supplier")
    lng = F.col("s_nationkey").cast("double")
    old = supplier.select(
        key.alias("id"),
        F.when(key % 4 == 3, shared).otherwise(F.col("s_name")).alias("name"),
        F.col("s_acctbal").alias("latitude"),
        lng.alias("longtitude"),
    )
    name = F.when(key % 4 == 3, shared).when(key % 7 == 0, F.concat(F.lit("New "), "s_name"))
    new = supplier.select(
        F.concat(F.lit("SYS"), key.cast("string")).alias("new_id"),
        name.otherwise(F.col("s_name")).alias("name"),
        (F.col("s_acctbal") + F.when(key % 14 == 0, 0.000002).otherwise(0.001)).alias("new_latitude"),
        lng.alias("new_longtitude"),
    )
    return old, new


@query("station_rename", f"WITH {_NAMED} SELECT * FROM named")
def station_rename(spark, folder):
    return stations.match_by_name(*_old_and_new(spark, folder))


@query(
    "match_stations",
    f"""WITH {_NAMED}, hits AS (
  SELECT n.id, f.new_id, f.new_latitude, f.new_longtitude,
    row_number() OVER (PARTITION BY n.id ORDER BY f.new_id) AS place
  FROM named n JOIN fresh f ON abs(n.latitude - f.new_latitude) < CAST(0.000005 AS DOUBLE)
    AND abs(n.longtitude - f.new_longtitude) < CAST(0.000005 AS DOUBLE) WHERE n.new_id IS NULL)
SELECT id, name, latitude, longtitude, new_id, new_latitude, new_longtitude FROM named WHERE new_id IS NOT NULL
UNION ALL SELECT n.id, name, latitude, longtitude, h.new_id, h.new_latitude, h.new_longtitude
FROM named n JOIN hits h ON n.id = h.id AND h.place = 1""",
)
def match_stations(spark, folder):
    return stations.match_stations(*_old_and_new(spark, folder))


def _planar(spark, folder, first: int):
    vector = F.col("embedding")
    return inputs.table(spark, folder, "embeddings").select(
        "vec_id",
        vector[first].cast("double").alias("x"),
        vector[first + 1].cast("double").alias("y"),
    )


@query(
    "near_match",
    """WITH seekers AS (SELECT CAST(embedding[1] AS DOUBLE) AS latitude, CAST(embedding[2] AS DOUBLE) AS longtitude
  FROM embeddings), places AS (SELECT 'SYS' || vec_id AS new_id, CAST(embedding[3] AS DOUBLE) AS new_latitude,
  CAST(embedding[4] AS DOUBLE) AS new_longtitude FROM embeddings)
SELECT * FROM (SELECT DISTINCT * FROM seekers) s JOIN places p
  ON abs(latitude - new_latitude) < CAST(0.02 AS DOUBLE) AND abs(longtitude - new_longtitude) < CAST(0.02 AS DOUBLE)
QUALIFY row_number() OVER (PARTITION BY latitude, longtitude ORDER BY new_id, new_latitude, new_longtitude) = 1""",
)
def near_match(spark, folder):
    left = _planar(spark, folder, 0).select(F.col("x").alias("latitude"), F.col("y").alias("longtitude"))
    right = _planar(spark, folder, 2).select(
        F.concat(F.lit("SYS"), F.col("vec_id").cast("string")).alias("new_id"),
        F.col("x").alias("new_latitude"),
        F.col("y").alias("new_longtitude"),
    )
    return stations.near_matches(left, right, radius=0.02)


@query(
    "point_in_zone",
    f"""WITH {ZONES_SQL}, points AS (
  SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 2 + CAST(0.8 AS DOUBLE) AS x,
         CAST(embedding[2] AS DOUBLE) * 2 + CAST(0.8 AS DOUBLE) AS y FROM embeddings)
SELECT vec_id, x, y, min(zone_id) AS zone_id
FROM points LEFT JOIN zones ON abs(x - cx) + abs(y - cy) < CAST(0.3125 AS DOUBLE) GROUP BY ALL""",
)
def point_in_zone(spark, folder):
    points = _planar(spark, folder, 0).select(
        "vec_id", (F.col("x") * 2 + 0.8).alias("x"), (F.col("y") * 2 + 0.8).alias("y")
    )
    return stations.with_zone(points, inputs.zone_rings(spark, folder), "x", "y", cell=0.1)


@query(
    "station_zones",
    RIDES_SQL
    + f""", {ZONES_SQL}
SELECT id, name, latitude, longtitude, min(zone_id) AS zone FROM station_dim
JOIN zones ON abs(longtitude - cx) + abs(latitude - cy) < CAST(0.3125 AS DOUBLE) GROUP BY ALL""",
)
def station_zones(spark, folder):
    zoned = stations.station_zones(
        inputs.rides(spark, folder),
        inputs.zone_rings(spark, folder),
        inputs.RIDE_START,
        inputs.RIDE_END,
        "starttime",
    )
    return zoned.withColumnRenamed("Taxi area code", "zone")


# ---- statistics ----

_POWER_SQL = ", ".join(
    f"corr(pow(trip_duration, CAST(0.2 AS DOUBLE)), pow(\"Temperature\", {i})) AS p{i + 5}" for i in range(-5, 5)
)


@query(
    "corr_sweep",
    with_trips(
        f""", joined AS (SELECT * FROM taxis JOIN weather USING ({_HOUR})), one AS (SELECT {_POWER_SQL} FROM joined) """
        + " UNION ALL ".join(
            f"SELECT {i} AS power, {'CAST(NULL AS DOUBLE)' if i == 0 else f'round(p{i + 5}, 6)'} AS correlation FROM one"
            for i in range(-5, 5)
        )
    ),
)
def corr_sweep(spark, folder):
    taxis = kept_modes(spark, folder)[0]
    joined = taxis.join(_side(inputs.weather(spark, folder)), HOUR_KEYS)
    swept = statistics.power_correlations(joined, "trip_duration", "Temperature")
    return swept.select("power", F.round("correlation", 6).alias("correlation"))


_MATRIX = ["trip_duration", "count", "time_bin", *WEATHER_MEASURES]


@query(
    "corr_matrix",
    with_trips(
        _mode_sql("bikes")
        + ', complete AS (SELECT * FROM processed WHERE "Temperature" IS NOT NULL) '
        + " UNION ALL ".join(
            f"""SELECT '{a}' AS a, '{b}' AS b, round(corr("{a}", "{b}"), 6) AS correlation FROM complete"""
            for a in _MATRIX
            for b in _MATRIX
        ),
        study=True,
    ),
)
def corr_matrix(spark, folder):
    matrix = statistics.correlation_matrix(study_mode(spark, folder, "bikes"), _MATRIX)
    return matrix.withColumn("correlation", F.round("correlation", 6))


_LAMBDAS = [round(-1 + 0.05 * i, 2) for i in range(41)]


@query(
    "boxcox_profile",
    with_trips(
        f""", grid AS (SELECT unnest([{', '.join(f'CAST({g} AS DOUBLE)' for g in _LAMBDAS)}]) AS lam),
y AS (SELECT lam, ln(trip_duration) AS lx, CASE WHEN lam = 0 THEN ln(trip_duration)
      ELSE (pow(trip_duration, lam) - 1) / lam END AS v FROM taxis, grid)
SELECT lam AS "lambda", round((lam - 1) * sum(lx) - count(*) / CAST(2 AS DOUBLE) * ln(var_pop(v)), 3) AS llf FROM y GROUP BY lam"""
    ),
)
def boxcox_profile(spark, folder):
    counts = statistics.value_counts(kept_modes(spark, folder)[0], "trip_duration")
    return statistics.boxcox_profile(counts, _LAMBDAS).select("lambda", F.round("llf", 3).alias("llf"))


def _refine(before: str, name: str, low: str, step: str) -> str:
    """One grid of 81 lambdas from ``low`` in steps, and the best of them."""
    return f"""{name}_grid AS (SELECT round({low} + i * CAST({step} AS DOUBLE), 10) AS lam
    FROM generate_series(0, 80) AS g(i){before}),
{name}_y AS (SELECT lam, v AS x, n, CASE WHEN lam = 0 THEN ln(v) ELSE (pow(v, lam) - 1) / lam END AS y
    FROM counted, {name}_grid),
{name} AS (SELECT lam, (lam - 1) * sum(n * ln(x)) - sum(n) / CAST(2 AS DOUBLE)
    * ln(sum(n * y * y) / sum(n) - pow(sum(n * y) / sum(n), 2)) AS llf FROM {name}_y GROUP BY lam
    ORDER BY llf DESC, lam LIMIT 1)"""


@query(
    "boxcox_lambda",
    with_trips(
        ", counted AS (SELECT CAST(trip_duration AS DOUBLE) AS v, count(*) AS n FROM taxis GROUP BY 1), "
        + ", ".join(
            [
                _refine("", "coarse", "CAST(-2 AS DOUBLE)", "0.05"),
                _refine(", coarse", "middle", "coarse.lam - CAST(0.05 AS DOUBLE)", "0.00125"),
                _refine(", middle", "fine", "middle.lam - CAST(0.00125 AS DOUBLE)", "0.00003125"),
            ]
        )
        + ' SELECT round(lam, 3) AS "lambda", round(llf, 3) AS llf FROM fine'
    ),
)
def boxcox_lambda(spark, folder):
    counts = statistics.value_counts(kept_modes(spark, folder)[0], "trip_duration")
    best = statistics.boxcox_lambda(counts)
    return best.select(F.round("lambda", 3).alias("lambda"), F.round("llf", 3).alias("llf"))


_NORMAL = ", ".join(
    f"(CAST({i / 100!r} AS DOUBLE), CAST({round(NormalDist().inv_cdf(i / 100), 9)!r} AS DOUBLE))" for i in range(1, 100)
)


@query(
    "quantile_table",
    with_trips(
        f""", ranked AS (SELECT trip_duration, row_number() OVER (ORDER BY trip_duration) AS place,
  count(*) OVER () AS n FROM taxis), normal(share, q) AS (VALUES {_NORMAL})
SELECT share, q AS normal_quantile, round(pow(min(trip_duration), CAST(0.2 AS DOUBLE)), 9) AS sample_quantile
FROM normal JOIN ranked ON place >= ceil(share * n) GROUP BY ALL"""
    ),
)
def quantile_table(spark, folder):
    counts = statistics.value_counts(kept_modes(spark, folder)[0], "trip_duration")
    rows = statistics.normal_quantile_table(counts, 0.2)
    return rows.select(
        "share",
        F.round("normal_quantile", 9).alias("normal_quantile"),
        F.round("sample_quantile", 9).alias("sample_quantile"),
    )


@query("pca_weather")
def pca_weather(spark, folder):
    """Mean component scores by hour of day (the rows keep their own scores in the library)."""
    scored, _ = statistics.with_components(study_mode(spark, folder, "bikes"), WEATHER_MEASURES[:6])
    return scored.groupBy("time_bin").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("pca_a").alias("pca_a"), F.avg("pca_b").alias("pca_b")
    )


@query(
    "pca_two_measures",
    with_trips(
        _mode_sql("bikes")
        + """, used AS (SELECT time_bin, "Temperature" AS a, "Wind Speed" AS b FROM processed
  WHERE "Temperature" IS NOT NULL AND "Wind Speed" IS NOT NULL),
m AS (SELECT avg(a) AS ma, avg(b) AS mb, covar_pop(a, a) AS aa, covar_pop(a, b) AS ab, covar_pop(b, b) AS bb FROM used),
l AS (SELECT *, (aa + bb) / 2 + sqrt(pow((aa - bb) / 2, 2) + ab * ab) AS big FROM m),
v AS (SELECT *, ab / sqrt(ab * ab + pow(big - aa, 2)) AS va, (big - aa) / sqrt(ab * ab + pow(big - aa, 2)) AS vb FROM l),
d AS (SELECT *, CASE WHEN CASE WHEN abs(va) >= abs(vb) THEN va ELSE vb END < 0 THEN -1 ELSE 1 END AS turn,
  CASE WHEN CASE WHEN abs(vb) >= abs(va) THEN -vb ELSE va END < 0 THEN -1 ELSE 1 END AS other FROM v)
SELECT time_bin, count(*) AS rows, round(avg(((a - ma) * va + (b - mb) * vb) * turn), 6) AS pca_a,
  round(avg((-(a - ma) * vb + (b - mb) * va) * other), 6) AS pca_b,
  round(any_value(big / (aa + bb)), 9) AS explained FROM used, d GROUP BY time_bin""",
        study=True,
    ),
)
def pca_two_measures(spark, folder):
    """Components of two measures, for which SQL has a closed form."""
    scored, found = statistics.with_components(
        study_mode(spark, folder, "bikes"), ["Temperature", "Wind Speed"]
    )
    return scored.groupBy("time_bin").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg("pca_a"), 6).alias("pca_a"),
        F.round(F.avg("pca_b"), 6).alias("pca_b"),
        F.lit(round(float(found.explained[0]), 9)).alias("explained"),
    )


def _reduced(spark, folder):
    trips = study_mode(spark, folder, "bikes").filter("trip_duration > 0").na.drop()
    return trips.withColumn("reduced", F.pow("trip_duration", F.lit(0.2)))


@query(
    "anova_one_term",
    with_trips(
        _mode_sql("bikes")
        + """, used AS (SELECT pow(trip_duration, CAST(0.2 AS DOUBLE)) AS y, "Temperature" AS x FROM processed
  WHERE "Temperature" IS NOT NULL AND trip_duration > 0),
m AS (SELECT count(*) AS n, regr_sxy(y, x) AS sxy, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy FROM used)
SELECT 'Temperature' AS term, round(sxy * sxy / sxx, 6) AS sum_sq, CAST(1 AS DOUBLE) AS df,
       round((sxy * sxy / sxx) / ((syy - sxy * sxy / sxx) / (n - 2)), 4) AS f FROM m
UNION ALL SELECT 'Residual', round(syy - sxy * sxy / sxx, 6), CAST(n - 2 AS DOUBLE), NULL FROM m""",
        study=True,
    ),
)
def anova_one_term(spark, folder):
    table = cells.label_cells(_reduced(spark, folder), "reduced", ["Temperature"])
    return statistics.anova_type2(table, ["Temperature"]).select(
        "term", F.round("sum_sq", 6).alias("sum_sq"), "df", F.round("f", 4).alias("f")
    )


_TWO_TERMS = ["Temperature", "Precipitation"]


@query(
    "anova_two_terms",
    with_trips(
        _mode_sql("bikes")
        + """, used AS (SELECT pow(trip_duration, CAST(0.2 AS DOUBLE)) AS y, "Temperature" AS a, "Precipitation" AS b
  FROM processed WHERE "Temperature" IS NOT NULL AND trip_duration > 0),
m AS (SELECT count(*) AS n, regr_sxx(a, a) AS aa, regr_sxx(b, b) AS bb, regr_sxy(a, b) AS ab,
  regr_sxy(y, a) AS ya, regr_sxy(y, b) AS yb, regr_syy(y, a) AS yy FROM used),
e AS (SELECT n, yy - (ya * ya * bb - 2 * ya * yb * ab + yb * yb * aa) / (aa * bb - ab * ab) AS sse,
  yy - ya * ya / aa AS only_a, yy - yb * yb / bb AS only_b FROM m)
SELECT 'Temperature' AS term, round(only_b - sse, 6) AS sum_sq, CAST(1 AS DOUBLE) AS df,
  round((only_b - sse) / (sse / (n - 3)), 4) AS f FROM e
UNION ALL SELECT 'Precipitation', round(only_a - sse, 6), 1, round((only_a - sse) / (sse / (n - 3)), 4) FROM e
UNION ALL SELECT 'Residual', round(sse, 6), n - 3, NULL FROM e""",
        study=True,
    ),
)
def anova_two_terms(spark, folder):
    table = cells.label_cells(_reduced(spark, folder), "reduced", _TWO_TERMS)
    return statistics.anova_type2(table, _TWO_TERMS).select(
        "term", F.round("sum_sq", 6).alias("sum_sq"), "df", F.round("f", 4).alias("f")
    )


_GROUPED = """, used AS (SELECT ln(count) AS x, month AS g, pow(trip_duration, CAST(0.2 AS DOUBLE)) AS y
  FROM processed WHERE "Temperature" IS NOT NULL AND trip_duration > 0),
m AS (SELECT count(*) AS n, count(DISTINCT g) AS k, regr_sxx(x, x) AS xx, regr_sxy(y, x) AS xy, regr_syy(y, x) AS yy FROM used),
each AS (SELECT g, regr_sxx(x, x) AS xx, regr_sxy(y, x) AS xy, regr_syy(y, x) AS yy FROM used GROUP BY g),
w AS (SELECT sum(xx) AS wxx, sum(xy) AS wxy, sum(yy) AS wyy FROM each) """


@query(
    "anova_category",
    with_trips(
        _mode_sql("bikes")
        + _GROUPED
        + """SELECT 'month' AS term, round(yy - wyy, 6) AS sum_sq, CAST(k - 1 AS DOUBLE) AS df,
  round(((yy - wyy) / (k - 1)) / (wyy / (n - k)), 4) AS f FROM m, w
UNION ALL SELECT 'Residual', round(wyy, 6), n - k, NULL FROM m, w""",
        study=True,
    ),
)
def anova_category(spark, folder):
    table = cells.label_cells(_reduced(spark, folder), "reduced", ["month"])
    return statistics.anova_type2(table, [], ["month"]).select(
        "term", F.round("sum_sq", 6).alias("sum_sq"), "df", F.round("f", 4).alias("f")
    )


@query(
    "anova_mixed",
    with_trips(
        _mode_sql("bikes")
        + _GROUPED
        + """, e AS (SELECT *, wyy - wxy * wxy / wxx AS sse, yy - xy * xy / xx AS line FROM m, w)
SELECT 'log_count' AS term, round(wyy - sse, 6) AS sum_sq, CAST(1 AS DOUBLE) AS df,
  round((wyy - sse) / (sse / (n - k - 1)), 4) AS f FROM e
UNION ALL SELECT 'month', round(line - sse, 6), k - 1, round(((line - sse) / (k - 1)) / (sse / (n - k - 1)), 4) FROM e
UNION ALL SELECT 'Residual', round(sse, 6), n - k - 1, NULL FROM e""",
        study=True,
    ),
)
def anova_mixed(spark, folder):
    """A number, the logarithm of the hour's trips, beside a category."""
    trips = _reduced(spark, folder).withColumn("log_count", F.log("count"))
    table = cells.label_cells(trips, "reduced", ["log_count", "month"])
    return statistics.anova_type2(table, ["log_count"], ["month"]).select(
        "term", F.round("sum_sq", 6).alias("sum_sq"), "df", F.round("f", 4).alias("f")
    )


@query("anova_type2")
def anova_type2(spark, folder):
    numeric, categorical = [*WEATHER_MEASURES, "count"], ["PULocationID", "DOLocationID", "day_of_week", "month"]
    table = cells.label_cells(_reduced(spark, folder), "reduced", numeric + categorical)
    return statistics.anova_type2(table, numeric, categorical)


@query("anova_study_bikes")
def anova_study_bikes(spark, folder):
    """All of the study's significance models of one mode."""
    return modelling.study_anovas(study_mode(spark, folder, "bikes"), modelling.BIKE_ANOVAS)


@query("anova_study_taxis")
def anova_study_taxis(spark, folder):
    return modelling.study_anovas(study_mode(spark, folder, "taxis"), modelling.TAXI_ANOVAS)


# ---- models ----



def paired_outcomes(spark, folder):
    """Outcomes per key of the study's trips, and the hours' weather."""
    outcomes = modelling.coded_outcomes(*inputs.modes(inputs.study_trips(spark, folder)))
    return outcomes, _side(inputs.study_weather(spark, folder))


_LEVELS = f""", {_PAIRED}, used AS (SELECT month, time_bin, PULocationID, DOLocationID, day_of_week,
  CASE WHEN day < 60 OR day >= 330 THEN 0 WHEN day >= 150 AND day < 240 THEN 1 ELSE 2 END AS weather_pattern,
  CASE WHEN (time_bin >= 8 AND time_bin < 11) OR (time_bin >= 16 AND time_bin < 19) THEN 1 ELSE 0 END AS peak_hours,
  year = 2020 OR (year = 2021 AND month <= 8) AS train, weather.* EXCLUDE (year, month, day, time_bin)
  FROM paired JOIN weather USING ({_HOUR})),
long AS (SELECT category, CAST(value AS VARCHAR) AS value, train FROM used UNPIVOT (value FOR category IN
  (month, time_bin, PULocationID, DOLocationID, day_of_week, weather_pattern))),
levels AS (SELECT category, value, CAST(count(*) FILTER (train) AS DOUBLE) AS weight FROM long GROUP BY ALL),
indexed AS (SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY weight DESC, value) - 1 AS INTEGER) AS index,
  count(*) OVER (PARTITION BY category) AS n FROM levels)
"""


@query(
    "encode",
    with_trips(
        _LEVELS
        + "SELECT category, value, weight, index, CASE WHEN index < n - 1 THEN index END AS slot FROM indexed",
        study=True,
    ),
)
def encode(spark, folder):
    """Category levels in index order, and the one-hot slot of each."""
    table = modelling.difference_table(*paired_outcomes(spark, folder))
    return features.index_levels(cells.category_levels(table, cells.CATEGORIES, modelling.TRAIN))


_PLACES = ", ".join(f"({i}, '{c}')" for i, c in enumerate(cells.CATEGORIES))


@query(
    "feature_totals",
    with_trips(
        f"""{_LEVELS}, sizes AS (SELECT p.place, p.category, max(n) - 1 AS size
    FROM (VALUES {_PLACES}) p(place, category) JOIN indexed USING (category) GROUP BY ALL),
starts AS (SELECT category, coalesce(sum(size) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS start FROM sizes), width AS (SELECT sum(size) AS w FROM sizes)
SELECT CAST(start + index AS INTEGER) AS slot, CAST(count(*) AS DOUBLE) AS total FROM long
  JOIN indexed USING (category, value) JOIN starts USING (category) WHERE index < n - 1 GROUP BY 1
UNION ALL SELECT CAST(w AS INTEGER), CAST((SELECT sum(peak_hours) FROM used) AS DOUBLE) FROM width
"""
        + "".join(
            f"""UNION ALL SELECT CAST(w + {i} AS INTEGER), round((SELECT coalesce(sum("{m}")
  / nullif(stddev_samp("{m}") FILTER (train), 0), 0) FROM used), 5) FROM width """
            for i, m in enumerate(WEATHER_MEASURES, start=1)
        ),
        study=True,
    ),
)
def feature_totals(spark, folder):
    """The assembled feature vectors added up over all pairs, slot by slot."""
    encoded = encode_features(spark, folder).select("weight", F.posexplode("features").alias("slot", "v"))
    total = F.round(F.sum(F.col("v") * F.col("weight")), 5)
    return encoded.groupBy("slot").agg(total.alias("total"))


@query("encode_features")
def encode_features(spark, folder):
    from pyspark.ml.functions import vector_to_array

    encoded = modelling.encoded(modelling.difference_table(*paired_outcomes(spark, folder)))
    return encoded.select(*compare.PAIR_KEYS, "label", "weight", vector_to_array("features").alias("features"))


@query(
    "class_totals",
    with_trips(
        f"""{_LEVELS.rstrip()}, classed AS (SELECT CASE WHEN year = 2022 THEN 'test' WHEN year = 2021 AND month > 8
    THEN 'validation' WHEN year = 2020 OR year = 2021 THEN 'train' END AS split,
  CAST(CASE WHEN trip_difference > 0 THEN 1 ELSE 0 END AS DOUBLE) AS label FROM paired JOIN weather USING ({_HOUR}))
SELECT split, label, CAST(count(*) AS DOUBLE) AS rows FROM classed GROUP BY ALL""",
        study=True,
    ),
)
def class_totals(spark, folder):
    """The pairs of each class and split that the classifier is fitted on and judged by."""
    return cells.class_totals(modelling.class_table(*paired_outcomes(spark, folder)), "split")


@query("mlp_eval")
def mlp_eval(spark, folder):
    scored = modelling.scored_classes(*paired_outcomes(spark, folder)).filter("split IS NOT NULL")
    return fits.class_metrics(fits.confusion(scored, "split"), "split")


@query("confusion")
def confusion(spark, folder):
    scored = modelling.scored_classes(*paired_outcomes(spark, folder))
    return fits.confusion(scored.filter("split = 'test'"))


@query("gbt_eval")
def gbt_eval(spark, folder):
    scored = modelling.scored_differences(*paired_outcomes(spark, folder)).filter("split IS NOT NULL")
    return fits.regression_metrics(scored, "split")


@query("error_by_weekday")
def error_by_weekday(spark, folder):
    scored = modelling.scored_differences(*paired_outcomes(spark, folder))
    return fits.error_by_weekday(scored.filter("split = 'test'"))


@query("glm_eval")
def glm_eval(spark, folder):
    scored = modelling.scored_durations(study_mode(spark, folder, "taxis"))
    return fits.regression_metrics(scored.filter("split IS NOT NULL"), "split")


@query(
    "glm_terms",
    with_trips(
        _mode_sql("taxis")
        + """, groups AS (SELECT peak_hours AS p, avg(trip_duration) AS m FROM processed
  WHERE trip_duration > 0 GROUP BY 1)
SELECT 'peak_hours' AS term, round(ln((SELECT m FROM groups WHERE p = 1) / (SELECT m FROM groups WHERE p = 0)), 4)
  AS coefficient
UNION ALL SELECT '(intercept)', round(ln((SELECT m FROM groups WHERE p = 0)), 4)""",
        study=True,
    ),
)
def glm_terms(spark, folder):
    """A log-linear model on one yes-or-no feature, unpenalised: its predictions are group means."""
    from pyspark.ml.feature import VectorAssembler

    trips = study_mode(spark, folder, "taxis").filter("trip_duration > 0")
    table = cells.label_cells(trips.select("peak_hours", "trip_duration"), "trip_duration", ["peak_hours"])
    ready = VectorAssembler(inputCols=["peak_hours"], outputCol="features").transform(materialise(table))
    summary = fits.glm_summary(fits.fit_log_linear(ready, penalty=0.0), ["peak_hours"])
    return summary.filter("term IN ('peak_hours', '(intercept)')").select(
        "term", F.round("coefficient", 4).alias("coefficient")
    )


_SUMMED = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _quartile_sql(column: str, share: float) -> str:
    return (
        f"(SELECT min(v) FROM (SELECT CAST({column} AS DOUBLE) AS v, row_number() OVER (ORDER BY {column}) AS place, "
        f"count(*) OVER () AS n FROM lineitem WHERE {column} IS NOT NULL) WHERE place >= ceil({share} * n))"
    )


@query(
    "quality_summary",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg(CAST({c} AS DOUBLE)), 6) AS mean, "
        f"round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
        f"CAST(max({c}) AS DOUBLE) AS max, {_quartile_sql(c, 0.25)} AS q25, {_quartile_sql(c, 0.5)} AS q50, "
        f"{_quartile_sql(c, 0.75)} AS q75 FROM lineitem"
        for c in _SUMMED
    ),
)
def quality_summary(spark, folder):
    """The summary part of the quality report of a raw table."""
    raw = spark.read.parquet(f"{folder}/lineitem.parquet").select(*_SUMMED, "l_returnflag")
    _, _, summary = reports.quality_report(raw, [filters.passenger_rule("l_quantity")])
    return summary.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


# ---- evaluation of a fixed rule, which SQL can follow ----

_RULED = f""", {_PAIRED}, ruled AS (
  SELECT month, day_of_week, trip_difference AS d, CASE WHEN trip_difference > 0 THEN 1 ELSE 0 END AS label,
    CASE WHEN (time_bin >= 8 AND time_bin < 11) OR (time_bin >= 16 AND time_bin < 19) THEN 1 ELSE 0 END AS peak,
    CASE WHEN year = 2022 THEN 'test' WHEN year = 2021 AND month > 8 THEN 'validation' ELSE 'train' END AS split
  FROM paired JOIN weather USING ({_HOUR})), """


def _ruled_classes(spark, folder):
    table = modelling.class_table(*paired_outcomes(spark, folder))
    return table.withColumn("prediction", F.col("peak_hours").cast("double"))


def _ruled_differences(spark, folder):
    table = modelling.difference_table(*paired_outcomes(spark, folder))
    return table.withColumn("prediction", F.col("peak_hours") * 100.0)


_CONFUSION = """confusion AS (SELECT split, label, CAST(count(*) FILTER (peak = 0) AS DOUBLE) AS predicted_0,
  CAST(count(*) FILTER (peak = 1) AS DOUBLE) AS predicted_1 FROM ruled GROUP BY ALL)"""


@query("confusion_of_rule", with_trips(f"{_RULED} {_CONFUSION} SELECT * FROM confusion", study=True))
def confusion_of_rule(spark, folder):
    """Peak hour taken as the forecast that the taxi is slower: counts over all pairs."""
    return fits.confusion(_ruled_classes(spark, folder), "split")


@query(
    "metrics_of_rule",
    with_trips(
        f"""{_RULED} {_CONFUSION}, n AS (SELECT split,
    sum(CASE WHEN label = 0 THEN predicted_0 ELSE 0 END) AS tn, sum(CASE WHEN label = 0 THEN predicted_1 ELSE 0 END) AS fp,
    sum(CASE WHEN label = 1 THEN predicted_0 ELSE 0 END) AS fn, sum(CASE WHEN label = 1 THEN predicted_1 ELSE 0 END) AS tp
  FROM confusion GROUP BY 1)
SELECT split, round((coalesce(tn / nullif(tn + fn, 0), 0) * (tn + fp) + coalesce(tp / nullif(tp + fp, 0), 0) * (fn + tp))
    / (tn + fp + fn + tp), 9) AS weighted_precision,
  round((tn + tp) / (tn + fp + fn + tp), 9) AS weighted_recall, round((tn + tp) / (tn + fp + fn + tp), 9) AS accuracy
FROM n""",
        study=True,
    ),
)
def metrics_of_rule(spark, folder):
    metrics = fits.class_metrics(confusion_of_rule(spark, folder), "split")
    return metrics.select(
        "split", *[F.round(c, 9).alias(c) for c in ("weighted_precision", "weighted_recall", "accuracy")]
    )


@query(
    "regression_of_rule",
    with_trips(
        f"""{_RULED} m AS (SELECT split, avg(d) AS mean FROM ruled GROUP BY 1)
SELECT split, CAST(count(*) AS DOUBLE) AS rows, round(sqrt(avg(pow(d - peak * 100, 2))), 6) AS rmse,
  round(1 - sum(pow(d - peak * 100, 2)) / nullif(sum(pow(d - mean, 2)), 0), 6) AS r2, round(stddev_samp(d), 6) AS naive_rmse
FROM ruled JOIN m USING (split) GROUP BY split""",
        study=True,
    ),
)
def regression_of_rule(spark, folder):
    metrics = fits.regression_metrics(_ruled_differences(spark, folder), "split")
    return metrics.select("split", "rows", *[F.round(c, 6).alias(c) for c in ("rmse", "r2", "naive_rmse")])


@query(
    "weekday_errors_of_rule",
    with_trips(
        f"""{_RULED} means AS (SELECT month, day_of_week, avg(peak * 100) AS p, avg(d) AS a FROM ruled
  WHERE split = 'test' GROUP BY ALL), named AS (SELECT *, CASE day_of_week WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday'
    WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' ELSE 'Friday' END AS days FROM means)
SELECT month, days, 'Prediction' AS hue, round(abs(p), 6) AS avg FROM named
UNION ALL SELECT month, days, 'Actual', round(abs(a), 6) FROM named""",
        study=True,
    ),
)
def weekday_errors_of_rule(spark, folder):
    scored = _ruled_differences(spark, folder).filter("split = 'test'")
    return fits.error_by_weekday(scored).withColumn("avg", F.round("avg", 6))


@query(
    "scale_weather",
    with_trips(
        f", {_PAIRED}, train AS (SELECT * FROM paired JOIN weather USING ({_HOUR}) WHERE year = 2020 OR (year = 2021 AND month <= 8)) "
        + " UNION ALL ".join(
            f"""SELECT '{m}' AS measure, round(stddev_samp("{m}"), 6) AS deviation FROM train""" for m in WEATHER_MEASURES
        ),
        study=True,
    ),
)
def scale_weather(spark, folder):
    """The deviations by which training divides the weather, over the training pairs."""
    table = materialise(modelling.difference_table(*paired_outcomes(spark, folder))).filter(modelling.TRAIN)
    scales = cells.weighted_scales(table, WEATHER_MEASURES)
    rows = [(name, deviation) for name, (_, deviation) in scales.items()]
    fitted = spark.createDataFrame(rows, "measure string, deviation double")
    return fitted.withColumn("deviation", F.round("deviation", 6))
