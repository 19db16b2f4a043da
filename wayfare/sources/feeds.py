"""The trip feeds: where their months lie and how their columns map to the common shape."""

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.sources import schemas

# The study's month ranges (first month, last month, year), and the first
# month of the bikes' new layout.
STUDY_RANGES = ((7, 12, 2020), (1, 12, 2021), (1, 4, 2022))
NEW_BIKES_FROM = (2021, 2)


@dataclass(frozen=True)
class Feed:
    """``columns`` maps the feed's own names to common names; ``kinds`` gives cast targets."""

    path: str
    schema: T.StructType | None = None
    columns: dict[str, str] = field(default_factory=dict)
    kinds: dict[str, str] = field(default_factory=dict)

    @property
    def is_parquet(self) -> bool:
        return self.schema is None


_TAXI_KINDS = {
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "trip_distance": "double",
    "passenger_count": "double",
    "PULocationID": "int",
    "DOLocationID": "int",
    "VendorID": "int",
    "payment_type": "int",
    "RatecodeID": "int",
    "trip_type": "int",
    "shared_match_flag": "string",
    "wav_match_flag": "string",
}

# Feed codes, file locations and column names of the published feeds.
FEEDS = {
    "y": Feed(
        "yellow/yellow-{year}-{month:02d}.parquet",
        columns={
            "tpep_pickup_datetime": "pickup_datetime",
            "tpep_dropoff_datetime": "dropoff_datetime",
        },
        kinds=_TAXI_KINDS,
    ),
    "g": Feed(
        "green/green-{year}-{month:02d}.parquet",
        columns={
            "lpep_pickup_datetime": "pickup_datetime",
            "lpep_dropoff_datetime": "dropoff_datetime",
        },
        kinds=_TAXI_KINDS,
    ),
    "hv": Feed(
        "fhvhv/fhvhv-{year}-{month:02d}.parquet",
        columns={"trip_miles": "trip_distance"},
        kinds=_TAXI_KINDS,
    ),
    "c": Feed("citi/{year}{month:02d}-citibike-tripdata.csv", schemas.BIKES_NEW),
    "w": Feed("weather/weather.csv", schemas.WEATHER),
    "b": Feed("citi/bike stations.csv", schemas.STATIONS),
}


def feed(code: str) -> Feed:
    if code not in FEEDS:
        raise ValueError(f"unknown feed {code!r}; known: {sorted(FEEDS)}")
    return FEEDS[code]


def expand_months(ranges: Iterable[tuple[int, int, int]] = STUDY_RANGES) -> list[tuple[int, int]]:
    """(year, month) pairs of all ranges, in order."""
    return [(year, m) for first, last, year in ranges for m in range(first, last + 1)]


def month_table(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per month from ``first`` to ``last`` (dates as text)."""
    months = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))
    return (
        spark.range(1)
        .select(F.explode(months).alias("first_day"))
        .select("first_day", F.year("first_day").alias("year"), F.month("first_day").alias("month"))
    )


def bike_schema(year: int, month: int) -> T.StructType:
    return schemas.BIKES_NEW if (year, month) >= NEW_BIKES_FROM else schemas.BIKES_OLD


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    lost: Observation | None = None,
) -> DataFrame:
    """A CSV with a header; without a schema every column is text. Files of one call have one header.

    Columns are taken by name, so their order in the file does not matter, extra ones are
    ignored and a missing one is an error. Values that do not parse become null; ``lost`` then counts
    them per column during the scan, and :func:`rejected_values` lists them.
    """
    text = spark.read.option("header", True).csv(path)
    return text if schema is None else typed(text, schema, lost)


def _parsed(field: T.StructField):
    return F.col(f"`{field.name}`").try_cast(field.dataType)


def _broken(field: T.StructField):
    """There is a text, and it is no value of the field's type."""
    return F.col(f"`{field.name}`").isNotNull() & _parsed(field).isNull()


def typed(text: DataFrame, schema: T.StructType, lost: Observation | None = None) -> DataFrame:
    """Columns of text as the schema's types, and columns it does not name dropped."""
    if lost is not None:
        counters = [F.count_if(_broken(f)).alias(f.name) for f in schema]
        text = text.observe(lost, *counters)
    return text.select(*[_parsed(f).alias(f.name) for f in schema])


def rejected_values(text: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per value of a table of text that is no value of its column's type: the row as JSON,
    ``column`` and ``value``. Nothing else of the table is kept."""
    cells = F.array(
        *[
            F.when(_broken(f), F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("value")))
            for f in schema
        ]
    )
    row = F.to_json(F.struct(*[f"`{c}`" for c in text.columns]))
    found = text.select(row.alias("row"), F.explode(F.array_compact(cells)).alias("cell"))
    return found.select("row", "cell.column", "cell.value")


def literal_table(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """A small table written out in code, under a declared schema: a value of another type is an error."""
    return spark.createDataFrame(list(rows), schema)


def harmonise(trips: DataFrame, source: Feed) -> DataFrame:
    """Common names and types; columns the mapping does not mention pass through."""
    renamed = trips.withColumnsRenamed(source.columns)
    present = {c.lower(): c for c in renamed.columns}
    casts = {
        name: F.col(present[name.lower()]).cast(kind)
        for name, kind in source.kinds.items()
        if name.lower() in present
    }
    names = {present[name.lower()]: name for name in casts}
    return renamed.withColumnsRenamed(names).withColumns(
        {name: F.col(name).cast(kind) for name, kind in source.kinds.items() if name in casts}
    )


def read_feed(spark: SparkSession, root: str, code: str, year: int = 0, month: int = 0) -> DataFrame:
    """One month of a feed (or the whole file of a feed that has no months)."""
    source = feed(code)
    path = f"{root}/" + source.path.format(year=year, month=month)
    if source.is_parquet:
        return harmonise(spark.read.parquet(path), source)
    return read_csv(spark, path, bike_schema(year, month) if code == "c" else source.schema)


def _month_of_path(pattern: str) -> tuple:
    """Year and month of the file a row is read from, by the feed's file pattern."""
    known = re.escape(pattern).replace(r"\{year\}", r"(\d{4})").replace(r"\{month:02d\}", r"(\d{2})")
    path = F.col("_metadata.file_path")
    return tuple(F.regexp_extract(path, known, k).cast("int") for k in (1, 2))


def _used_schema(schema: T.StructType, source: Feed) -> T.StructType:
    """The fields of a file that cleaning uses, under their own names."""
    common = {own.lower(): name for own, name in source.columns.items()}
    kinds = {name.lower() for name in source.kinds}
    used = [f for f in schema if common.get(f.name.lower(), f.name).lower() in kinds]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in used])


def read_months(
    spark: SparkSession,
    root: str,
    code: str,
    months: Iterable[tuple[int, int]],
    lost: list[Observation] | None = None,
) -> DataFrame:
    """Several months of a feed as one table.

    The published files change types and gain columns over time. The months are grouped by what their
    footers (or headers) say of the columns that cleaning uses; each group is one scan, cast to the
    common types, and ``file_year`` and ``file_month`` are read off the path of a row's file. So the
    plan has as many scans as there are layouts, not months. ``lost`` receives one counter of values
    that do not parse for each scan of text.
    """
    source = feed(code)
    layouts: dict[str, tuple[T.StructType, list[str]]] = {}
    for year, month in months:
        path = f"{root}/" + source.path.format(year=year, month=month)
        if source.is_parquet:
            layout = _used_schema(spark.read.parquet(path).schema, source)
            own = layout.json()
        else:
            layout = bike_schema(year, month)
            header = spark.read.option("header", True).csv(path).columns
            own = repr((layout.names, header))
        layouts.setdefault(own, (layout, []))[1].append(path)
    file_year, file_month = _month_of_path(source.path)
    scans = []
    for layout, paths in layouts.values():
        named = {"file_year": file_year, "file_month": file_month}
        if source.is_parquet:
            files = spark.read.schema(layout).parquet(*paths)
            scans.append(harmonise(files.select("*", *[c.alias(n) for n, c in named.items()]), source))
            continue
        text = spark.read.option("header", True).csv(paths)
        counter = None
        if lost is not None:
            lost.append(counter := Observation())
        kept = typed(text.withColumns(named), T.StructType([*layout, *_FILE_FIELDS]), counter)
        scans.append(kept)
    return union_feeds(scans)


def union_feeds(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name, so that feeds may order their columns differently."""
    return reduce(lambda a, b: a.unionByName(b), frames)


FILE_COLUMNS = ["file_year", "file_month"]
_FILE_FIELDS = [T.StructField(name, T.IntegerType()) for name in FILE_COLUMNS]


def trip_shape(trips: DataFrame, **renames: str) -> DataFrame:
    """The four common columns, and the file's month if known; ``renames`` gives common name =
    the feed's name."""
    return trips.select(
        *[F.col(f"`{renames.get(c, c)}`").alias(c) for c in schemas.TRIP_COLUMNS],
        *[c for c in FILE_COLUMNS if c in trips.columns],
    )


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and nullability."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, type string, nullable boolean"
    )
