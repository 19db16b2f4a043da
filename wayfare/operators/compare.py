"""Pairing two modes by zone pair and hour.

Every taxi trip meets every bike trip of the same key, so the number of pairs grows with
the square of a busy key. No operator here builds those pairs trip by trip. Both modes are
first counted per key and duration in whole seconds; durations outside the study's bounds
share one row, so a key has at most ``max_seconds`` rows however many trips it holds.
Everything asked of the pairs follows from these counts:

* ``merged_trips`` multiplies them out, with ``pairs`` saying how often each row occurs;
* ``key_outcomes`` gives sums, squares and wins per key without joining at all.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from wayfare.functions.calendar import HOUR_KEYS, with_calendar
from wayfare.functions.codes import difference_codes, hour_codes
from wayfare.operators import filters
from wayfare.operators.enrich import with_weather
from wayfare.operators.running import with_running
from wayfare.operators.sides import bounded_side, materialise, written_table

PAIR_KEYS = [*HOUR_KEYS, "PULocationID", "DOLocationID", "day_of_week"]
PAIR_CODES = ["trip_difference", "peak_hours", "weather_pattern", "better_travel_type"]
EXPANSION_CHUNK = 10_000

# Rows of duration pairs of one key that a single task may produce before the key is split, and what
# this is lowered to, at least, where all rows are too few to keep the cores busy.
KEY_PRODUCT = 4_000_000
LEAST_PRODUCT = 500_000

# Rows of duration pairs, in key products, that one task produces, about.
TASK_PRODUCTS = 4

# Tasks of pairs that a core has, at least, before its tasks are made larger.
TASKS_A_CORE = 4

# Products of two counts, or of a count and a sum, exceed 64 bits at cluster scale.
WIDE = "decimal(38,0)"


def _wide(name: str) -> Column:
    return F.col(name).cast(WIDE)


def duration_counts(
    taxis: DataFrame, bikes: DataFrame, max_seconds: int = filters.MAX_SECONDS
) -> DataFrame:
    """Weekday trips per key and duration, as ``n_taxis`` and ``n_bikes``.

    Durations outside ``(0, max_seconds)`` are counted under a null duration: they never
    pair, but belong to the hour's traffic.
    """

    def tagged(trips: DataFrame, taxi: int) -> DataFrame:
        d = F.col("trip_duration")
        inside = F.when((d > 0) & (d < max_seconds), d)
        return filters.keep(with_calendar(trips), filters.weekday_rule()).select(
            *PAIR_KEYS,
            inside.alias("trip_duration"),
            F.lit(taxi).alias("taxi"),
        )

    both = tagged(taxis, 1).unionByName(tagged(bikes, 0))
    return both.groupBy(*PAIR_KEYS, "trip_duration").agg(
        F.count_if(F.col("taxi") == 1).alias("n_taxis"),
        F.count_if(F.col("taxi") == 0).alias("n_bikes"),
    )


def _hour_traffic(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*HOUR_KEYS).agg(
        F.sum("n_taxis").alias("count_taxis"), F.sum("n_bikes").alias("count_bikes")
    )


def _join_durations(
    counts: DataFrame, key_product: int, known: Callable[[DataFrame], DataFrame], pairs_type: str
) -> DataFrame:
    """Taxi durations with bike durations of the same key, and their number of ``pairs``.

    The bike durations of a key, at most ``max_seconds``, are lists in one row. A taxi row meets this
    row and is multiplied by its lists, so a pair costs little more than writing it. ``known`` adds what
    follows from the key alone. It is asked for the rows with lists and not for their pairs.

    A key whose product of distinct durations is large is split: its taxi rows are dealt to slots and
    its lists repeated per slot. Other keys stay whole. There are as many tasks as the number of rows
    asks for, however few bytes the counts have.
    """
    product = F.count_if(F.col("n_taxis") > 0) * F.count_if(F.col("n_bikes") > 0)
    bike = F.when(F.col("n_bikes") > 0, F.struct("trip_duration", "n_bikes"))
    total = Observation()
    lists = materialise(
        counts.groupBy(*PAIR_KEYS)
        .agg(
            product.alias("product"),
            F.max(F.greatest("n_taxis", "n_bikes")).alias("most"),
            F.collect_list(bike).alias("bikes"),
        )
        .observe(total, F.sum("product").alias("rows"), F.max("most").alias("most"))
        .filter("product > 0")
        .select(
            *PAIR_KEYS,
            "product",
            F.col("bikes.trip_duration").alias("durations"),
            F.col("bikes.n_bikes").alias("numbers"),
        )
    )
    rows, most = total.get["rows"] or 0, total.get["most"] or 0
    cores = counts.sparkSession.sparkContext.defaultParallelism
    evenly = rows // (cores * TASKS_A_CORE * TASK_PRODUCTS)
    key_product = min(key_product, max(evenly, LEAST_PRODUCT))
    slots = F.ceil(F.col("product") / key_product).cast("int")
    taxis = counts.filter("n_taxis > 0").select(
        *PAIR_KEYS, F.col("trip_duration").alias("trip_duration_taxis"), "n_taxis"
    )
    bikes, keys = known(lists), PAIR_KEYS
    busy = materialise(lists.select(*PAIR_KEYS, slots.alias("slots")).filter("slots > 1"))
    if not busy.isEmpty():
        own = F.coalesce(F.col("slots"), F.lit(1))
        dealt = F.pmod("trip_duration_taxis", own).cast("int")
        taxis = taxis.join(bounded_side(busy), PAIR_KEYS, "left").withColumn("slot", dealt).drop("slots")
        bikes = bikes.withColumn("slot", F.explode(F.sequence(F.lit(0), slots - 1)))
        keys = [*PAIR_KEYS, "slot"]
    tasks = -(-rows // (TASK_PRODUCTS * key_product))
    if tasks > 1:
        taxis, bikes = (df.repartition(tasks, *keys) for df in (taxis, bikes))
    # A merge join goes through the taxi rows one by one, and a task holds the pairs of one of them. A
    # broadcast of the taxi rows would have it hold those of all taxi rows of a key.
    met = taxis.join(bikes.drop("product").hint("merge"), keys)
    paired = met.select("*", F.posexplode("durations").alias("place", "trip_duration_bikes"))
    # There is one product for each row of pairs, so it is in 64 bits where all of them fit.
    factors = [F.col("n_taxis"), F.get("numbers", F.col("place"))]
    n_taxis, n_bikes = factors if most < 2**31 else [n.cast(pairs_type) for n in factors]
    return paired.withColumn("pairs", (n_taxis * n_bikes).cast(pairs_type)).drop(
        "slot", "n_taxis", "durations", "numbers", "place"
    )


def merged_trips(
    taxis: DataFrame,
    bikes: DataFrame,
    weather: DataFrame,
    max_seconds: int = filters.MAX_SECONDS,
    key_product: int = KEY_PRODUCT,
    pairs_type: str = WIDE,
) -> DataFrame:
    """The merged table: one row per key and pair of durations, with its number of pairs.

    ``weather`` is a prepared join side. :func:`expand_pairs` gives one row per pair. ``pairs_type`` is
    the type of ``pairs``; ``double`` takes less time and is exact up to 2**53.
    """
    counts = written_table(duration_counts(taxis, bikes, max_seconds))
    return merged_counts(counts, weather, key_product=key_product, pairs_type=pairs_type)


def merged_counts(
    counts: DataFrame,
    weather: DataFrame,
    keys: DataFrame | None = None,
    key_product: int = KEY_PRODUCT,
    pairs_type: str = WIDE,
) -> DataFrame:
    """The merged table of stored :func:`duration_counts`; ``keys`` limits it to some keys."""
    asked = counts if keys is None else counts.join(bounded_side(keys), keys.columns, "left_semi")
    traffic, measures = bounded_side(_hour_traffic(counts)), weather.drop("Date")

    def known(trips: DataFrame) -> DataFrame:
        return with_weather(trips.join(traffic, HOUR_KEYS, "left"), measures).withColumns(hour_codes())

    paired = _join_durations(asked.filter(F.col("trip_duration").isNotNull()), key_product, known, pairs_type)
    return paired.withColumns(difference_codes()).select(
        *PAIR_KEYS,
        "trip_duration_taxis",
        "trip_duration_bikes",
        "pairs",
        "count_taxis",
        "count_bikes",
        *PAIR_CODES,
        *(c for c in measures.columns if c not in HOUR_KEYS),
    )


def expand_pairs(merged: DataFrame, chunk: int = EXPANSION_CHUNK) -> DataFrame:
    """One row per pair. A row with many pairs is spread over tasks in chunks, and many chunks in
    turn, so that no list is longer than a few hundred thousand items even for 10**14 pairs."""
    size = F.lit(chunk).cast("long")
    wide = merged.withColumn("pairs", F.col("pairs").cast("long"))

    def dealt(df: DataFrame, name: str, count: Column) -> DataFrame:
        return df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), count - 1))).repartition(
            name, *PAIR_KEYS
        )

    def parts(whole: Column, part: Column) -> Column:
        return F.floor((whole + part - 1) / part).cast("long")

    groups = dealt(wide, "_group", parts(F.col("pairs"), size * size))
    inside = F.least(size * size, F.col("pairs") - F.col("_group") * size * size)
    chunks = dealt(groups.withColumn("_inside", inside), "_chunk", parts(F.col("_inside"), size))
    rest = F.least(size, F.col("_inside") - F.col("_chunk") * size)
    return chunks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), rest))).drop(
        "_group", "_inside", "_chunk", "_copy", "pairs"
    )


def key_sums(
    taxis: DataFrame, bikes: DataFrame, max_seconds: int = filters.MAX_SECONDS
) -> DataFrame:
    """Per key: trips and total seconds of both modes, keys with both modes only.

    One aggregation over the union of both feeds takes the place of the pair join for every
    figure that is linear in the durations: a key stands for ``n_taxis * n_bikes`` pairs
    whose taxi seconds add up to ``n_bikes * taxi_seconds``, and likewise for bikes.
    """

    def valid(trips: DataFrame, taxi: int) -> DataFrame:
        return filters.keep(
            with_calendar(trips),
            filters.weekday_rule(),
            filters.duration_rule("trip_duration", max_seconds),
        ).select(*PAIR_KEYS, "trip_duration", F.lit(taxi).alias("taxi"))

    is_taxi, seconds = F.col("taxi") == 1, F.col("trip_duration")
    sums = (
        valid(taxis, 1)
        .unionByName(valid(bikes, 0))
        .groupBy(*PAIR_KEYS)
        .agg(
            F.count_if(is_taxi).alias("n_taxis"),
            F.count_if(~is_taxi).alias("n_bikes"),
            F.sum(F.when(is_taxi, seconds)).alias("taxi_seconds"),
            F.sum(F.when(~is_taxi, seconds)).alias("bike_seconds"),
        )
    )
    return _paired_keys(sums)


def _paired_keys(sums: DataFrame) -> DataFrame:
    """Keys that have both modes, and no null in the key (an equi join drops those)."""
    return sums.filter("n_taxis > 0 AND n_bikes > 0").na.drop("any", subset=PAIR_KEYS)


def pair_totals(sums: DataFrame, *by: str) -> DataFrame:
    """Pairs and total seconds over pairs for each group of keys."""
    n_t, n_b = _wide("n_taxis"), _wide("n_bikes")
    s_t, s_b = _wide("taxi_seconds"), _wide("bike_seconds")
    return sums.groupBy(*by).agg(
        F.sum(n_t * n_b).cast(WIDE).alias("pairs"),
        F.sum(n_b * s_t).cast(WIDE).alias("taxi_seconds"),
        F.sum(n_t * s_b).cast(WIDE).alias("bike_seconds"),
    )


def pair_means(sums: DataFrame, *by: str) -> DataFrame:
    """Mean durations and mean difference over pairs, without building pairs."""
    n = F.col("pairs").cast("double")
    taxi, bike = F.col("taxi_seconds"), F.col("bike_seconds")
    return pair_totals(sums, *by).select(
        *by,
        "pairs",
        (taxi.cast("double") / n).alias("avg_taxis"),
        (bike.cast("double") / n).alias("avg_bikes"),
        ((taxi - bike).cast("double") / n).alias("avg_difference"),
    )


def key_outcomes(counts: DataFrame) -> DataFrame:
    """Per key: pairs, sum and sum of squares of the difference, and pairs the taxi lost.

    ``counts`` comes from :func:`duration_counts`. For a taxi of duration d the bikes that
    were faster are a running count over the key's durations, so the window holds at most
    ``max_seconds`` rows per key.
    """
    faster = (
        Window.partitionBy(*PAIR_KEYS)
        .orderBy("trip_duration")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    d = F.col("trip_duration")
    n_t, n_b = _wide("n_taxis"), _wide("n_bikes")
    per_key = (
        counts.filter(F.col("trip_duration").isNotNull())
        .withColumn("bikes_faster", F.coalesce(F.sum("n_bikes").over(faster), F.lit(0)))
        .groupBy(*PAIR_KEYS)
        .agg(
            F.sum("n_taxis").alias("n_taxis"),
            F.sum("n_bikes").alias("n_bikes"),
            F.sum(F.col("n_taxis") * d).alias("t1"),
            F.sum(F.col("n_bikes") * d).alias("b1"),
            F.sum(n_t * (d * d)).alias("t2"),
            F.sum(n_b * (d * d)).alias("b2"),
            F.sum(n_t * _wide("bikes_faster")).alias("wins"),
        )
    )
    t1, b1, t2, b2 = (_wide(c) for c in ("t1", "b1", "t2", "b2"))
    return _paired_keys(per_key).select(
        *PAIR_KEYS,
        (n_t * n_b).cast(WIDE).alias("pairs"),
        (n_b * t1 - n_t * b1).cast(WIDE).alias("difference_sum"),
        (n_b * t2 + n_t * b2 - 2 * t1 * b1).cast(WIDE).alias("difference_squares"),
        F.col("wins").cast(WIDE).alias("taxi_slower_pairs"),
    )


def class_balance(outcomes: DataFrame) -> DataFrame:
    """Pairs per better-mode code."""
    totals = outcomes.agg(
        F.sum("taxi_slower_pairs").alias("slower"), F.sum("pairs").alias("pairs")
    )
    classes = F.array(
        F.struct(F.lit(0).alias("better_travel_type"), (F.col("pairs") - F.col("slower")).alias("pairs")),
        F.struct(F.lit(1).alias("better_travel_type"), F.col("slower").alias("pairs")),
    )
    return totals.select(F.inline(classes)).select(
        "better_travel_type", F.col("pairs").cast(WIDE).alias("pairs")
    ).filter("pairs > 0")


def difference_spread(outcomes: DataFrame, *by: str) -> DataFrame:
    """Sample variance of the difference over pairs; its root is the naive RMSE."""
    n = F.col("pairs").cast("double")
    total, squares = F.col("s").cast("double"), F.col("q").cast("double")
    spread = F.try_divide(squares - total * total / n, n - 1)
    return (
        outcomes.groupBy(*by)
        .agg(
            F.sum("pairs").cast(WIDE).alias("pairs"),
            F.sum("difference_sum").alias("s"),
            F.sum("difference_squares").alias("q"),
        )
        .select(*by, "pairs", spread.alias("variance"), F.sqrt(spread).alias("naive_rmse"))
    )


def pair_page(counts: DataFrame, first: int, size: int, chunk: int = EXPANSION_CHUNK) -> DataFrame:
    """Pairs number ``first`` up to ``first + size`` of all pairs of stored :func:`duration_counts`, one
    row each, without building any other.

    Pairs are numbered by key, then taxi duration, then bike duration. Running pair counts over the keys
    tell which keys the page lies in; within a key of B bike trips, pair r is taxi trip r / B and bike
    trip r % B in order of duration. So only the trips that the page needs are numbered, and a key of
    any number of pairs costs no more than its page.
    """
    known = counts.filter(F.col("trip_duration").isNotNull())
    totals = known.groupBy(*PAIR_KEYS).agg(F.sum("n_taxis").alias("taxis"), F.sum("n_bikes").alias("bikes"))
    totals = totals.filter("taxis > 0 and bikes > 0").withColumns(
        {"_all": F.lit(0), "pairs": _wide("taxis") * _wide("bikes")}
    )
    placed = with_running(totals, ["_all"], PAIR_KEYS, {"upto": F.col("pairs")})
    before = F.col("upto") - F.col("pairs")
    start, end = F.lit(first).cast(WIDE), F.lit(first + size).cast(WIDE)
    keys = materialise(
        placed.filter((F.col("upto") > start) & (before < end)).select(
            *PAIR_KEYS,
            F.col("bikes").cast("long").alias("bikes"),
            before.cast(WIDE).alias("before"),
            F.greatest(start - before, F.lit(0).cast(WIDE)).cast("long").alias("low"),
            (F.least(end, F.col("upto")) - before).cast("long").alias("high"),
        )
    )
    pages = keys.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("high") - F.col("low") - 1) / chunk))))
    low = F.col("low") + F.col("part") * chunk
    numbers = pages.withColumn("r", F.explode(F.sequence(low, F.least(low + chunk, F.col("high")) - 1))).select(
        *PAIR_KEYS,
        (F.col("before") + F.col("r")).cast("long").alias("number"),
        F.expr("r div bikes").alias("taxi"),
        F.expr("r % bikes").alias("bike"),
    )

    def trips(count: str, index: str, wanted: list[tuple[Column, Column]]) -> DataFrame:
        """The trips of the page's keys that are wanted, numbered by duration."""
        line = Window.partitionBy(*PAIR_KEYS).orderBy("trip_duration")  # at most max_seconds rows
        own = known.filter(F.col(count) > 0).join(bounded_side(keys), PAIR_KEYS)
        upto = F.sum(count).over(line)
        ranged = own.withColumns({"to": upto, "from": upto - F.col(count)})
        each = ranged.withColumn(index, F.explode(F.filter(F.array(*_intervals(wanted)), lambda x: x["a"] <= x["b"])))
        return each.select(
            *PAIR_KEYS, F.explode(F.sequence(F.col(f"{index}.a"), F.col(f"{index}.b"))).alias(index), "trip_duration"
        )

    def _intervals(wanted: list[tuple[Column, Column]]) -> list[Column]:
        """What of the numbers from ``from`` to ``to`` lies in each of the wanted ranges."""
        return [
            F.struct(F.greatest("from", a).cast("long").alias("a"), F.least(F.col("to") - 1, b).cast("long").alias("b"))
            for a, b in wanted
        ]

    taxi_low, taxi_high = F.expr("low div bikes"), F.expr("(high - 1) div bikes")
    bike_low, bike_high = F.expr("low % bikes"), F.expr("(high - 1) % bikes")
    none, last = F.lit(-1).cast("long"), F.col("bikes") - 1
    short = F.col("high") - F.col("low") < F.col("bikes")  # not every bike trip is met
    turns = short & (taxi_low < taxi_high)  # it goes on with the first bike trips
    bike_ranges = [
        (F.when(short, bike_low).otherwise(0), F.when(short & ~turns, bike_high).otherwise(last)),
        (F.lit(0).cast("long"), F.when(turns, bike_high).otherwise(none)),
    ]
    taxis = trips("n_taxis", "taxi", [(taxi_low, taxi_high)])
    bikes = trips("n_bikes", "bike", bike_ranges)
    return (
        numbers.join(taxis.withColumnRenamed("trip_duration", "trip_duration_taxis"), [*PAIR_KEYS, "taxi"])
        .join(bikes.withColumnRenamed("trip_duration", "trip_duration_bikes"), [*PAIR_KEYS, "bike"])
        .select("number", *PAIR_KEYS, "trip_duration_taxis", "trip_duration_bikes")
    )
