"""The station dimension: from trips, with zones, and matched to renamed stations."""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.operators.running import with_running
from wayfare.operators.sides import bounded_side, materialise

# Fixed value: largest coordinate deviation, in degrees, of a renamed station.
NEAR_DEGREES = 0.000005

# Cells per search radius. Points at most one cell apart on both axes are then surely within
# the radius (2 / 2.5 of it), and cells up to three apart can still hold a point within it.
CELLS_PER_RADIUS = 2.5
SURE_CELLS, REACH_CELLS = 1, 3

# Points of a rim cell up to which they are compared one by one.
RIM_POINTS = 64

# Side of a lookup cell for zone polygons, in degrees, and the edges in it above which it is split into
# cells that are so many times finer on both axes, up to so many tables.
ZONE_CELL = 0.01
CELL_EDGES = 64
FINER = 4
ZONE_LEVELS = 8


def station_dimension(
    rides: DataFrame, start: Sequence[str], end: Sequence[str], clock: str, key: str = "id"
) -> DataFrame:
    """Stations seen at either end of a ride; the earliest sighting's attributes win.

    ``start`` and ``end`` name the id, name, latitude and longitude columns. Sightings are
    ordered by time, start before end, then by attributes. Distinct attribute sets are
    reduced first with a fixed-width minimum (a hash aggregate on the map side), so that
    only a handful of rows per station are shuffled.
    """

    def sighting(columns: Sequence[str], side: int) -> Column:
        station, name, lat, lng = (F.col(f"`{c}`") for c in columns)
        return F.struct(
            station.alias(key),
            name.alias("name"),
            lat.alias("latitude"),
            lng.alias("longtitude"),
            (F.unix_micros(F.col(f"`{clock}`").cast("timestamp")) * 2 + side).alias("seen"),
        )

    attributes = ["name", "latitude", "longtitude"]
    variants = (
        rides.select(F.inline(F.array(sighting(start, 0), sighting(end, 1))))
        .filter(F.col(key).isNotNull())
        .groupBy(key, *attributes)
        .agg(F.min("seen").alias("seen"))
    )
    first = F.min(F.struct("seen", *attributes))
    return variants.groupBy(key).agg(first.alias("first")).select(
        key, *[F.col(f"first.{a}").alias(a) for a in attributes]
    )


def match_by_name(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old stations with the new id and place of the same name; unmatched stay null.

    New stations are reduced to one per name (lowest new id) before the join. That is the
    row each old station would keep anyway, and it makes the join many-to-one.
    """
    chosen = new.groupBy("name").agg(
        F.min(F.struct("new_id", "new_latitude", "new_longtitude")).alias("match")
    )
    return old.join(chosen, "name", "left").select(
        *[f"`{c}`" for c in old.columns],
        "match.new_id",
        "match.new_latitude",
        "match.new_longtitude",
    )


def near_matches(
    left: DataFrame,
    right: DataFrame,
    radius: float = NEAR_DEGREES,
    left_place: tuple[str, str] = ("latitude", "longtitude"),
    right_place: tuple[str, str] = ("new_latitude", "new_longtitude"),
    key: str = "new_id",
    most: int = RIM_POINTS,
) -> DataFrame:
    """For each distinct left place: the lowest right key less than ``radius`` away on both axes.

    Returns left place columns, ``key`` and the right place columns.

    The places are put on a grid finer than the radius. A right point in the left point's own or an
    adjoining cell is surely near, so such cells only contribute their lowest key: a cell with any
    number of points is one row. Cells at the rim are only looked at if they hold a lower key. Those of
    up to ``most`` points are compared point by point; in a larger one the lowest key in reach is read
    off a running minimum over its points in order, see :func:`_lowest_in_reach`, so that many points
    near many others are never paired.
    """
    width = radius / CELLS_PER_RADIUS

    def cell(column: str) -> Column:
        return F.floor(F.col(column) / width)

    lx, ly = left_place
    rx, ry = right_place
    candidate = F.struct(key, rx, ry)
    places = right.groupBy(rx, ry).agg(F.min(key).alias(key)).withColumns({"cx": cell(rx), "cy": cell(ry)})
    whole_cells = places.groupBy("cx", "cy").agg(F.min(candidate).alias("hit"), F.count(F.lit(1)).alias("points"))

    seekers = left.select(lx, ly).na.drop().distinct().withColumns({"ox": cell(lx), "oy": cell(ly)})
    steps = F.sequence(F.lit(-REACH_CELLS), F.lit(REACH_CELLS))
    around = (
        seekers.withColumn("dx", F.explode(steps))
        .withColumn("dy", F.explode(steps))
        .withColumns({"cx": F.col("ox") + F.col("dx"), "cy": F.col("oy") + F.col("dy")})
        .drop("ox", "oy")
    )
    sure = (F.abs("dx") <= SURE_CELLS) & (F.abs("dy") <= SURE_CELLS)

    # One pass over the cells around: the best sure hit, and the rim cells that could beat it.
    rim_cell = F.struct("cx", "cy", "dx", "dy", "points", F.col(f"hit.{key}").alias("low"))
    reached = around.withColumn("sure", sure).join(whole_cells, ["cx", "cy"]).groupBy(lx, ly).agg(
        F.min(F.when(F.col("sure"), F.col("hit"))).alias("best"),
        F.collect_list(F.when(~F.col("sure"), rim_cell)).alias("rim"),
    )
    reached = materialise(reached)
    inner = reached.filter("best is not null").select(lx, ly, F.col("best").alias("hit"))
    open_rim = F.filter("rim", lambda c: F.col("best").isNull() | (c["low"] <= F.col(f"best.{key}")))
    rim = reached.select(lx, ly, "best", F.inline(open_rim)).drop("low")
    near = (F.abs(F.col(lx) - F.col(rx)) < radius) & (F.abs(F.col(ly) - F.col(ry)) < radius)
    compared = (
        rim.filter(F.col("points") <= most)
        .join(places, ["cx", "cy"])
        .filter(F.col("best").isNull() | (F.col(key) <= F.col(f"best.{key}")))
        .filter(near)
        .select(lx, ly, candidate.alias("hit"))
    )
    found = inner.unionByName(compared)
    crowded = rim.filter(F.col("points") > most).select(
        F.col(lx).alias("x"), F.col(ly).alias("y"), "cx", "cy", "dx", "dy"
    )
    if not crowded.isEmpty():
        points = places.select("cx", "cy", F.col(rx).alias("x"), F.col(ry).alias("y"), candidate.alias("hit"))
        lowest = _lowest_in_reach(materialise(crowded), points, radius)
        found = found.unionByName(lowest.select(F.col("x").alias(lx), F.col("y").alias(ly), "hit"))
    return (
        found.groupBy(lx, ly)
        .agg(F.min("hit").alias("hit"))
        .select(lx, ly, f"hit.{key}", f"hit.{rx}", f"hit.{ry}")
    )


def _ordered(numbers: np.ndarray) -> np.ndarray:
    """Doubles as integers in the same order, and such integers as doubles' bits again."""
    return np.where(numbers < 0, np.int64(-(2**63)) - numbers, numbers)


def furthest_within(starts: np.ndarray, radius: float) -> np.ndarray:
    """The largest numbers that still are less than the radius away, as subtraction rounds."""
    starts = np.asarray(starts, float) + 0.0
    near, far = (_ordered(x.view(np.int64)) for x in (starts, starts + 2 * radius))
    while (open_ := far - 1 > near).any():
        middle = (near >> 1) + (far >> 1) + (near & far & 1)
        reached = np.abs(starts - _ordered(middle).view(np.float64)) < radius
        near = np.where(open_ & reached, middle, near)
        far = np.where(open_ & ~reached, middle, far)
    return _ordered(near).view(np.float64)


def _furthest(radius: float):
    @F.pandas_udf("double")
    def furthest(place: pd.Series) -> pd.Series:
        return pd.Series(furthest_within(place.to_numpy(), radius))

    return furthest


def _lowest_in_reach(seekers: DataFrame, points: DataFrame, radius: float) -> DataFrame:
    """For seekers (x, y) and a rim cell of theirs (cx, cy, dx and dy cells away): the lowest ``hit``
    among the cell's points in reach.

    On an axis on which the cell is at most one away all its points are in reach; on another, those
    before a border. With one border, the answer is the running minimum of the points in its order. With
    two, the points are numbered in order of the first axis; those before the border are the union of
    blocks of 1, 2, 4, ... numbers, and within each block the second axis' running minimum answers.
    """
    furthest = _furthest(radius)

    def towards(step: str) -> Column:
        return F.when(F.abs(step) <= SURE_CELLS, 0).otherwise(F.signum(step)).cast("int")

    asked = seekers.withColumns({"sx": towards("dx"), "sy": towards("dy")})
    # With one border, it is the first axis (u); v is then the same for all.
    only_y = F.col("sx") == 0
    place = {
        "u": F.when(only_y, F.col("y") * F.col("sy")).otherwise(F.col("x") * F.col("sx")),
        "v": F.when(only_y | (F.col("sy") == 0), F.lit(0.0)).otherwise(F.col("y") * F.col("sy")),
    }
    groups = ["cx", "cy", "sx", "sy"]
    borders = asked.withColumns(place).withColumns({"u": furthest("u"), "v": furthest("v")})
    sides = asked.select(*groups).distinct()
    own = points.join(sides, ["cx", "cy"]).withColumns(place)
    none = F.lit(None).cast(points.schema["hit"].dataType)
    both = own.select(*groups, "u", "v", "x", "y", "hit", F.lit(0).alias("asks")).unionByName(
        borders.select(*groups, "u", "v", "x", "y", none.alias("hit"), F.lit(1).alias("asks"))
    )
    # Points stand before the borders that they just reach.
    numbered = materialise(
        with_running(
            both, groups, ["u", "asks", "v", "x", "y"], {"before": 1 - F.col("asks")}, {"low": F.col("hit")}
        )
    )
    two = (F.col("sx") != 0) & (F.col("sy") != 0)
    single = numbered.filter((F.col("asks") == 1) & ~two).select("x", "y", F.col("low").alias("hit"))
    levels = F.sequence(F.lit(0), F.lit(40))

    def block(level: Column) -> Column:
        # A point's number is one less than its count. A border's blocks are those of the bits of its
        # count: the block ends at the count without its lower bits.
        shifted = F.when(F.col("asks") == 0, _shifted(F.col("before") - 1, level)).otherwise(
            _shifted(F.col("before"), level) - 1
        )
        return F.struct(level.alias("level"), shifted.alias("block"))

    # Only even blocks are asked for. Above its own cell's size every point would be in block 0.
    sizes = numbered.filter("asks = 0").groupBy(*groups).agg(F.max("before").alias("size"))
    split = (
        numbered.filter(two)
        .join(sizes, groups)
        .withColumn("at", F.explode(F.transform(levels, block)))
        .filter((F.col("at.block") >= 0) & (F.col("at.block") % 2 == 0))
        .filter(_shifted(F.col("size"), F.col("at.level")) > 0)
        .select(*groups, "at.level", "at.block", "v", "x", "y", "hit", "asks")
    )
    ranked = with_running(
        split, [*groups, "level", "block"], ["v", "asks", "x", "y"], lows={"low": F.col("hit")}
    )
    double = ranked.filter("asks = 1").select("x", "y", F.col("low").alias("hit"))
    return single.unionByName(double).filter("hit is not null")


def _shifted(number: Column, by: Column) -> Column:
    return F.floor(number / F.pow(F.lit(2.0), by))


def match_stations(old: DataFrame, new: DataFrame, radius: float = NEAR_DEGREES) -> DataFrame:
    """Old stations with new ids: by name, else by place; stations without a match are dropped."""
    named = match_by_name(old, new)
    nearby = near_matches(named.filter(F.col("new_id").isNull()), new, radius).select(
        "latitude",
        "longtitude",
        F.struct("new_id", "new_latitude", "new_longtitude").alias("near"),
    )
    found = named.join(nearby, ["latitude", "longtitude"], "left")
    filled = {
        c: F.coalesce(F.col(c), F.col(f"near.{c}"))
        for c in ("new_id", "new_latitude", "new_longtitude")
    }
    return found.withColumns(filled).drop("near").select(*named.columns).na.drop()


def zone_edges(zones: DataFrame) -> DataFrame:
    """One row per edge of ``zones`` (one row per ring: ``zone_id``, ``ring``): from ``a`` to ``b``, with
    the points before and behind it.

    Unclosed rings are closed. All rings of a zone count together, holes and islands included.
    """
    closed = F.element_at("ring", 1) == F.element_at("ring", -1)
    open_ring = F.when(closed & (F.size("ring") > 1), F.slice("ring", 1, F.size("ring") - 1)).otherwise(F.col("ring"))

    def edge(ring: Column) -> Column:
        n = F.size(ring)

        def point(place: Column, name: str) -> list[Column]:
            found = F.get(ring, place % n)
            return [found["x"].cast("double").alias(f"{name}x"), found["y"].cast("double").alias(f"{name}y")]

        return F.transform(
            ring,
            lambda _, i: F.struct(
                *point(i, "a"), *point(i + 1, "b"), *point(i + n - 1, "p"), *point(i + 2, "n")
            ),
        )

    rings = zones.filter(F.size("ring") > 0).select("zone_id", open_ring.alias("ring"))
    return rings.select("zone_id", F.inline(edge(F.col("ring"))))


def _row_of(y: Column, size: float) -> Column:
    return F.floor(y / size)


def _reach(ax: Column, ay: Column, bx: Column, by: Column, row: Column, size: float) -> tuple[Column, Column]:
    """The first and last cell of a row that the edge from a to b can touch, a little too wide rather
    than too narrow. An end of the edge within the row is always in these cells."""
    slack = size * 1e-3
    low, high = F.least(ax, bx), F.greatest(ax, bx)
    ra, rb = _row_of(ay, size), _row_of(by, size)

    def at(y: Column) -> Column:
        x = ax + F.try_divide(y - ay, by - ay) * (bx - ax)
        return F.greatest(F.least(x, high), low)

    ends = [
        F.when(ra == row, ax),
        F.when(rb == row, bx),
        F.when(F.least(ra, rb) < row, at(row * size)),
        F.when(F.greatest(ra, rb) > row, at((row + 1) * size)),
    ]
    flat = F.abs(by - ay) < slack  # its crossings are too uncertain
    first = F.when(flat, low).otherwise(F.least(*ends))
    last = F.when(flat, high).otherwise(F.greatest(*ends))
    return F.floor((first - slack) / size), F.floor((last + slack) / size)


def _reach_of(start: str, end: str, size: float, row: str = "cy") -> tuple[Column, Column]:
    names = (f"{start}x", f"{start}y", f"{end}x", f"{end}y", row)
    return _reach(*(F.col(c) for c in names), size)


def _by_row(edges: DataFrame, size: float, within: Column | None = None) -> DataFrame:
    """Edges once per row ``cy`` of the grid that they touch; ``within`` is the coarser row they are of."""
    low = F.least(_row_of(F.col("ay"), size), _row_of(F.col("by"), size))
    high = F.greatest(_row_of(F.col("ay"), size), _row_of(F.col("by"), size))
    if within is not None:
        low = F.greatest(low, within * FINER)
        high = F.least(high, within * FINER + FINER - 1)
    return edges.withColumn("cy", F.explode(F.sequence(low, high)))


def _edge_cells(rows: DataFrame, size: float, within: Column | None = None) -> DataFrame:
    """Edges of rows once per cell ``cx`` that they touch, with what a point of the cell needs.

    ``from_right`` and ``to_right``: the edge before (behind) lies wholly to the cell's right and shares
    its point in this row.
    """
    low, high = _reach_of("a", "b", size)
    if within is not None:
        low = F.greatest(low, within * FINER)
        high = F.least(high, within * FINER + FINER - 1)
    before, _ = _reach_of("p", "a", size)
    behind, _ = _reach_of("b", "n", size)
    return (
        rows.filter(low <= high)
        .withColumn("cx", F.explode(F.sequence(low, high)))
        .withColumns(
            {
                "from_right": (_row_of(F.col("ay"), size) == F.col("cy")) & (before > F.col("cx")),
                "to_right": (_row_of(F.col("by"), size) == F.col("cy")) & (behind > F.col("cx")),
            }
        )
    )


def _odd_stretches(rows: DataFrame, size: float) -> DataFrame:
    """Per zone and row the stretches of cells (``first`` to ``last``) to whose right an odd number of
    ends of edges lies above the row, counting edges wholly to a cell's right.

    An edge wholly to the right of a cell is crossed by a ray to the right exactly if one of its ends is
    above the point. Ends outside the row are above it for all its points or for none; ends within it
    are shared by two edges, and cancel unless one of them touches the cell.
    """
    low, _ = _reach_of("a", "b", size)
    above = sum((_row_of(F.col(y), size) > F.col("cy")).cast("int") for y in ("ay", "by"))
    events = (
        rows.select("zone_id", "cy", low.alias("at"), above.alias("above"))
        .groupBy("zone_id", "cy", "at")
        .agg((F.sum("above") % 2).alias("odd"))
        .filter("odd = 1")
    )
    line = Window.partitionBy("zone_id", "cy").orderBy("at")
    return (
        events.withColumns({"place": F.row_number().over(line), "first": F.lag("at").over(line)})
        # All stretches together are even, so every second one is odd from either side.
        .filter("place % 2 = 0")
        .select("zone_id", "cy", "first", (F.col("at") - 1).alias("last"))
    )


def zone_cells(zones: DataFrame, cell: float = ZONE_CELL, most: int = CELL_EDGES) -> list[DataFrame]:
    """Lookup cells of the zones, coarse to fine: ``cx``, ``cy``, ``candidates`` and ``split``.

    A candidate is a zone that can hold points of the cell: its edges there, and whether the right end
    of the cell's row is inside as far as edges outside the cell tell (``inside``; without edges the
    whole cell is). Where more than ``most`` edges meet in a cell, it is ``split``: its zones with edges
    are listed in the cells of the next, finer table. No table needs a zone's or a ring's edges together.
    """
    columns = ["zone_id", "cx", "cy"]
    rows = materialise(_by_row(zone_edges(zones), cell))
    local, pairs = _edge_cells(rows, cell), None
    tables: list[DataFrame] = []
    for level in range(ZONE_LEVELS):
        local = materialise(local)
        crowded = local.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
        crowded = materialise(crowded.select("cx", "cy"))
        last = level == ZONE_LEVELS - 1 or crowded.isEmpty()
        stretches = _odd_stretches(rows, cell)
        first, end = F.col("first"), F.col("last")
        if pairs is not None:
            stretches = stretches.withColumn("up", F.floor(F.col("cy") / FINER)).join(pairs, ["zone_id", "up"])
            first = F.greatest(first, F.col("left") * FINER)
            end = F.least(end, F.col("left") * FINER + FINER - 1)
        inside = stretches.filter(first <= end).select(
            "zone_id", F.explode(F.sequence(first, end)).alias("cx"), "cy"
        )
        kept, deeper = local, None
        if not last:
            kept = local.join(crowded, ["cx", "cy"], "left_anti")
            deeper = materialise(local.join(crowded, ["cx", "cy"], "left_semi"))
            pairs = materialise(deeper.select(*columns).distinct())
            inside = inside.join(pairs, columns, "left_anti")
        edge = F.struct("ax", "ay", "bx", "by", "from_right", "to_right")
        none = F.lit(None).cast(kept.select(edge.alias("e")).schema["e"].dataType)
        per_zone = (
            kept.select(*columns, edge.alias("edge"), F.lit(False).alias("inside"))
            .unionByName(inside.select(*columns, none.alias("edge"), F.lit(True).alias("inside")))
            .groupBy(*columns)
            .agg(F.max("inside").alias("inside"), F.collect_list("edge").alias("edges"))
            .select("cx", "cy", F.struct("zone_id", "inside", "edges").alias("candidate"), F.lit(False).alias("split"))
        )
        if not last:
            no_zone = F.lit(None).cast(per_zone.schema["candidate"].dataType)
            per_zone = per_zone.unionByName(
                crowded.select("cx", "cy", no_zone.alias("candidate"), F.lit(True).alias("split"))
            )
        tables.append(
            per_zone.groupBy("cx", "cy").agg(
                F.sort_array(F.collect_list("candidate")).alias("candidates"), F.max("split").alias("split")
            )
        )
        if last:
            break
        cell = cell / FINER
        pairs = pairs.select("zone_id", F.col("cx").alias("left"), F.col("cy").alias("up"))
        in_rows = pairs.select("zone_id", F.col("up").alias("cy")).distinct()
        rows = materialise(
            _by_row(rows.join(in_rows, ["zone_id", "cy"], "left_semi"), cell, F.col("cy"))
        )
        finer = deeper.drop("from_right", "to_right").withColumnRenamed("cx", "left")
        local = _edge_cells(_by_row(finer, cell, F.col("cy")), cell, F.col("left")).drop("left")
    return tables


def _contains(candidate: Column, x: Column, y: Column) -> Column:
    """Whether the candidate's zone holds a point of its cell: a ray to the right crosses oddly.

    An edge spans the half-open range from its lower to its upper end, so a vertex counts once.
    """

    def odd(edge: Column) -> Column:
        from_above, to_above = edge["ay"] > y, edge["by"] > y
        at = edge["ax"] + F.try_divide(y - edge["ay"], edge["by"] - edge["ay"]) * (edge["bx"] - edge["ax"])
        crossed = F.when(from_above != to_above, x < at).otherwise(False)
        return (crossed != (edge["from_right"] & from_above)) != (edge["to_right"] & to_above)

    return F.aggregate(candidate["edges"], candidate["inside"], lambda held, edge: held != odd(edge))


def with_zone(
    points: DataFrame,
    zones: DataFrame,
    x: str = "longtitude",
    y: str = "latitude",
    name: str = "zone_id",
    cell: float = ZONE_CELL,
    most: int = CELL_EDGES,
) -> DataFrame:
    """Adds the lowest id among the zones containing the point, or null.

    Each point looks up one grid cell, and a finer one where the cell is crowded with edges, and is
    tested against the edges of its cell only. So points are neither multiplied nor regrouped, with a
    broadcast lookup they are not shuffled either, and rings may have any number of points.
    """
    px, py = F.col(x), F.col(y)
    found, hits = points, []
    for level, table in enumerate(zone_cells(zones, cell, most)):
        size = cell / FINER**level
        names = {c: f"_{c}{level}" for c in ("cx", "cy", "candidates", "split")}
        place = {"cx": F.floor(px / size), "cy": F.floor(py / size)}
        if level:  # only points of split cells look further
            place = {c: F.when(F.col(f"_split{level - 1}"), v) for c, v in place.items()}
        found = found.withColumns({names[c]: v for c, v in place.items()}).join(
            bounded_side(table.withColumnsRenamed(names)), [names["cx"], names["cy"]], "left"
        )
        holding = F.filter(F.col(names["candidates"]), lambda c: _contains(c, px, py))
        hits.append(F.get(holding, F.lit(0))["zone_id"])
    lowest = hits[0] if len(hits) == 1 else F.least(*hits)
    return found.withColumn(name, lowest).select(*[f"`{c}`" for c in points.columns], f"`{name}`")


def station_zones(
    rides: DataFrame, zones: DataFrame, start: Sequence[str], end: Sequence[str], clock: str
) -> DataFrame:
    """The station dimension with its zone; stations outside all zones are dropped."""
    stations = station_dimension(rides, start, end, clock)
    return with_zone(stations, zones, name="Taxi area code").na.drop()
