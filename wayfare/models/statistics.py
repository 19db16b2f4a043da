"""Distribution checks and significance tests over tables."""

from dataclasses import dataclass
from functools import reduce
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from wayfare.models.cells import weighted_scales
from wayfare.models.tails import f_upper_tail
from wayfare.operators.sides import materialise, written_table


#: Grids that a search for lambda tries before it gives up.
WIDEST = 60


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """``value`` and ``n`` per distinct value.

    A bounded duration in whole seconds has at most as many distinct values as the bound, so
    exact statistics of any number of trips can be taken from this small table.
    """
    return (
        rows.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def exact_quantiles(counts: DataFrame, shares: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """For each share the smallest value whose cumulative count reaches it, per group of ``by`` columns.

    ``counts`` has the ``by`` columns, ``value`` and ``n``, each value once per group. The values are
    dealt by range over tasks; the tasks' totals say which of them holds a share's place, and only the
    values of those tasks are added up one by one. So no task meets more than its range of the values,
    and one group may hold most of them.
    """
    groups = list(by)
    dealt = materialise(
        counts.select(*groups, "value", F.col("n").cast("long").alias("n"))
        .repartitionByRange(*groups, "value")
        .withColumn("part", F.spark_partition_id())
    )
    # One row per task and group: few, whatever the table's size.
    line = Window.partitionBy(*groups).orderBy("part")
    totals = dealt.groupBy(*groups, "part").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    everything = F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    points = F.array(*[F.lit(float(p)) for p in shares])
    place = F.greatest(F.ceil(F.col("share") * F.col("total")), F.lit(1))
    owners = (
        totals.select(*groups, "part", "n", upto.alias("upto"), everything.alias("total"))
        .withColumn("share", F.explode(points))
        .withColumn("place", place - (F.col("upto") - F.col("n")))
        .filter((F.col("place") > 0) & (F.col("place") <= F.col("n")))
    )
    wanted = owners.groupBy(*groups, "part").agg(F.collect_list(F.struct("share", "place")).alias("wanted"))
    within = Window.partitionBy(*groups, "part").orderBy("value")
    reached = F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = dealt.join(wanted, [*groups, "part"]).withColumn("reached", reached)
    own = F.filter(
        "wanted", lambda w: (w["place"] <= F.col("reached")) & (w["place"] > F.col("reached") - F.col("n"))
    )
    return found.select(*groups, F.explode(own).alias("own"), "value").select(*groups, "own.share", "value")


def normal_quantile_table(counts: DataFrame, power: float, steps: int = 99) -> DataFrame:
    """Quantiles of value**power beside those of a standard normal.

    A negative power reverses the order, so the share is taken from the other end.
    """
    shares = [i / (steps + 1) for i in range(1, steps + 1)]
    normal = F.create_map(
        *[F.lit(x) for p in shares for x in (p, NormalDist().inv_cdf(p if power > 0 else 1 - p))]
    )
    return exact_quantiles(counts, shares).select(
        "share",
        F.element_at(normal, F.col("share")).alias("normal_quantile"),
        F.pow("value", F.lit(power)).alias("sample_quantile"),
    )


def describe_counts(counts: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles from a value table."""
    counts = materialise(counts)
    v, n = F.col("value").cast("double"), F.col("n")
    size = F.sum(n)
    base = counts.agg(
        size.alias("count"),
        (F.sum(v * n) / size).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    middle = base.select("mean").scalar()
    spread = counts.agg(F.sum(F.pow(v - middle, 2) * n).alias("squares")).scalar()
    deviation = F.sqrt(F.try_divide(spread, F.col("count") - 1))
    names = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    quartiles = materialise(exact_quantiles(counts, list(names)))
    return base.select(
        "count",
        "mean",
        deviation.alias("stddev"),
        "min",
        "max",
        *[
            quartiles.filter(F.col("share") == p).select("value").scalar().alias(name)
            for p, name in names.items()
        ],
    )


def boxcox_profile(counts: DataFrame, grid: list[float]) -> DataFrame:
    """Box-Cox log-likelihood per lambda, for positive values.

    Values are divided by their geometric mean first. That adds the same to every likelihood's
    parts and leaves transformed values near zero, so their variance does not cancel.
    """
    positive = counts.filter(F.col("value") > 0)
    x, n, lam = F.col("value").cast("double"), F.col("n"), F.col("lambda")
    size = F.sum(n)
    middle = positive.agg((F.sum(n * F.log(x)) / size).alias("m")).first()["m"] or 0.0
    z = F.log(x) - F.lit(middle)
    y = F.when(lam == 0, z).otherwise(F.expm1(lam * z) / lam)
    spread = F.sum(n * y * y) / size - F.pow(F.sum(n * y) / size, 2)
    return (
        positive.withColumn("lambda", F.explode(F.array(*[F.lit(float(g)) for g in grid])))
        .groupBy("lambda")
        .agg((-size * F.lit(middle) - size / 2 * F.log(spread)).alias("llf"))
    )


def boxcox_lambda(counts: DataFrame, low: float = -2.0, high: float = 2.0, rounds: int = 3) -> DataFrame:
    """The lambda of the largest likelihood: a grid refined around its best point.

    While the best point is on a border, the interval moves and doubles. Fewer than two distinct
    positive values have no best lambda: an error.
    """
    kept = materialise(counts)
    if kept.filter("value > 0").select("value").distinct().limit(2).count() < 2:
        raise ValueError("the best lambda needs two distinct positive values")
    left, best = rounds, None
    for _ in range(WIDEST):
        step = (high - low) / 80
        grid = [round(low + i * step, 10) for i in range(81)]
        best = boxcox_profile(kept, grid).orderBy(F.desc("llf"), "lambda").limit(1)
        centre = best.first()["lambda"]
        if centre in (grid[0], grid[-1]):
            wide = high - low
            low, high = centre - wide, centre + wide
            continue
        left -= 1
        if not left:
            return best
        low, high = centre - step, centre + step
    raise ValueError("the likelihood has no largest value in reach")


def boxcox(rows: DataFrame, column: str, lam: float, name: str) -> DataFrame:
    x = F.col(column)
    return rows.withColumn(name, F.log(x) if lam == 0 else (F.pow(x, F.lit(lam)) - 1) / lam)


def power_correlations(
    rows: DataFrame, x: str, y: str, powers: range = range(-5, 5), x_power: float = 0.2
) -> DataFrame:
    """Correlation of x**x_power with y**i for each power, in one pass.

    A constant side (power 0) has no correlation: null. An infinite power gives NaN.
    """
    fixed = F.pow(F.col(f"`{x}`"), F.lit(x_power))

    def correlation(i: int):
        power = F.pow(F.col(f"`{y}`"), F.lit(float(i)))
        return F.try_divide(F.covar_pop(fixed, power), F.stddev_pop(fixed) * F.stddev_pop(power))

    one = rows.filter(F.col(f"`{x}`").isNotNull() & F.col(f"`{y}`").isNotNull()).agg(
        *[correlation(i).alias(f"p{i}") for i in powers]
    )
    lines = F.array(
        *[F.struct(F.lit(i).alias("power"), F.col(f"`p{i}`").alias("correlation")) for i in powers]
    )
    return one.select(F.inline(lines))


def correlation_matrix(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlations in long form; rows with nulls are left out, a constant column gives NaN.

    The columns are written once, which also observes their means; one aggregate of sums and products
    of what they differ from these then gives all correlations on its single row.
    """
    numeric = rows.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    seen, size = Observation(), len(columns)
    kept = written_table(numeric.na.drop().observe(seen, *[F.avg(f"x{i}").alias(f"m{i}") for i in range(size)]))
    x = [F.col(f"x{i}") - F.lit(seen.get[f"m{i}"] or 0.0) for i in range(size)]
    upper = [(i, j) for i in range(size) for j in range(i, size)]
    sums = kept.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(x[i]).alias(f"s{i}") for i in range(size)],
        *[F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in upper],
    )
    shared = sums.select(
        *[
            (F.col(f"p{i}_{j}") - F.try_divide(F.col(f"s{i}") * F.col(f"s{j}"), F.col("n"))).alias(f"c{i}_{j}")
            for i, j in upper
        ]
    )

    def correlation(i: int, j: int) -> Column:
        found = F.try_divide(F.col(f"c{i}_{j}"), F.sqrt(F.col(f"c{i}_{i}")) * F.sqrt(F.col(f"c{j}_{j}")))
        return F.when(F.col(f"c{i}_{i}").isNotNull(), F.coalesce(found, F.lit(float("nan"))))

    lines = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), correlation(min(i, j), max(i, j)).alias("correlation"))
            for i, a in enumerate(columns)
            for j, b in enumerate(columns)
        ]
    )
    return shared.select(F.inline(lines))


@dataclass(frozen=True)
class Components:
    """Principal components: the centre, one loading vector per component (column) and the share of the
    whole variance that each explains. A vector's largest loading is positive."""

    columns: tuple[str, ...]
    centre: np.ndarray
    loadings: np.ndarray
    explained: np.ndarray

    def score(self, component: int) -> Column:
        """A row's score as a plain expression of its columns."""
        parts = [
            (F.col(f"`{c}`") - F.lit(float(self.centre[i]))) * F.lit(float(self.loadings[i, component]))
            for i, c in enumerate(self.columns)
        ]
        return reduce(lambda total, part: total + part, parts)


def deviation_products(cells: DataFrame, columns: list[str]) -> tuple[float, np.ndarray, np.ndarray]:
    """Weight, means, and sums of products of deviations from them, over weighted cells.

    Both aggregates have a fixed number of sums, whatever the table's size.
    """
    w, size = F.col("weight"), len(columns)
    first = cells.agg(
        F.sum(w).alias("n"), *[F.sum(F.col(f"`{c}`") * w).alias(f"s{i}") for i, c in enumerate(columns)]
    ).first()
    if not first["n"]:
        raise ValueError("no rows")
    centre = np.array([first[f"s{i}"] / first["n"] for i in range(size)])
    x = [F.col(f"`{c}`") - F.lit(float(m)) for c, m in zip(columns, centre)]
    upper = [(i, j) for i in range(size) for j in range(i, size)]
    found = cells.agg(*[F.sum(x[i] * x[j] * w).alias(f"p{i}_{j}") for i, j in upper]).first()
    products = np.zeros((size, size))
    for (i, j), value in zip(upper, found):
        products[i, j] = products[j, i] = value
    return float(first["n"]), centre, products


def principal_components(rows: DataFrame, columns: list[str], k: int = 2) -> Components:
    """The first components of the covariance of complete rows.

    Rows that agree in all columns, such as the trips of one hour, are counted as one weighted cell
    first, so what is added up grows with the distinct rows.
    """
    numeric = rows.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]).na.drop()
    counted = numeric.groupBy(*[f"`{c}`" for c in columns]).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    _, centre, products = deviation_products(materialise(counted), columns)
    values, vectors = np.linalg.eigh(products)
    values, vectors = values[::-1], vectors[:, ::-1][:, :k]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    total = values.sum() or 1.0
    return Components(tuple(columns), centre, vectors * np.where(largest < 0, -1.0, 1.0), values[:k] / total)


def with_components(rows: DataFrame, columns: list[str], k: int = 2, names=("pca_a", "pca_b")):
    """Complete rows with their scores on the first components of the centred columns, and the components."""
    complete = rows.na.drop(subset=columns)
    found = principal_components(complete, columns, k)
    return complete.withColumns({name: found.score(i) for i, name in enumerate(names[:k])}), found


@dataclass(frozen=True)
class DesignSums:
    """Weighted products of all design columns, intercept first and label last, with what is left within
    the cells. ``terms`` names each design column's term; the first level of a category is its base."""

    terms: tuple[str, ...]
    products: np.ndarray
    weight: float
    within: float


def design_sums(cells: DataFrame, numeric: list[str], categorical: list[str] = ()) -> DesignSums:
    """The products that every linear model on these columns needs (cells with ``label``, ``weight`` and
    ``within``).

    Numbers meet in one aggregate. A level meets numbers in sums grouped by level, and another level in
    weights grouped by pairs of levels, so no dense design row is ever made; what reaches the driver are
    the products themselves, whose number only grows with the levels.
    """
    kept, numeric, categorical = materialise(cells), list(numeric), list(categorical)
    scales = weighted_scales(kept, [*numeric, "label"])
    named = [f"x{i}" for i in range(len(numeric) + 1)]
    scaled = [
        (F.col(f"`{c}`") - F.lit(scales[c][0])) / F.lit((scales[c][1] or 1.0) if c != "label" else 1.0)
        for c in [*numeric, "label"]
    ]
    levels = [F.col(f"`{c}`").alias(f"g{i}") for i, c in enumerate(categorical)]
    table = kept.select(
        "weight", "within", *[x.cast("double").alias(n) for x, n in zip(scaled, named)], *levels
    )
    w = F.col("weight")
    upper = [(i, j) for i in range(len(named)) for j in range(i, len(named))]
    sums = [F.sum("weight").alias("n"), *[F.sum(F.col(n) * w).alias(n) for n in named]]
    one = table.agg(
        *sums,
        F.sum("within").alias("within"),
        *[F.sum(F.col(named[i]) * F.col(named[j]) * w).alias(f"p{i}_{j}") for i, j in upper],
    ).first()
    # (category, level) of each design column, in order
    by_level, pairs = {}, []
    if categorical:
        groups = [f"g{i}" for i in range(len(categorical))]
        single = table.groupingSets([[g] for g in groups], *groups).agg(F.grouping_id().alias("kind"), *sums)
        for row in single.toLocalIterator():
            i = next(i for i in range(len(groups)) if not row["kind"] >> (len(groups) - 1 - i) & 1)
            by_level[i, row[f"g{i}"]] = row
        both = [[a, b] for k, a in enumerate(groups) for b in groups[k + 1 :]]
        if both:
            pairs = table.groupingSets(both, *groups).agg(F.grouping_id().alias("kind"), F.sum("weight").alias("n"))
    columns = []
    for i in range(len(categorical)):
        own = sorted(level for k, level in by_level if k == i)
        columns += [(i, level) for level in own[1:]]
    first = 1 + len(numeric)
    place = {key: first + k for k, key in enumerate(columns)}
    size = first + len(columns) + 1
    products = np.zeros((size, size))

    def put(i: int, j: int, value: float) -> None:
        products[i, j] = products[j, i] = value

    at = [*range(1, len(numeric) + 1), size - 1]  # where the numbers and the label stand
    put(0, 0, one["n"] or 0.0)
    for k, name in enumerate(named):
        put(0, at[k], one[name] or 0.0)
    for i, j in upper:
        put(at[i], at[j], one[f"p{i}_{j}"] or 0.0)
    for key, k in place.items():
        row = by_level[key]
        put(0, k, row["n"])
        put(k, k, row["n"])
        for m, name in enumerate(named):
            put(at[m], k, row[name])
    if pairs:
        for row in pairs.toLocalIterator():
            i, j = (i for i in range(len(categorical)) if not row["kind"] >> (len(categorical) - 1 - i) & 1)
            a, b = place.get((i, row[f"g{i}"])), place.get((j, row[f"g{j}"]))
            if a and b:
                put(a, b, row["n"])
    terms = [*numeric, *[categorical[i] for i, _ in columns]]
    return DesignSums(tuple(terms), products, one["n"] or 0.0, one["within"] or 0.0)


def _residual(gram: np.ndarray, columns: list[int]) -> tuple[float, int]:
    """Residual squares of the label on the columns, and the rank they span."""
    xx, xy = gram[np.ix_(columns, columns)], gram[columns, -1]
    scale = np.sqrt(np.diag(xx))
    scale[scale == 0] = 1.0
    values, vectors = np.linalg.eigh(xx / np.outer(scale, scale))
    used = values > values.max() * 1e-10
    projected = vectors[:, used].T @ (xy / scale)
    return float(gram[-1, -1] - np.sum(projected**2 / values[used])), int(used.sum())


def type2_lines(sums: DesignSums, terms: list[str]) -> list[tuple]:
    """(term, squares, degrees of freedom, F, p) of the model of these terms, the residual last."""
    chosen = [0, *[i for i, t in enumerate(sums.terms, start=1) if t in terms]]
    full, rank = _residual(sums.products, chosen)
    error = full + sums.within
    error_df = sums.weight - rank
    lines = []
    for term in terms:
        others = [i for i in chosen if i == 0 or sums.terms[i - 1] != term]
        reduced, reduced_rank = _residual(sums.products, others)
        df = rank - reduced_rank
        if df == 0:
            lines.append((term, 0.0, 0.0, None, None))
            continue
        squares = max(reduced - full, 0.0)
        f = (squares / df) / (error / error_df)
        lines.append((term, squares, float(df), f, f_upper_tail(f, df, error_df)))
    lines.append(("Residual", error, float(error_df), None, None))
    return lines


TYPE2 = "term string, sum_sq double, df double, f double, p_value double"


def anova_type2(cells: DataFrame, numeric: list[str], categorical: list[str] = ()) -> DataFrame:
    """Type-II table of a linear model on weighted cells (``label``, ``weight``, ``within``).

    Every model's residual follows from the sums of :func:`design_sums`. A term whose columns are linear
    in the others has no degrees of freedom and is listed with nulls instead of a test.
    """
    sums = design_sums(cells, numeric, categorical)
    return cells.sparkSession.createDataFrame(type2_lines(sums, [*numeric, *categorical]), TYPE2)


def anova_models(
    cells: DataFrame, models: dict[str, list[str]], numeric: list[str], categorical: list[str] = ()
) -> DataFrame:
    """Type-II tables of several models of the same label, by name, from one set of sums."""
    sums = design_sums(cells, numeric, categorical)
    lines = [(name, *line) for name, terms in models.items() for line in type2_lines(sums, terms)]
    return cells.sparkSession.createDataFrame(lines, f"model string, {TYPE2}")
