import random

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from wayfare.models import cells, descent, features, fits, perceptron, statistics
from wayfare.models.tails import f_upper_tail


def test_encoder_of_a_small_table(spark):
    """Index by falling frequency, ties by text, last level without a slot."""
    rows = [(0, "q"), (1, "m"), (2, "q"), (3, "x"), (4, "m"), (5, "k"), (6, "m"), (7, "q"), (8, "x")]
    df = spark.createDataFrame(rows, "id int, category string").withColumns(
        {"weight": F.lit(1.0), "wind": F.col("id").cast("double")}
    )
    encoder = features.fit_encoder(df, "true", ["category"], ["wind"])
    assert encoder.levels == {"category": ["m", "q", "x", "k"]}
    encoded = features.Encoder(encoder.levels, encoder.scales, ()).transform(df)
    got = {r["id"]: list(r["v"])[:3] for r in encoded.select("id", vector_to_array("features").alias("v")).collect()}
    slots = {"m": [1, 0, 0], "q": [0, 1, 0], "x": [0, 0, 1], "k": [0, 0, 0]}
    assert got == {i: slots[c] for i, c in rows}
    assert encoder.scales["wind"][1] == pytest.approx(np.std(range(9), ddof=1))


def test_levels_count_training_rows_only(spark):
    df = spark.createDataFrame(
        [("x", 1.0, "test"), ("x", 5.0, "test"), ("y", 1.0, "train"), ("z", 2.0, "train")],
        "c string, weight double, split string",
    )
    rows = features.index_levels(cells.category_levels(df, ["c"], "split = 'train'")).orderBy("index").collect()
    assert [(r["value"], r["weight"], r["slot"]) for r in rows] == [("z", 2.0, 0), ("y", 1.0, 1), ("x", 0.0, None)]


@pytest.fixture(scope="module")
def weighted(spark):
    rng = random.Random(3)
    rows = []
    for i in range(40):
        for _ in range(rng.randrange(1, 9)):
            rows.append((i, float(i % 5), rng.gauss(i, 4)))
    return spark.createDataFrame(rows, "k int, x double, y double")


def test_cell_metrics_equal_row_metrics(weighted):
    predicted = F.col("x") * 3 + 10
    rows = weighted.withColumn("prediction", predicted)
    table = cells.label_cells(weighted, "y", ["k", "x"]).withColumn("prediction", predicted)
    got = fits.regression_metrics(table).first()
    for name in ("rmse", "r2"):
        expected = RegressionEvaluator(labelCol="y", metricName=name).evaluate(rows)
        assert got[name] == pytest.approx(expected)
    assert got["naive_rmse"] == pytest.approx(weighted.agg(F.stddev_samp("y")).first()[0])


def test_class_metrics_equal_spark(spark):
    rows = [(0.0, 0.0, 5), (0.0, 1.0, 2), (1.0, 0.0, 1), (1.0, 1.0, 7)]
    table = spark.createDataFrame(rows, "label double, prediction double, weight int")
    single = table.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("weight"))))
    got = fits.class_metrics(fits.confusion(table.withColumn("weight", F.col("weight").cast("double")))).first()
    for column, metric in (
        ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"),
        ("accuracy", "accuracy"),
    ):
        assert got[column] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(single))


def test_confusion_keeps_both_columns(spark):
    table = spark.createDataFrame([(1.0, 1.0, 2.0)], "label double, prediction double, weight double")
    assert tuple(fits.confusion(table).first()) == (1, 0.0, 2.0)


@pytest.fixture(scope="module")
def classed(spark):
    """Weighted cells of two classes that overlap, with dense and sparse feature rows."""
    rng = np.random.default_rng(6)
    rows = []
    for k in range(120):
        x = [float(rng.integers(0, 4)), 0.0, float(rng.normal()), 1.0 if k % 3 else 0.0]
        label = float(rng.random() < 1 / (1 + np.exp(-(x[0] - 1.5 + x[2] * x[3]))))
        vector = Vectors.dense(x) if k % 2 else Vectors.sparse(4, [(i, v) for i, v in enumerate(x) if v])
        rows.append((vector, label, float(rng.integers(0, 6))))
    return spark.createDataFrame(rows, ["features", "label", "weight"])


def _repeated(cells):
    each = F.sequence(F.lit(1), F.col("weight").cast("int"))
    return cells.filter("weight > 0").withColumn("i", F.explode(each)).select("features", "label")


def test_gradient_of_a_block():
    rng = np.random.default_rng(2)
    layers, rows = [3, 4, 3], rng.normal(size=(9, 3))
    labels, weights = rng.integers(0, 3, 9), rng.uniform(0, 3, 9)
    place = perceptron.starting_parameters(layers, 1) + 0.1
    _, gradient = perceptron.block_loss(layers, place, rows, labels, weights)
    for k in range(len(place)):
        step = np.zeros(len(place))
        step[k] = 1e-6
        high, low = (perceptron.block_loss(layers, place + s, rows, labels, weights)[0] for s in (step, -step))
        assert gradient[k] == pytest.approx((high - low) / 2e-6, rel=1e-4, abs=1e-5)


def test_weights_count_as_repeated_rows(classed):
    layers = [4, 5, 2]
    place = perceptron.starting_parameters(layers, 3)
    single = _repeated(classed).withColumn("weight", F.lit(1.0))
    loss, gradient = perceptron.total_loss(perceptron.packed_blocks(classed), layers, place)
    many_loss, many = perceptron.total_loss(perceptron.packed_blocks(single), layers, place)
    assert loss == pytest.approx(many_loss) and np.allclose(gradient, many)
    assert len(gradient) == perceptron.parameter_count(layers)


@pytest.mark.parametrize("layers, iterations", [([4, 2], 200), ([4, 3, 2], 40)])
def test_fit_equals_sparks_fit_of_repeated_rows(classed, layers, iterations):
    """Without a hidden layer there is one minimum: the same loss and scores. With one, the loss gets no
    higher than that of Spark's fit from the same start."""
    start = perceptron.starting_parameters(layers, 5)
    own = perceptron.fit_perceptron(classed, layers, iterations, start=start, tolerance=1e-9)
    spark_fit = MultilayerPerceptronClassifier(
        layers=layers, maxIter=iterations, tol=1e-9, initialWeights=Vectors.dense(start)
    ).fit(_repeated(classed))
    blocks = perceptron.packed_blocks(classed)
    first, *losses = (
        perceptron.total_loss(blocks, layers, place)[0]
        for place in (start, own.weights.toArray(), spark_fit.weights.toArray())
    )
    assert losses[0] < first and losses[0] <= losses[1] * 1.01
    rows = own.transform(classed).select("probability", "label", "weight").collect()
    shown = sum(-np.log(r["probability"][int(r["label"])]) * r["weight"] for r in rows) / sum(r["weight"] for r in rows)
    assert shown == pytest.approx(losses[0])  # the model that scores is the one that was fitted
    if len(layers) == 2:
        assert losses[0] == pytest.approx(losses[1], rel=5e-3)
        theirs = spark_fit.transform(classed).select("probability").collect()
        gaps = [abs(a["probability"][1] - b["probability"][1]) for a, b in zip(rows, theirs)]
        assert np.mean(gaps) < 0.02


def test_no_training_rows(classed):
    with pytest.raises(ValueError):
        perceptron.fit_perceptron(classed.filter("weight > 99"), [4, 2], 3)


def test_minimum_of_a_narrow_valley():
    def valley(x):
        a, b = 1 - x[0], x[1] - x[0] ** 2
        return a * a + 100 * b * b, np.array([-2 * a - 400 * x[0] * b, 200 * b])

    place, values = descent.minimise(valley, np.array([-1.2, 1.0]), 200, 1e-14)
    assert np.allclose(place, 1, atol=1e-4) and values == sorted(values, reverse=True)


def test_fits_on_cells_equal_fits_on_rows(weighted):
    """The claim behind training on cells: same model as on the single rows."""
    from pyspark.ml.feature import VectorAssembler

    assembler = VectorAssembler(inputCols=["k", "x"], outputCol="features")
    positive = weighted.withColumn("y", F.abs("y") + 1)
    table = assembler.transform(cells.label_cells(positive, "y", ["k", "x"]))
    rows = assembler.transform(positive).select("features", F.col("y").alias("label"), F.lit(1.0).alias("weight"))

    def predictions(model):
        return [r["prediction"] for r in model.transform(table).orderBy("k").collect()]

    boosted = lambda frame: predictions(fits.fit_boosted(frame, iterations=5, depth=3))
    assert boosted(table) == pytest.approx(boosted(rows))
    linear = lambda frame: predictions(fits.fit_log_linear(frame))
    assert linear(table) == pytest.approx(linear(rows), rel=1e-3)


def test_error_by_weekday_is_long_and_absolute(spark):
    table = spark.createDataFrame(
        [(3, 2, -10.0, 5.0, 1.0), (3, 2, -20.0, 5.0, 3.0), (4, 6, 1.0, 1.0, 1.0)],
        "month int, day_of_week int, prediction double, label double, weight double",
    )
    got = {(r["days"], r["hue"]): r["avg"] for r in fits.error_by_weekday(table, month=3).collect()}
    assert got == {("Monday", "Prediction"): 17.5, ("Monday", "Actual"): 5.0}


@pytest.mark.parametrize(
    "f, df, error_df, p",
    [(4.9646, 1, 10, 0.05), (3.3258, 5, 10, 0.05), (1.0, 7, 7, 0.5), (0.0, 3, 9, 1.0), (6.6349, 1, 10**7, 0.01)],
)
def test_f_tail_at_table_values(f, df, error_df, p):
    assert f_upper_tail(f, df, error_df) == pytest.approx(p, rel=2e-4)


def _sse(columns, y):
    x = np.column_stack([np.ones(len(y)), *columns])
    fitted = x @ np.linalg.lstsq(x, y, rcond=None)[0]
    return float(((y - fitted) ** 2).sum()), np.linalg.matrix_rank(x)


def test_anova_equals_least_squares(spark):
    rng = np.random.default_rng(5)
    n = 400
    a, b = rng.integers(0, 6, n).astype(float), rng.integers(0, 4, n).astype(float)
    zone, day = rng.integers(0, 3, n), rng.integers(0, 4, n)
    y = 2 * a + 0.3 * b + 1.5 * (zone == 1) + rng.normal(0, 2, n)
    rows = [(float(a[i]), float(b[i]), float(a[i] + 2 * b[i]), int(zone[i]), int(day[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, ab double, zone int, day int, y double")
    got = {
        r["term"]: r
        for r in statistics.anova_type2(cells.label_cells(df, "y", ["a", "b", "zone", "day"]), ["a", "b"], ["zone", "day"]).collect()
    }
    groups = {
        "a": [a],
        "b": [b],
        "zone": [(zone == 1) * 1.0, (zone == 2) * 1.0],
        "day": [(day == i) * 1.0 for i in (1, 2, 3)],
    }
    full, rank = _sse([c for g in groups.values() for c in g], y)
    assert got["Residual"]["sum_sq"] == pytest.approx(full) and got["Residual"]["df"] == n - rank
    for term, group in groups.items():
        reduced, reduced_rank = _sse([c for t, g in groups.items() if t != term for c in g], y)
        assert got[term]["df"] == rank - reduced_rank == len(group)
        assert got[term]["sum_sq"] == pytest.approx(reduced - full, rel=1e-6, abs=1e-6)
        expected_f = (reduced - full) / len(group) / (full / (n - rank))
        assert got[term]["f"] == pytest.approx(expected_f, rel=1e-6, abs=1e-8)
    assert got["a"]["p_value"] < 1e-10

    aliased = statistics.anova_type2(cells.label_cells(df, "y", ["a", "b", "ab"]), ["a", "b", "ab"])
    assert {r["term"]: r["df"] for r in aliased.collect()} == {"a": 0, "b": 0, "ab": 0, "Residual": n - 3}


@pytest.mark.parametrize("true", [3.0, -3.0])
def test_boxcox_finds_a_lambda_beyond_the_first_interval(spark, true):
    rng = np.random.default_rng(4)
    values = rng.normal(40, 6, 20_000) if true > 0 else rng.normal(2e-3, 2e-4, 20_000)
    x = np.abs(values) ** (1 / true)
    counts = spark.createDataFrame([(float(v), 1) for v in x], "value double, n long")
    assert statistics.boxcox_lambda(counts).first()["lambda"] == pytest.approx(true, abs=0.4)


def test_boxcox_of_a_narrow_range(spark):
    x = np.random.default_rng(5).uniform(10_000, 10_799, 3000).astype(int).astype(float)
    counts = spark.createDataFrame([(float(v), 1) for v in x], "value double, n long")
    best = statistics.boxcox_lambda(counts).first()
    z = np.log(x) - np.log(x).mean()

    def llf(lam):
        return -len(x) / 2 * np.log((z if lam == 0 else np.expm1(lam * z) / lam).var())

    assert llf(best["lambda"]) >= max(llf(g) for g in np.arange(-20, 20, 0.25)) - 1e-3
    with pytest.raises(ValueError):
        statistics.boxcox_lambda(spark.createDataFrame([(5.0, 9)], "value double, n long"))


def test_boxcox_lambda_of_a_lognormal_is_near_zero(spark):
    rng = np.random.default_rng(1)
    rows = [(int(v),) for v in np.exp(rng.normal(6, 0.6, 4000)) + 1]
    counts = statistics.value_counts(spark.createDataFrame(rows, "d int"), "d")
    best = statistics.boxcox_lambda(counts).first()
    x = np.array([r[0] for r in rows], dtype=float)

    def llf(lam):
        y = np.log(x) if lam == 0 else (x**lam - 1) / lam
        return (lam - 1) * np.log(x).sum() - len(x) / 2 * np.log(y.var())

    assert abs(best["lambda"]) < 0.1
    assert best["llf"] == pytest.approx(llf(best["lambda"]))
    assert best["llf"] >= max(llf(g) for g in np.arange(-1, 1, 0.01)) - 1e-3


def test_quantiles_are_exact(spark):
    rng = random.Random(2)
    values = [rng.randrange(1, 500) for _ in range(777)]
    counts = statistics.value_counts(spark.createDataFrame([(v,) for v in values], "d int"), "d")
    shares = [0.1, 0.5, 0.99]
    got = {r["share"]: r["value"] for r in statistics.exact_quantiles(counts, shares).collect()}
    ordered = sorted(values)
    assert got == {p: ordered[int(np.ceil(p * len(values))) - 1] for p in shares}


def test_quantiles_of_hot_groups_over_many_tasks(spark):
    """A third of the values in one group, ties, and a group of one value; every task holds a range."""
    rng = random.Random(7)
    values = {"hot": [rng.randrange(400) for _ in range(3000)], "one": [5], "few": [1, 1, 2]}
    values |= {f"g{k}": [rng.gauss(0, 9) for _ in range(rng.randrange(1, 90))] for k in range(40)}
    rows = [(g, float(v)) for g, own in values.items() for v in own]
    counts = spark.createDataFrame(rows, "g string, value double").groupBy("g", "value").count().withColumnRenamed("count", "n")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shares = [0.0, 0.25, 0.5, 0.999, 1.0]
        got = {(r["g"], r["share"]): r["value"] for r in statistics.exact_quantiles(counts, shares, ("g",)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    expected = {
        (g, p): sorted(own)[max(int(np.ceil(p * len(own))), 1) - 1] for g, own in values.items() for p in shares
    }
    assert got == expected
    assert statistics.exact_quantiles(counts.filter("false"), shares, ("g",)).collect() == []


def test_correlations_of_shifted_columns(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 3)) @ rng.normal(size=(3, 3)) + 1e9
    rows = [(*map(float, r), 7.0) for r in x] + [(None, 1.0, 1.0, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, same double")
    got = {(r["a"], r["b"]): r["correlation"] for r in statistics.correlation_matrix(df, ["a", "b", "c", "same"]).collect()}
    expected = np.corrcoef(x.T)
    for i, p in enumerate("abc"):
        for j, q in enumerate("abc"):
            assert got[p, q] == pytest.approx(expected[i, j], abs=1e-6)
    assert np.isnan(got["a", "same"]) and np.isnan(got["same", "same"])


def test_components_of_repeated_rows_and_one_column(spark):
    rows = [(1.0, 2.0)] * 30 + [(3.0, 1.0)] * 10 + [(None, 5.0)]
    scored, found = statistics.with_components(spark.createDataFrame(rows, "a double, b double"), ["a", "b"])
    x = np.array(rows[:-1], float)
    assert np.allclose(found.centre, x.mean(0)) and found.explained[0] == pytest.approx(1.0)
    assert scored.count() == 40 and found.loadings[:, 0].max() == pytest.approx(np.abs(found.loadings[:, 0]).max())


def test_large_labels_keep_their_spread(spark):
    """Labels around 1e9 that differ by ones: squares of the labels would lose all of it."""
    rng = random.Random(1)
    rows = [(k % 7, 1e9 * (1 + k % 2) + rng.gauss(0, 1), float(rng.randrange(1, 4))) for k in range(600)]
    df = spark.createDataFrame(rows, "k int, y double, w double")
    for weight in (None, "w"):
        table = cells.label_cells(df, "y", ["k"], weight)
        for r in table.collect():
            y = np.array([x[1] for x in rows if x[0] == r["k"]])
            w = np.array([x[2] if weight else 1.0 for x in rows if x[0] == r["k"]])
            mean = (y * w).sum() / w.sum()
            assert r["within"] == pytest.approx((w * (y - mean) ** 2).sum(), rel=1e-6)
        metrics = fits.regression_metrics(table.withColumn("prediction", F.col("label") + 0.5)).first()
        y = np.array([x[1] for x in rows])
        w = np.array([x[2] if weight else 1.0 for x in rows])
        sst = (w * (y - (y * w).sum() / w.sum()) ** 2).sum()
        assert metrics["naive_rmse"] == pytest.approx((sst / (w.sum() - 1)) ** 0.5, rel=1e-6)
    narrow = df.withColumn("y", F.col("y") - F.col("k") % 2 * 0 - 1e9 * (F.col("y") > 1.5e9).cast("int"))
    one = fits.regression_metrics(cells.label_cells(narrow, "y", ["k"]).withColumn("prediction", F.col("label"))).first()
    y = np.array([x[1] - (1e9 if x[1] > 1.5e9 else 0) for x in rows])
    groups = {k: np.mean([v for x, v in zip(rows, y) if x[0] == k]) for k in range(7)}
    sse = sum((v - groups[x[0]]) ** 2 for x, v in zip(rows, y))
    assert one["r2"] == pytest.approx(1 - sse / ((y - y.mean()) ** 2).sum(), abs=1e-6)


def test_study_models_share_their_sums(spark):
    """Each table equals the one of its own model alone."""
    rng = random.Random(2)
    rows = [(rng.randrange(3), rng.randrange(4), rng.gauss(0, 1), rng.gauss(5, 2)) for _ in range(300)]
    df = spark.createDataFrame(rows, "g int, h int, x double, y double")
    table = cells.label_cells(df, "y", ["g", "h", "x"])
    models = {"all": ["g", "h", "x"], "some": ["x", "h"]}
    found = statistics.anova_models(table, models, ["x"], ["g", "h"]).collect()
    for name, terms in models.items():
        own = [t for t in ("x",) if t in terms], [t for t in ("g", "h") if t in terms]
        alone = {r["term"]: r["sum_sq"] for r in statistics.anova_type2(table, *own).collect()}
        assert {r["term"]: pytest.approx(r["sum_sq"]) for r in found if r["model"] == name} == alone


def test_negative_power_reverses_the_normal_quantile(spark):
    counts = statistics.value_counts(spark.range(1, 1000), "id")
    rows = statistics.normal_quantile_table(counts, -0.2, steps=9).orderBy("normal_quantile").collect()
    samples = [r["sample_quantile"] for r in rows]
    assert samples == sorted(samples) and len(samples) == 9


def test_power_correlations(spark):
    rng = random.Random(4)
    rows = [(rng.uniform(1, 50), rng.uniform(1, 9)) for _ in range(200)]
    got = {r[0]: r[1] for r in statistics.power_correlations(spark.createDataFrame(rows, "x double, y double"), "x", "y").collect()}
    x, y = (np.array(c) for c in zip(*rows))
    for i in (-5, -1, 1, 4):
        assert got[i] == pytest.approx(np.corrcoef(x**0.2, y**i)[0, 1])
    assert got[0] is None
    zero = spark.createDataFrame([*rows, (2.0, 0.0)], "x double, y double")
    with_zero = {r[0]: r[1] for r in statistics.power_correlations(zero, "x", "y").collect()}
    assert np.isnan(with_zero[-1]) and np.isfinite(with_zero[1])


def test_components_equal_the_eigenvectors(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4)) + 5
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double, d double")
    scored, model = statistics.with_components(df, ["a", "b", "c", "d"])
    values, vectors = np.linalg.eigh(np.cov(x.T))
    expected = (x - x.mean(0)) @ vectors[:, ::-1][:, :2]
    got = np.array([[r["pca_a"], r["pca_b"]] for r in scored.orderBy("id").collect()])
    assert np.allclose(np.abs(got), np.abs(expected), atol=1e-8)
    assert np.allclose(model.explained, (values[::-1] / values.sum())[:2])


def test_boxcox_column(spark):
    df = spark.createDataFrame([(4.0,)], "x double")
    assert statistics.boxcox(df, "x", 0.5, "y").first()["y"] == pytest.approx(2.0)
    assert statistics.boxcox(df, "x", 0, "y").first()["y"] == pytest.approx(np.log(4))


def test_summary_of_counts(spark):
    counts = statistics.value_counts(spark.createDataFrame([(1,), (2,), (2,), (9,)], "d int"), "d")
    row = statistics.describe_counts(counts).first()
    assert (row["count"], row["mean"], row["min"], row["max"]) == (4, 3.5, 1, 9)
    assert (row["q25"], row["q50"], row["q75"]) == (1, 2, 2)
    assert row["stddev"] == pytest.approx(np.std([1, 2, 2, 9], ddof=1))
