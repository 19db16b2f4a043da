"""Exact top-k by inner product with M-trees: paged metric nodes, searched best first.

Inner products become distances by one more coordinate: x gets sqrt(M^2 - |x|^2), M the largest norm,
and a query gets 0; then d(q, x)^2 = |q|^2 + M^2 - 2 q.x, so nearest is best. Vectors are dealt to the
nearest of a bounded number of pivots; a crowded region is cut into shells by distance from its pivot.
Each part becomes one M-tree of bounded size whose pages are rows. A page's entry stores its vector,
the covering radius of what is below, and its distance to the page's own pivot.

A query searches the tree it lies in first; the score it reaches bounds the search of all others. Only
trees whose root's covering ball it can reach get it. Inside a tree a block of queries descends
together, nearest pages first, and a query passes over an entry without computing its distance if
|d(q, pivot) - d(entry, pivot)| - radius is beyond its bound. Equal vectors are one entry with their
smallest ids, as many as an answer can hold.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.llm import frames
from wayfare.operators.running import with_running

#: Distinct vectors in one tree, about, and entries of a page.
TREE, PAGE = 4096, 32
#: Pivots that vectors are dealt to, at most: a sample of the vectors, sent to all tasks.
PIVOTS = 1024
#: Queries that descend a tree together.
BLOCK = 512
#: Bytes of root vectors that tasks are sent at once; more roots are met in several passes.
ROOT_BYTES = 32 << 20
#: Whole numbers of 8 bytes hold components up to here.
LARGEST = 2.0**62

#: Stands for no floor: every score is above it.
NO_FLOOR = -(1 << 63)

PAGES = (
    "tree long, page int, leaf boolean, vectors binary, radii array<double>, "
    "parents array<double>, children array<int>, ids array<array<long>>, reach double"
)


def quantised(vectors: DataFrame, key: str, value: str, scale: int) -> DataFrame:
    """vec_id and vector (whole numbers, 8 bytes each) of the rows that take part."""

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for vec_id, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if vec_id is None or own is None or any(x is None for x in own):
                    continue
                own = np.array(own, np.float64)
                if not np.isfinite(own).all():
                    continue
                own = np.floor(scale * own)
                if not (np.abs(own) < LARGEST).all():
                    raise OverflowError(f"vector {vec_id}: its products are no longs")
                ids.append(vec_id)
                out.append(own.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "vector"]
            )

    rows = vectors.select(
        F.col(key).cast("long").alias("vec_id"), F.col(value).cast("array<double>").alias("vector")
    )
    return rows.mapInArrow(quantise, "vec_id long, vector binary")


def matrix(column, width: int) -> np.ndarray:
    """Packed vectors as rows; shorter ones are filled up with zeros."""
    out = np.zeros((len(column), width))
    for row, packed in zip(out, column):
        own = np.frombuffer(packed, "<i8")
        row[: len(own)] = own
    return out


def lifted(rows: np.ndarray, largest: float) -> np.ndarray:
    """With the coordinate that makes all norms equal."""
    left = np.maximum(largest - (rows**2).sum(axis=1), 0)
    return np.hstack([rows, np.sqrt(left)[:, None]])


def distances(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - to) ** 2).sum(axis=1))


def built(rows: np.ndarray, largest: float) -> list[dict]:
    """The pages of a tree over the rows; page 0 is the root, whose pivot is row 0.

    An entry is (row, radius, distance to the page's pivot, child page or -1).
    """
    high = lifted(rows, largest)
    pages: list[dict] = []

    def grow(own: np.ndarray, pivot: int) -> int:
        place = len(pages)
        page: dict = {"leaf": len(own) <= PAGE}
        pages.append(page)
        if page["leaf"]:
            page |= {"rows": own, "radii": np.zeros(len(own)), "children": np.full(len(own), -1)}
        else:
            count = min(PAGE, -(-len(own) // PAGE))
            chance = np.random.default_rng(len(own))
            seeds = chance.choice(own, max(2, count), replace=False)
            to_seeds = np.stack([distances(high[own], high[seed]) for seed in seeds])
            nearest = to_seeds.argmin(axis=0)
            if (np.bincount(nearest, minlength=len(seeds)) == len(own)).any():
                nearest = np.arange(len(own)) % len(seeds)  # nothing tells them apart
            radii, children, used = [], [], []
            for k, seed in enumerate(seeds):
                inside = np.flatnonzero(nearest == k)
                if len(inside):
                    used.append(seed)
                    radii.append(to_seeds[k, inside].max())
                    children.append(grow(own[inside], seed))
            page |= {"rows": np.array(used), "radii": np.array(radii), "children": np.array(children)}
        page["parents"] = distances(high[page["rows"]], high[pivot])
        return place

    if len(rows):
        grow(np.arange(len(rows)), 0)
    return pages


class Tree:
    """A tree read from its pages."""

    def __init__(self, pages: pd.DataFrame, width: int, largest: float):
        self.largest = largest
        self.pages = {}
        for page in pages.itertuples():
            exact = np.frombuffer(page.vectors, "<i8").reshape(-1, width)
            self.pages[page.page] = (
                page.leaf, exact, exact.astype(float), np.array(page.radii), np.array(page.parents),
                page.children, page.ids,
            )
        self.computed = 0

    def search(self, queries: np.ndarray, own_ids: list[int], floors: np.ndarray, k: int, home: bool):
        """For each query the k best (-score, id) of at least its floor, ties to smaller ids.

        Queries are rows of whole numbers. A query's own row is no answer where `home` says that it lies
        in this tree. Pages come by the least distance at which any query can still reach them.
        """
        numbers = queries.astype(float)
        norms = (numbers**2).sum(axis=1) + self.largest
        slack = 2e-6 * np.sqrt(norms) + 1e-6
        floors = floors.copy()
        best: list[list[tuple[int, int]]] = [[] for _ in queries]

        def reach(own: np.ndarray, score: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(norms[own] - 2 * score, 0.0)) + slack[own]

        bounds = np.full(len(queries), np.inf)
        known = np.flatnonzero(floors != NO_FLOOR)
        bounds[known] = reach(known, floors[known].astype(float))
        everyone = np.arange(len(queries))
        queue: list = [(0.0, 0, 0, everyone, np.zeros(len(queries)), None)]
        order = 0
        while queue:
            _, _, place, own, lows, to_pivot = heapq.heappop(queue)
            alive = lows <= bounds[own]
            own = own[alive]
            if not len(own):
                continue
            leaf, exact, rows, radii, parents, children, ids = self.pages[place]
            wanted = np.ones((len(own), len(rows)), bool)
            if to_pivot is not None:
                apart = np.abs(to_pivot[alive][:, None] - parents[None, :]) - radii[None, :]
                wanted = apart <= bounds[own][:, None]
            some = np.flatnonzero(wanted.any(axis=0))
            if not len(some):
                continue
            self.computed += int(wanted.sum())
            if not leaf:
                products = numbers[own] @ rows[some].T
                far = np.sqrt(np.maximum(norms[own][:, None] - 2 * products, 0))
                low = np.maximum(far - radii[some][None, :], 0)
                go = wanted[:, some] & (low <= bounds[own][:, None])
                for at, entry in enumerate(some):
                    going = np.flatnonzero(go[:, at])
                    if len(going):
                        order += 1
                        heapq.heappush(
                            queue,
                            (
                                float(low[going, at].min()), order, int(children[entry]),
                                own[going], low[going, at], far[going, at],
                            ),
                        )
                continue
            # Scores that are longs come out right though sums on the way may turn over.
            scores = queries[own] @ exact[some].T
            better = wanted[:, some] & (scores >= floors[own][:, None])
            for at in np.flatnonzero(better.any(axis=1)):
                query = own[at]
                found = best[query]
                for entry in np.flatnonzero(better[at]):
                    score = int(scores[at, entry])
                    if len(found) == k and score < -found[-1][0]:
                        continue
                    left = list(ids[some[entry]])
                    if home and own_ids[query] in left and (exact[some[entry]] == queries[query]).all():
                        left.remove(own_ids[query])
                    found = sorted(found + [(-score, other) for other in left[:k]])[:k]
                best[query] = found
                if len(found) == k:
                    floors[query] = max(floors[query], -found[-1][0])
                    bounds[query] = min(bounds[query], reach(np.array([query]), float(floors[query]))[0])
        return best


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    scale: int = 1024,
    key: str = "vec_id",
    value: str = "embedding",
    tree_size: int = TREE,
) -> DataFrame:
    """The k best rows by inner product for every query: query_id, rank, vec_id, score.

    Components are floor(scale * x). queries are rows of vectors; a query's own row is no candidate.
    Ties go to the smaller id. Null ids, null vectors and vectors with null or non-finite components
    take no part; components of 2**62 and more are an error, as their products are no longs. Vectors of
    other lengths are read with zeros behind them. Fewer candidates give fewer rows, empty tables none.
    Repeated rows are candidates of their own, and as queries they get their answer each. Other columns
    are not read.
    """
    spark = vectors.sparkSession
    frames.importable(spark)
    rows = frames.written(quantised(vectors, key, value, scale))
    asked = quantised(queries, key, value, scale).groupBy("vec_id", "vector")
    asked = frames.written(asked.agg(F.count("*").alias("twins")))
    # Equal vectors: an answer holds at most k of them beside the query itself.
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    distinct = frames.written(
        rows.withColumn("__nth", nth)
        .filter(F.col("__nth") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    width, count = distinct.agg(F.max(F.length("vector")), F.count("*")).first()
    width = (width or 0) // 8
    if not count or not width:
        zero = asked.join(rows.select("vec_id").limit(0), "vec_id")
        return zero.selectExpr("vec_id as query_id", "1 as rank", "vec_id", "0L as score")

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = matrix(batch.column(0).to_pylist(), width)
            yield pa.RecordBatch.from_arrays([pa.array((own**2).sum(axis=1))], names=["n"])

    largest = float(distinct.select("vector").mapInArrow(norms, "n double").agg(F.max("n")).first()[0])
    pivot_count = int(min(PIVOTS, -(-count // tree_size)))
    chosen = distinct.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(pivot_count)
    pivots = spark.sparkContext.broadcast(
        lifted(matrix([bytes(row["vector"]) for row in chosen.collect()], width), largest)
    )

    def region_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = lifted(matrix(batch.column(0).to_pylist(), width), largest)
            far = (pivots.value**2).sum(axis=1)[None, :] - 2 * (own @ pivots.value.T)
            nearest = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(nearest.astype(np.int32)),
                    pa.array(distances(own, pivots.value[nearest]) if len(own) else np.zeros(0)),
                ],
                names=[*batch.schema.names, "region", "far"],
            )

    dealt = distinct.select("vector", "ids").mapInArrow(
        region_of, "vector binary, ids array<long>, region int, far double"
    )
    # Shells of equal size around a region's pivot.
    placed = with_running(dealt, ["region"], ["far", "vector"], {"nth": F.lit(1)})
    shell = F.floor((F.col("nth") - 1) / tree_size)
    dealt = frames.written(
        placed.select("vector", "ids", (F.col("region").cast("long") * (1 << 32) + shell).alias("tree"))
    )

    def build(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("vector", ignore_index=True)
        rows_here = matrix(own["vector"], width)
        high = lifted(rows_here, largest)
        reach = float(distances(high, high[0]).max())
        whole = np.stack([np.frombuffer(v.ljust(8 * width, bytes(1)), "<i8") for v in own["vector"]])
        out = []
        for place, page in enumerate(built(rows_here, largest)):
            at = page["rows"]
            out.append(
                (
                    own["tree"][0], place, page["leaf"], whole[at].tobytes(),
                    page["radii"].tolist(), page["parents"].tolist(), page["children"].tolist(),
                    [list(own["ids"][r]) for r in at] if page["leaf"] else [], reach,
                )
            )
        # The root's pivot, row 0, as a page of its own that no search enters.
        out.append((own["tree"][0], -1, False, whole[:1].tobytes(), [], [], [], [], reach))
        return pd.DataFrame(out, columns=[part.split()[0] for part in PAGES.split(", ")])

    pages = frames.written(dealt.groupBy("tree").applyInPandas(build, PAGES))
    tops = frames.written(pages.filter("page = -1").select("tree", F.col("vectors").alias("pivot"), "reach"))
    pages = pages.filter("page >= 0")
    asked = asked.join(dealt.select("vector", F.col("tree").alias("home")), "vector").withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, asked.count() // BLOCK + 1)))
    )
    asked = frames.written(asked)
    found = "query_id long, vector binary, vec_id long, score long"

    def search(own_pages: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own_pages) and len(own):
            known = Tree(own_pages, width, largest)
            home = bool(own["home"].iloc[0] == own_pages["tree"].iloc[0])
            own_ids = own["vec_id"].tolist()
            for first in range(0, len(own), BLOCK):
                part = own.iloc[first : first + BLOCK]
                asking = np.stack([np.frombuffer(v.ljust(8 * width, bytes(1)), "<i8") for v in part["vector"]])
                floors = part["floor"].to_numpy()
                ids = own_ids[first : first + BLOCK]
                for at, answers in enumerate(known.search(asking, ids, floors, k, home)):
                    vector = part["vector"].iloc[at]
                    out += [(ids[at], vector, other, -score) for score, other in answers]
        return pd.DataFrame(out, columns=[part.split()[0] for part in found.split(", ")])

    # First the tree that the query itself lies in.
    homes = asked.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    ready = asked.join(homes, "home").select(
        "vec_id", "vector", "home", F.col("home").alias("tree"),
        F.pmod(F.xxhash64("vec_id"), F.col("blocks")).alias("block"), F.lit(NO_FLOOR).alias("floor"),
    )
    near = frames.written(meeting(pages, ready, search, found))
    floors = near.groupBy(F.col("query_id").alias("vec_id"), "vector").agg(
        F.min("score").alias("low"), F.count("*").alias("n")
    )
    floors = floors.select("vec_id", "vector", F.when(F.col("n") >= k, F.col("low")).alias("floor"))
    bounded = asked.drop("twins").join(floors, ["vec_id", "vector"], "left")
    bounded = frames.written(bounded.withColumn("floor", F.coalesce("floor", F.lit(NO_FLOOR))))
    others = frames.written(reached_trees(bounded, tops, width, largest))
    far = meeting(pages, others, search, found)
    best = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    merged = near.unionByName(far).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    again = asked.select(F.col("vec_id").alias("query_id"), "vector", F.explode(F.sequence(F.lit(1), F.col("twins").cast("int"))))
    return merged.join(again, ["query_id", "vector"]).selectExpr("query_id", "rank", "vec_id", "score")


def meeting(pages: DataFrame, asked: DataFrame, search, found: str) -> DataFrame:
    """Trees with the blocks of queries that asked for them; a tree is copied for each block."""
    blocks = asked.groupBy(F.col("tree").alias("__tree"), F.col("block").alias("__block")).agg(F.count("*"))
    copies = pages.join(blocks, F.col("tree") == F.col("__tree")).select(
        *pages.columns, F.col("__block").alias("block")
    )
    return copies.groupBy("tree", "block").cogroup(asked.groupBy("tree", "block")).applyInPandas(search, found)


def reached_trees(asked: DataFrame, tops: DataFrame, width: int, largest: float) -> DataFrame:
    """The queries once for each tree but their own whose ball their bound reaches.

    Tasks are sent the roots, some thousandths of the vectors, in passes of bounded size.
    """
    size = 8 * width + 24
    passes = int(tops.count() * size // ROOT_BYTES) + 1
    fields = "vec_id long, vector binary, home long, tree long, block long, floor long"
    out = None
    for k in range(passes):
        part = tops.filter(F.pmod(F.xxhash64("tree"), F.lit(passes)) == k).orderBy("tree").collect()
        if not part:
            continue
        trees = np.array([row["tree"] for row in part], np.int64)
        centres = matrix([bytes(row["pivot"]) for row in part], width)
        radii = np.array([row["reach"] for row in part])
        shared = asked.sparkSession.sparkContext.broadcast((trees, centres, radii))

        def choose(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trees, centres, radii = shared.value
            for batch in frames.shorter(batches, 64):
                vec_ids, vectors, homes, blocks, floors = batch.columns
                numbers = matrix(vectors.to_pylist(), width)
                norms = (numbers**2).sum(axis=1) + largest
                far = np.sqrt(np.maximum(norms[:, None] - 2 * (numbers @ centres.T), 0))
                low = floors.to_numpy(zero_copy_only=False).astype(float)
                reach = np.sqrt(np.maximum(norms - 2 * low, 0)) + 4e-6 * np.sqrt(norms) + 1e-6
                wanted = far - radii[None, :] <= reach[:, None]
                wanted &= homes.to_numpy(zero_copy_only=False)[:, None] != trees[None, :]
                query, tree = np.nonzero(wanted)
                at = pa.array(query)
                yield pa.RecordBatch.from_arrays(
                    [
                        vec_ids.take(at), vectors.take(at), homes.take(at), pa.array(trees[tree]),
                        blocks.take(at), floors.take(at),
                    ],
                    names=["vec_id", "vector", "home", "tree", "block", "floor"],
                )

        own = asked.select("vec_id", "vector", "home", F.col("block").cast("long"), "floor")
        chosen = own.mapInArrow(choose, fields)
        out = chosen if out is None else out.unionByName(chosen)
    return out


SQL = """
WITH kept AS (
    SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]) AS BIGINT) AS score
    FROM kept q JOIN kept c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def op1_m_tree(spark: SparkSession, folder: str) -> DataFrame:
    vectors = frames.table(spark, folder, "embeddings")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
