"""The trie of conversation prefixes, with totals of every subtree by depth-band rollup.

A node is a distinct sequence of first turns, named by a chained digest of them. Depths are cut into
bands of fixed height. Every node is exploded only to its ancestors within its own band, which gives
totals within bands in one grouping. Then, band by band from the deepest, the completed totals of the
nodes on a band's top depth are added to the path of ancestors above them in the next band. So a node
makes at most `height` rows, and there are depth / height rounds, each over band tops only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import frames

#: Least height of a band; deeper tries get the square root of their depth.
HEIGHT = 8
#: Ids hashed from one piece of text of about this many bytes.
PIECE = 1 << 16
#: Parents with more than one in so many of all nodes as children are joined by a copy in every task:
#: there are fewer of them than that.
CROWDED = 2_000

ROOT = bytes(16)

STEPS = (
    "conv_id long, depth long, node binary, parent binary, path array<binary>, size long, last boolean"
)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place from 0, digest of role and text, and UTF-8 bytes of the text.

    Turns are ordered by number (null first), then by role and text. Rows without conv_id are left out.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The length keeps apart what the border between role and text would not.
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.substring(digest, 1, 16).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, place = None, -1
        for batch in batches:
            places = []
            for key in batch.column(0).to_pylist():
                place = place + 1 if key == before else 0
                before = key
                places.append(place)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(places, pa.int64()), batch.column(1), batch.column(2)],
                names=["conv_id", "place", "digest", "size"],
            )

    # A conversation is one row after another in a task, not a group held there.
    in_order = turns.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return in_order.select("conv_id", "digest", "size").mapInArrow(
        numbered, "conv_id long, place long, digest binary, size long"
    )


def rebuilt(turns: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Conversations that begin with another's turns: conv_id, part, place, digest, size.

    The first h turns of c are those of c - c % every, with h a hash of c below `most`; c's own from
    its turn h on follow. A conversation without any turn left has one row with a null place.
    """
    head = F.crc32(F.col("conv_id").cast("string")) % most
    ids = turns.filter("place = 0").select("conv_id").withColumn("head", head)
    # At most most - 1 turns of each lender are kept, whatever its length.
    lent = (
        turns.filter((F.col("conv_id") % every == 0) & (F.col("place") < most - 1))
        .groupBy(F.col("conv_id").alias("lender"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "digest", "size"))).alias("lent"))
    )
    borrowed = (
        ids.withColumn("lender", F.col("conv_id") - F.col("conv_id") % every)
        .join(lent, "lender", "left")
        .select(
            "conv_id",
            F.lit(0).alias("part"),
            F.explode_outer(F.filter("lent", lambda x: x["place"] < F.col("head"))).alias("x"),
        )
        .select("conv_id", "part", "x.place", "x.digest", "x.size")
    )
    own = turns.filter(F.col("place") >= head).select(
        "conv_id", F.lit(1).alias("part"), "place", "digest", "size"
    )
    return borrowed.unionByName(own)


def steps(turns: DataFrame, height: int) -> DataFrame:
    """One row per conversation and depth: the node, its parent, the nodes of its band above it and
    itself (`path`), the bytes of its last text, and whether the conversation ends there.

    For a node on top of a band below the first, `path` ends at its parent and is of the band above.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None
        key, depth, node, path = None, 0, ROOT, [ROOT]
        out: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["conv_id", "depth", "node", "parent", "path", "size", "last"],
            )

        for batch in batches:
            for own, place, digest, size in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if own != key or waiting is None:
                    if waiting:
                        out.append((*waiting, True))
                    key, depth, node, path = own, 0, ROOT, [ROOT]
                    waiting = (own, 0, ROOT, None, [ROOT], 0)
                if place is None:
                    continue  # only says that the conversation exists
                out.append((*waiting, False))
                parent, depth = node, depth + 1
                node = hashlib.sha256(parent + digest).digest()[:16]
                if depth % height:
                    path = [*path, node]
                    waiting = (own, depth, node, parent, path, size)
                else:
                    waiting = (own, depth, node, parent, path, size)
                    path = [node]
            yield batch_of(out)
            out = []
        if waiting:
            yield batch_of([(*waiting, True)])

    in_order = turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return in_order.select("conv_id", "place", "digest", "size").mapInArrow(walk, STEPS)


def listed_hashes(members: DataFrame) -> DataFrame:
    """(node, conv_id) -> node and the SHA-256 of its ids, ascending, joined by commas.

    The ids are dealt by range, so those of one node may lie in many tasks; each makes pieces of text
    of bounded size, and only the pieces of a node are then hashed in order.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, own, length = None, None, [], 0

        def piece():
            return pa.RecordBatch.from_arrays(
                [pa.array([node], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(own)])],
                names=["node", "first", "ids"],
            )

        for batch in batches:
            for key, member in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if own and (key != node or length > PIECE):
                    yield piece()
                    own, length = [], 0
                if not own:
                    node, first = key, member
                own.append(str(member))
                length += len(own[-1]) + 1
        if own:
            yield piece()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    done.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            yield digests(done)
        if state:
            yield digests([(node, state.hexdigest())])

    def digests(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
            names=["node", "ends_sha256"],
        )

    dealt = members.select("node", "conv_id").repartitionByRange("node", "conv_id")
    cut = dealt.sortWithinPartitions("node", "conv_id").mapInArrow(
        pieces, "node binary, first long, ids string"
    )
    return (
        cut.repartition("node")
        .sortWithinPartitions("node", "first")
        .select("node", "ids")
        .mapInArrow(hashed, "node binary, ends_sha256 string")
    )


def subtree_totals(nodes: DataFrame, height: int, deepest: int) -> DataFrame:
    """node, n_leaves, saved_tokens: the sums of `leaf` and `saved` over the node's subtree.

    `nodes` has node, depth, path, leaf and saved, as :func:`steps` names them.
    """
    values = [F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")]
    # A band's top is alone in its band's path; the path it carries is that of the band above.
    own_path = F.when(F.col("depth") % height == 0, F.array("node")).otherwise(F.col("path"))
    within = frames.written(
        nodes.select(F.explode(own_path).alias("node"), "leaf", "saved").groupBy("node").agg(*values)
    )
    parts = [within]
    if deepest >= height:
        tops = frames.written(
            nodes.filter((F.col("depth") % height == 0) & (F.col("depth") > 0))
            .select("node", "depth", "path")
            .join(within, "node")
        )
        above = None  # what the round below added to the nodes of this band
        for band in range(deepest // height, 0, -1):
            completed = tops.filter(F.col("depth") == band * height)
            if above is not None:
                sent = above.select("node", F.col("leaf").alias("more"), F.col("saved").alias("spared"))
                completed = completed.join(sent, "node", "left").select(
                    "path",
                    (F.col("leaf") + F.coalesce("more", F.lit(0))).alias("leaf"),
                    (F.col("saved") + F.coalesce("spared", F.lit(0))).alias("saved"),
                )
            above = frames.written(
                completed.select(F.explode("path").alias("node"), "leaf", "saved").groupBy("node").agg(*values)
            )
            parts.append(above)
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    return everything.groupBy("node").agg(
        F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )


def with_parents(nodes: DataFrame) -> DataFrame:
    """Adds n_children and parent_conv_id. A parent of very many children is not met in one task: it is
    sent to all, which the number of nodes bounds (see CROWDED)."""
    spark = nodes.sparkSession
    children = frames.written(
        nodes.filter("parent is not null")
        .groupBy(F.col("parent").alias("node"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    counted = frames.written(
        nodes.join(children, "node", "left").withColumn(
            "n_children", F.coalesce("n_children", F.lit(0)).cast("long")
        )
    )
    few = max(CROWDED, counted.count() // CROWDED)
    up = counted.filter("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    crowded = up.filter(F.col("n_children") > few).drop("n_children").withColumn("known", F.lit(True))
    marked = counted.join(F.broadcast(crowded), "parent", "left")
    rest = up.filter(F.col("n_children") <= few).select("parent", F.col("parent_conv_id").alias("other"))
    met = marked.filter("known is null and parent is not null").join(rest, "parent")
    return (
        marked.filter("known is not null or parent is null")
        .withColumn("other", F.lit(None).cast("long"))
        .unionByName(met)
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "other"))
        .drop("known", "other")
    )


def trie(turns: DataFrame, height: int | None = None) -> DataFrame:
    """The nodes of the prefix trie of conversations.

    `turns` has conv_id, part, place, digest and size as :func:`rebuilt` gives them, or
    :func:`ordered_turns` with a constant part; a null place only says that the conversation exists.
    One row per node: conv_id (its smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves and saved_tokens (of its subtree, itself included), ends_sha256 (of the members
    that end there), and node, a name of 16 bytes. No conversations give no rows. `height` is that of
    the bands: by default 8, and the square root of the depth where that is more.

    Names are 128-bit digests, so different prefixes are told apart as surely as these.
    """
    turns = frames.written(turns)
    if height is None:
        longest = turns.groupBy("conv_id").agg(F.count("place").alias("n")).agg(F.max("n")).first()[0]
        height = max(HEIGHT, math.isqrt(longest or 0))
    walked = frames.written(steps(turns, height))
    # Which conversation gives the path does not matter: equal nodes have equal paths.
    grouped = walked.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.first("parent").alias("parent"),
        F.first("path").alias("path"),
        F.first("size").alias("size"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min(F.col("last").cast("int")).cast("long").alias("leaf"),
    )
    nodes = frames.written(
        grouped.withColumn("saved", (F.col("n_convs") - 1) * F.col("size"))
    )
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = subtree_totals(nodes.select("node", "depth", "path", "leaf", "saved"), height, deepest)
    ends = listed_hashes(walked.filter("last").select("node", "conv_id"))
    named = with_parents(nodes.select("node", "parent", "conv_id", "depth", "n_convs"))
    return (
        named.join(totals, "node")
        .join(ends, "node", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
            "node",
        )
    )


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = frames.written(ordered_turns(frames.table(spark, folder, "conversations")))
    return trie(rebuilt(turns)).drop("node")


SQL = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT conv_id, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END), 4294967295), 4294967295) % 9 AS head
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT i.conv_id, 0 AS part, t.place, t.role, t.text
    FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 5 AND t.place < i.head
    UNION ALL
    SELECT i.conv_id, 1, t.place, t.role, t.text
    FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.place >= i.head
), named AS (
    SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS size,
        string_agg(md5(strlen(role) || ':' || role || text), '') OVER w AS node
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)
), members AS (
    SELECT conv_id, 0 AS depth, 0 AS size, '' AS node FROM ids
    UNION ALL SELECT conv_id, depth, size, node FROM named
), walked AS (
    SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM members
), nodes AS (
    SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        CASE WHEN bool_and(last) THEN 1 ELSE 0 END AS leaf, (count(*) - 1) * any_value(size) AS saved,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
    FROM walked GROUP BY node
), totals AS (
    SELECT left(node, 32 * above) AS node, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT node, leaf, saved, unnest(range(0, depth + 1)) AS above FROM nodes) GROUP BY 1
), children AS (
    SELECT left(node, 32 * (depth - 1)) AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
    coalesce(c.n_children, 0) AS n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves,
    CAST(t.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON n.node = t.node LEFT JOIN children c ON n.node = c.node
    LEFT JOIN nodes p ON n.depth > 0 AND p.node = left(n.node, 32 * (n.depth - 1))
"""
