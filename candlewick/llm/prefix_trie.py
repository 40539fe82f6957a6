"""Prefix trie of conversations, rolled up by centroid decomposition.

Each distinct sequence of a conversation's first d turns is a node, so
conversations that begin alike share nodes. A node is named by its smallest
member and its depth; a *passage* row says through which node a conversation
goes at a depth.

Building the trie needs no group of a whole conversation: rows are range
partitioned by (conversation, turn), positions are local row numbers plus what
lies before in earlier ranges, and prefixes are told apart by 128 bits of
position-dependent hashes, combined by exclusive or in chunks of a conversation.

Rolling up (sums over subtrees) splits the parent-edge forest at centroids. A
node's weight is the number of passages below it, known without a roll-up; the
centroid of a component is the deepest node that holds over half of its weight.
A component's total below its centroid is aggregated once and added along the
path from the centroid to the component's top; then the centroid goes and the
component falls apart, no part over half of it. So there are at most log2(rows)
rounds however deep the trie is (a chain of a billion turns is halved, not
climbed), each a few equality joins. Components of at most ``local_weight``
passages are finished by the same recursion inside a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import pick
from candlewick.session import cut_lineage, ship_package

LOCAL_WEIGHT = 4096
BUCKET_NODES = 20_000
CHUNK = 4096
ID_RANGE = 4096
#: The rebuilding rule: conversations share the head of the first of each FAMILY, up to HEADS - 1 turns of it.
FAMILY, HEADS = 5, 9


def rebuilt_turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (``conv, depth, total, c1, c2,
    bytes``; ``c1, c2`` hash role and text, ``total`` is the conversation's
    number of turns) and all conversations (``conv, total``)."""
    rows = pick(conversations, conv_col, turn_col, role_col, text_col).toDF("conv", "turn", "role", "text")
    rows = rows.select(
        F.col("conv").cast("long").alias("conv"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("tie"),  # spreads equal rows over ranges
    ).where("conv IS NOT NULL")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("tie")]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(
        rows.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .select(
            "conv",
            F.xxhash64("role", "text").alias("c1"),
            F.xxhash64(F.lit("second"), "text", "role").alias("c2"),
            F.octet_length("text").cast("long").alias("bytes"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "trie-rows",
    )
    # one row per conversation and range that holds some of it
    pieces = placed.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    by_conv = Window.partitionBy("conv").orderBy("part")
    pieces = pieces.withColumn("before", F.sum("n").over(by_conv) - F.col("n"))
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    convs = pieces.groupBy("conv").agg(F.sum("n").alias("own")).withColumn("h", head).withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
    bases = convs.select(F.col("conv").alias("base"), F.col("own").alias("base_own"))
    lead = F.least("h", F.coalesce("base_own", F.lit(0)))
    convs = convs.join(bases, "base", "left").select(
        "conv", "base", "h", lead.alias("lead"), (lead + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("total")
    )
    convs = cut_lineage(convs, "trie-convs")
    pieces = pieces.join(convs, "conv").select("conv", "part", "first", "before", "h", "lead", "total")
    known = placed.join(pieces, ["conv", "part"]).withColumn("pos", F.col("at") - F.col("first") + F.col("before") + 1)
    content = ["c1", "c2", "bytes"]
    own = known.where("pos > h").select("conv", (F.col("lead") + F.col("pos") - F.col("h")).alias("depth"), "total", *content)
    heads = placed.join(pieces, ["conv", "part"]).withColumn("pos", F.col("at") - F.col("first") + F.col("before") + 1)
    heads = heads.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < HEADS)).select(F.col("conv").alias("base"), "pos", *content)
    shared = heads.join(convs, "base").where("pos <= h").select("conv", F.col("pos").alias("depth"), "total", *content)
    return own.unionByName(shared), convs.select("conv", "total")


def passages(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (``conv, depth, parent, n_convs, bytes, weight, n_children``;
    ``parent`` is the parent's conv) and passages (``member, depth, conv,
    parent, last``: the member goes through node (conv, depth))."""
    marked = turns.select(
        "conv", "depth", "total", "bytes",
        F.xxhash64("depth", "c1").alias("e1"), F.xxhash64("c2", "depth").alias("e2"), F.floor((F.col("depth") - 1) / CHUNK).alias("chunk"),
    )
    marked = cut_lineage(marked, "trie-turns")
    inside = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = marked.where(F.col("total") > CHUNK).groupBy("conv", "chunk").agg(F.bit_xor("e1").alias("s1"), F.bit_xor("e2").alias("s2"))
    sums = sums.select("conv", "chunk", F.bit_xor("s1").over(earlier).alias("b1"), F.bit_xor("s2").over(earlier).alias("b2"))
    local = marked.select("*", F.bit_xor("e1").over(inside).alias("i1"), F.bit_xor("e2").over(inside).alias("i2"))
    zero = F.lit(0).cast("long")
    rows = local.join(sums, ["conv", "chunk"], "left").select(
        "conv", "depth", "total", "bytes", "e1", "e2",
        F.col("i1").bitwiseXOR(F.coalesce("b1", zero)).alias("k1"), F.col("i2").bitwiseXOR(F.coalesce("b2", zero)).alias("k2"),
    )
    rows = rows.select(
        "conv", "depth", "total", "bytes", "k1", "k2", F.col("k1").bitwiseXOR(F.col("e1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("e2")).alias("p2")
    )
    tops = convs.select("conv", F.lit(0).cast("long").alias("depth"), "total", *[zero.alias(c) for c in ("bytes", "k1", "k2", "p1", "p2")])
    rows = cut_lineage(rows.withColumn("depth", F.col("depth").cast("long")).unionByName(tops), "trie-prefixes")
    key = ["depth", "k1", "k2"]
    nodes = rows.groupBy(*key).agg(
        F.min("conv").alias("node"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("bytes").alias("bytes"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
        F.sum(F.col("total") - F.col("depth") + 1).alias("weight"),
    )
    nodes = cut_lineage(nodes, "trie-nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("node").alias("parent"))
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    nodes = nodes.join(above, ["depth", "p1", "p2"], "left").join(kids.agg(F.count(F.lit(1)).alias("n_children")), key, "left")
    nodes = cut_lineage(nodes.withColumn("n_children", F.coalesce("n_children", zero)), "trie-nodes")
    through = rows.select(F.col("conv").alias("member"), *key, (F.col("depth") == F.col("total")).alias("last"))
    through = through.join(nodes.select(*key, "node", "parent"), key).select("member", "depth", F.col("node").alias("conv"), "parent", "last")
    return nodes.select(F.col("node").alias("conv"), "depth", "parent", "n_convs", "bytes", "weight", "n_children"), cut_lineage(through, "trie-passages")


def roll_component(nodes: list[int], parent: list[int], own: list[tuple[int, ...]], total: list[list[int]]) -> None:
    """Add subtree sums of ``own`` to ``total`` for one component: ``nodes`` by
    rising depth, the first its top. Splits at centroids until nothing is left."""
    todo = [nodes]
    while todo:
        part = todo.pop()
        inside = set(part)
        size = dict.fromkeys(part, 1)
        for v in reversed(part[1:]):
            size[parent[v]] += size[v]
        centre = [v for v in part if 2 * size[v] > len(part)][-1]
        under = {centre: centre}  # node -> the child of the centroid above it
        groups: dict[int, list[int]] = {}
        rest = []
        for v in part:
            if v == centre:
                continue
            side = under.get(parent[v])
            if side is None:
                rest.append(v)
                continue
            under[v] = v if side == centre else side
            groups.setdefault(under[v], []).append(v)
        add = [sum(s) for s in zip(*(own[v] for v in under))]
        v = centre
        while v in inside:  # along the path to the top
            total[v] = [a + b for a, b in zip(total[v], add)]
            v = parent[v]
        todo.extend(groups.values())
        if rest:
            todo.append(rest)


def roll_up(nodes: DataFrame, through: DataFrame, values: list[str], local_weight: int = LOCAL_WEIGHT, bucket_nodes: int = BUCKET_NODES) -> DataFrame:
    """``nodes`` with each column of ``values`` (longs) replaced by its sum over
    the node's subtree, the node included. ``nodes``: ``conv, depth, parent,
    weight`` and any others; ``through``: passages of their members."""
    spark = nodes.sparkSession
    ship_package(spark)
    carried = [c for c in nodes.columns if c not in values]
    sums = [f"sum_{c}" for c in values]
    root = nodes.where("depth = 0").select("conv", "weight").first()
    if root is None:
        return nodes
    # a component is named by its top; ``held`` is its weight
    placed = [F.lit(root["conv"]).alias("top_conv"), F.lit(0).cast("long").alias("top_depth"), F.lit(root["weight"]).cast("long").alias("held")]
    state = nodes.select(*nodes.columns, *[F.lit(0).cast("long").alias(s) for s in sums], *placed)
    state = cut_lineage(state, "trie-round")
    columns = state.columns
    done: list[DataFrame] = []
    part = ["top_conv", "top_depth"]
    while True:
        done.append(state.where(F.col("held") <= local_weight).withColumn("open", F.lit(True)))
        large = state.where(F.col("held") > local_weight)
        # a component's path of nodes over half of its weight ends in its centroid
        centres = large.where(F.col("weight") * 2 > F.col("held")).groupBy(*part).agg(F.max(F.struct("depth", "conv", "weight")).alias("x"))
        centres = cut_lineage(
            centres.select(*part, F.col("x.conv").alias("x_conv"), F.col("x.depth").alias("x_depth"), F.col("x.weight").alias("x_weight")), "trie-centres"
        )
        if centres.isEmpty():
            break
        # who goes through which child of a centroid: (component, member) -> child
        below = through.join(centres, (F.col("parent") == F.col("x_conv")) & (F.col("depth") == F.col("x_depth") + 1))
        below = below.select(*part, F.col("member").alias("conv"), F.col("conv").alias("child"))
        split = large.join(centres, part).join(below, [*part, "conv"], "left")
        is_centre = (F.col("conv") == F.col("x_conv")) & (F.col("depth") == F.col("x_depth"))
        side = F.when(is_centre, F.lit(0)).when(F.col("child").isNotNull() & (F.col("depth") > F.col("x_depth")), F.lit(1)).otherwise(F.lit(2))
        split = cut_lineage(split.select(*columns, "x_conv", "x_depth", "x_weight", "child", side.alias("side")), "trie-split")
        totals = split.where("side < 2").groupBy(*part, "x_conv", "x_depth", "x_weight").agg(*[F.sum(c).alias(f"t_{c}") for c in values])
        path = through.alias("w").join(
            totals, (F.col("w.member") == F.col("x_conv")) & (F.col("w.depth") >= F.col("top_depth")) & (F.col("w.depth") <= F.col("x_depth"))
        )
        path = path.select(
            F.col("w.conv").alias("conv"), F.col("w.depth").alias("depth"), F.col("x_weight").alias("less"), *[f"t_{c}" for c in values]
        )
        moved = split.join(path, ["conv", "depth"], "left")
        zero = F.lit(0).cast("long")
        lighter = F.when(F.col("side") == 2, F.col("weight") - F.coalesce("less", zero)).otherwise(F.col("weight"))
        moved = moved.select(
            *[c for c in columns if c not in (*part, "weight", "held", *sums)],
            lighter.alias("weight"),
            *[(F.col(s) + F.coalesce(F.col(f"t_{c}"), zero)).alias(s) for s, c in zip(sums, values)],
            F.when(F.col("side") == 1, F.col("child")).otherwise(F.col("top_conv")).alias("top_conv"),
            F.when(F.col("side") == 1, F.col("x_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
            "side",
        )
        moved = cut_lineage(moved, "trie-moved")
        done.append(moved.where("side = 0").withColumn("held", zero).select(*columns, F.lit(False).alias("open")))
        rest = moved.where("side > 0").drop("side")
        held = rest.groupBy(*part).agg(F.max("weight").alias("held"))
        state = cut_lineage(rest.join(held, part).select(*columns), "trie-round")

    everything = done[0]
    for more in done[1:]:
        everything = everything.unionByName(more)
    finished = everything.where("NOT open").select(*carried, *[F.col(s).alias(c) for s, c in zip(sums, values)])
    small = everything.where("open").select(*carried, *values, *sums, *part)
    buckets = max(1, -(-small.count() // bucket_nodes))
    schema = finished.schema

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        whole = pa.Table.from_batches(got)
        col = {c: whole.column(c).to_pylist() for c in ("conv", "depth", "parent", *part, *values, *sums)}
        n = whole.num_rows
        name = {key: i for i, key in enumerate(zip(col["conv"], col["depth"]))}
        parent = [name.get((p, d - 1), -1) for p, d in zip(col["parent"], col["depth"])]
        own, total = list(zip(*(col[c] for c in values))), [list(t) for t in zip(*(col[s] for s in sums))]
        groups: dict[tuple[int, int], list[int]] = {}
        for i in np.argsort(np.array(col["depth"]), kind="stable").tolist():
            groups.setdefault((col["top_conv"][i], col["top_depth"][i]), []).append(i)
        for members in groups.values():
            roll_component(members, parent, own, total)
        arrays = [whole.column(c).combine_chunks() for c in carried]
        arrays += [pa.array([total[i][k] for i in range(n)], pa.int64()) for k in range(len(values))]
        yield from pa.Table.from_arrays(arrays, names=schema.names).to_batches(max_chunksize=10_000)

    return finished.unionByName(small.repartition(buckets, *part).mapInArrow(local, schema))


def end_digests(through: DataFrame) -> DataFrame:
    """``conv, depth, ends_sha256`` of the nodes where conversations end: SHA-256
    of their ids, ascending and comma-joined. Ids are first joined in ranges of
    ``ID_RANGE`` (so no group is larger), the ranges then run through the hash
    in order without being held."""
    ship_package(through.sparkSession)
    ends = through.where("last").select("conv", "depth", "member", F.floor(F.col("member") / ID_RANGE).alias("block"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list("member")), lambda m: m.cast("string")), ",")
    blocks = ends.groupBy("conv", "depth", "block").agg(text.alias("ids"))
    n = int(through.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            convs, depths, shas = [], [], []
            for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv", "depth", "ids"))):
                if now == (conv, depth):
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    convs.append(now[0]), depths.append(now[1]), shas.append(state.hexdigest())
                now, state = (conv, depth), hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(convs, pa.int64()), pa.array(depths, pa.int64()), pa.array(shas, pa.string())], names=names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([state.hexdigest()])], names=names)

    names = ["conv", "depth", "ends_sha256"]
    ordered = blocks.repartition(n, "conv", "depth").sortWithinPartitions("conv", "depth", "block")
    return ordered.mapInArrow(digest, "conv long, depth long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    local_weight: int = LOCAL_WEIGHT,
    bucket_nodes: int = BUCKET_NODES,
) -> DataFrame:
    """Per node of the trie: ``conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns are ordered by turn, a null turn first, equal turns by role and text;
    repeated rows are turns of their own. A null role or text is empty. Rows
    without a conversation id take no part. A long text counts by its bytes and
    is hashed whole. Extra columns are ignored, whatever their names. An empty
    table gives an empty result (there is no conversation to be the root's).
    """
    turns, convs = rebuilt_turns(conversations, conv_col, turn_col, role_col, text_col)
    nodes, through = passages(turns, convs)
    nodes = nodes.withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
    nodes = nodes.withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("bytes")).drop("bytes")
    rolled = roll_up(nodes, through, ["n_leaves", "saved_tokens"], local_weight, bucket_nodes)
    nothing = hashlib.sha256(b"").hexdigest()
    return rolled.join(end_digests(through), ["conv", "depth"], "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
