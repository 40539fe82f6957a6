"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut into two halves, each quantised by its own codebook; an entry
lies in the cell of its two codewords. A query visits cells in the order of
their summed distance (the negative inner product of each half with its
codeword) by a heap over pairs, until the visited cells hold enough entries,
and the entries of those cells are ranked again by the exact inner product.

* Codebooks are fitted on at most ``sample`` vectors (those with the smallest
  hash of their id), every vector is indexed.
* "Enough" is calibrated: for up to ``probes`` queries the true neighbours are
  found by brute force over all entries, and the number of entries to visit is
  the smallest that finds ``recall`` of them. On data without structure this
  is a large share of all entries; on clustered data it is small.
* Work is dealt by (entry block, query block), both of a bounded size: cells in
  order are cut into blocks of entries (a large cell into several), a query
  goes, with its cells there, only to blocks that hold entries of its cells,
  and each block returns each query's best.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import pick
from candlewick.session import cut_lineage, ship_package

CODEWORDS, SAMPLE, PROBES, RECALL = 64, 8192, 64, 0.95
SHARDS, BLOCK_ENTRIES, BLOCK_QUERIES, QUERY_STEP = 8, 20_000, 20_000, 256
TRAVERSALS = 2_000  # queries a task traverses
PLAN_ROWS = 2048  # rows of a query's vector and cells sent on at a time
NEAR = 1e-9  # scores this close are computed again row by row before ranking


def kmeans(points: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """Codewords of ``points`` (at least one)."""
    points = np.unique(points, axis=0)
    k = min(k, len(points))
    words = points[np.random.default_rng(seed).choice(len(points), k, replace=False)]
    for _ in range(rounds):
        near = nearest(points, words)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(words)
        np.add.at(sums, near, points)
        words = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], words)
    return words


def nearest(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words * words).sum(1) - 2 * points @ words.T, axis=1)


class Codebook:
    def __init__(self, points: np.ndarray, k: int = CODEWORDS):
        self.half = points.shape[1] // 2 or 1
        self.first, self.second = kmeans(points[:, : self.half], k), kmeans(points[:, self.half :], k)

    def cells(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return nearest(points[:, : self.half], self.first), nearest(points[:, self.half :], self.second)

    def traverse(self, query: np.ndarray) -> Iterator[tuple[int, int]]:
        """Cells by rising summed distance: a heap holds the next pair of each
        row of the sorted distance table that may come next."""
        one, two = -(self.first @ query[: self.half]), -(self.second @ query[self.half :])
        by_one, by_two = np.argsort(one, kind="stable").tolist(), np.argsort(two, kind="stable").tolist()
        one, two = np.sort(one).tolist(), np.sort(two).tolist()
        heap = [(one[0] + two[0], 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            yield by_one[i], by_two[j]
            if j + 1 < len(two):
                heapq.heappush(heap, (one[i] + two[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(one):
                heapq.heappush(heap, (one[i + 1] + two[0], i + 1, 0))


def top_rows(entries: np.ndarray, ids: np.ndarray, query: np.ndarray, rough: np.ndarray, k: int, own) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact scores of the ``k`` best rows with a finite rough score,
    the query's own id left out, ties to the smaller id."""
    able = np.flatnonzero((rough > -np.inf) & (ids != own))
    if len(able) > k:
        cut = np.partition(rough[able], len(able) - k)[len(able) - k]
        able = able[rough[able] >= cut - NEAR * (1 + abs(cut))]
    exact = (entries[able] * query).sum(1)
    order = np.lexsort((ids[able], -exact))[:k]
    return ids[able][order], exact[order]


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    raw = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return raw.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v`` (doubles) of the rows that take part: rows with a null id or
    vector, null or non-finite components, or only zeros do not."""
    rows = pick(vectors, id_col, vector_col).toDF("vec_id", "v").select(F.col("vec_id").cast("long"), F.col("v").cast("array<double>").alias("v"))
    return rows.where(
        F.col("vec_id").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )


def search_block(
    points: np.ndarray, ids: np.ndarray, cell: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, cells: np.ndarray, cuts: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Each query's best ``k`` entries of a block among its cells (query n has
    ``cells[cuts[n]:cuts[n + 1]]``): query ids, entry ids, exact scores; and the
    number of entries that were multiplied, which are those of visited cells."""
    order = np.argsort(cell, kind="stable")
    points, ids, cell = points[order], ids[order], cell[order]
    kinds, begin = np.unique(cell, return_index=True)
    end, scored = np.append(begin[1:], len(cell)), 0
    out: list[tuple[np.ndarray, ...]] = []
    for start in range(0, len(query_ids), QUERY_STEP):
        some = slice(start, min(start + QUERY_STEP, len(query_ids)))
        n = some.stop - start
        asked = cells[cuts[start] : cuts[some.stop]]
        who = np.repeat(np.arange(n), np.diff(cuts[start : some.stop + 1]))
        place = np.searchsorted(kinds, asked)
        held = (place < len(kinds)) & (kinds[np.minimum(place, len(kinds) - 1)] == asked)
        who, place = who[held], place[held]
        by_cell = np.argsort(place, kind="stable")
        who, place = who[by_cell], place[by_cell]
        rough = np.full((n, len(ids)), -np.inf)
        each, at = np.unique(place, return_index=True)
        for c, low, high in zip(each.tolist(), at.tolist(), np.append(at[1:], len(place)).tolist()):
            rows = who[low:high]
            rough[rows, begin[c] : end[c]] = queries[start + rows] @ points[begin[c] : end[c]].T
            scored += len(rows) * int(end[c] - begin[c])
        for i in range(n):
            q = query_ids[start + i]
            got, score = top_rows(points, ids, queries[start + i], rough[i], k, q)
            out.append((np.full(len(got), q), got, score))
    parts = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
    return *parts, scored


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    every: int = 20,
    recall: float = RECALL,
    codewords: int = CODEWORDS,
    sample: int = SAMPLE,
    probes: int = PROBES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` entries with the
    largest inner product among those visited, ties to the smaller id.
    ``queries`` (same columns) defaults to the rows whose id is divisible by
    ``every``.

    An entry with the query's own id is no candidate; fewer than ``k``
    candidates are all returned. Repeated rows of an id are entries each; a
    repeated query id is searched once, by its smallest vector. Vectors that are
    null, zero or hold null or non-finite components take no part. Vectors of
    another width have no inner product with a query: each width is indexed
    and searched by itself. Extra columns are ignored, whatever their names. An
    empty table gives an empty result.
    """
    fine = usable_vectors(vectors, id_col, vector_col)
    wanted = fine.where(F.pmod("vec_id", F.lit(every)) == 0) if queries is None else usable_vectors(queries, id_col, vector_col)
    wanted = wanted.groupBy("vec_id").agg(F.min("v").alias("v"))
    widths = sorted(r["w"] for r in fine.select(F.size("v").alias("w")).distinct().collect())  # one, as a rule
    parts = [_search(fine.where(F.size("v") == w), wanted.where(F.size("v") == w), w, k, recall, codewords, sample, probes) for w in widths]
    if not parts:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found


def _search(fine: DataFrame, wanted: DataFrame, width: int, k: int, recall: float, codewords: int, sample: int, probes: int) -> DataFrame:
    """``nearest_neighbours`` of ``wanted`` among the vectors of one width."""
    spark = fine.sparkSession
    ship_package(spark)
    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    fit = fine.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).collect()  # a bounded top-k, not a sort
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    book = spark.sparkContext.broadcast(Codebook(np.array([r["v"] for r in fit]), codewords))

    def index(batches):
        for batch in batches:
            if batch.num_rows:
                one, two = book.value.cells(_matrix(batch.column("v"), width))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(one.astype(np.int32)), pa.array(two.astype(np.int32))], names=["vec_id", "v", "one", "two"]
                )

    entries = cut_lineage(fine.mapInArrow(index, "vec_id long, v array<double>, one int, two int"), "multi-index")
    sizes = {(r["one"], r["two"]): r["n"] for r in entries.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).collect()}  # codewords^2
    wanted = cut_lineage(wanted, "multi-index-queries")
    enough = calibrated(entries, wanted, book.value, sizes, width, k, recall, probes)
    dealt, asked = deal(entries, wanted, book, sizes, enough, width)

    def rerank(own: pa.Table, queries_: pa.Table) -> pa.Table:
        if not own.num_rows or not queries_.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        lists = queries_.column("cells").combine_chunks()
        asked, cuts = lists.flatten().to_numpy(), np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
        got = search_block(
            _matrix(own.column("v"), width), own.column("vec_id").to_numpy(), own.column("cell").to_numpy(),
            _matrix(queries_.column("q"), width), queries_.column("query_id").to_numpy(), asked, cuts, k,
        )
        return pa.table({"query_id": got[0], "vec_id": got[1], "score": got[2]})

    both = ("block", "query_block")
    found = dealt.groupBy(*both).cogroup(asked.groupBy(*both)).applyInArrow(rerank, schema)
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def deal(entries: DataFrame, wanted: DataFrame, book, sizes: dict, enough: int, width: int) -> tuple[DataFrame, DataFrame]:
    """Entries (``block, query_block, vec_id, v, cell``) and queries (``block,
    query_block, query_id, cells, q``) of each group of work: about
    ``BLOCK_ENTRIES`` entries and ``BLOCK_QUERIES`` queries at most. Cells lie
    in order on a line of all entries that is cut into blocks of equal length;
    a cell's entries are spread over its part of the line by their id's hash."""
    spark = entries.sparkSession
    total, plan_rows = sum(sizes.values()), PLAN_ROWS
    length = -(-total // (SHARDS * max(1, -(-total // (SHARDS * BLOCK_ENTRIES)))))
    query_blocks = max(1, -(-wanted.count() // BLOCK_QUERIES))
    line, before = {}, 0
    for cell, n in sorted(sizes.items()):
        line[cell] = (before, n)
        before += n
    shared = spark.sparkContext.broadcast((line, enough))

    def plan(batches):
        held, visit = shared.value
        for batch in batches:
            points = _matrix(batch.column("v"), width)
            ids, blocks, groups, masks, rows = [], [], [], [], []

            def sent():
                return pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(blocks, pa.int32()), pa.array(groups, pa.int32()), pa.array(masks, pa.list_(pa.int32())), batch.column("v").take(pa.array(rows))],
                    names=["query_id", "block", "query_block", "cells", "q"],
                )

            for n, (q, group, point) in enumerate(zip(batch.column("vec_id").to_pylist(), batch.column("query_block").to_pylist(), points)):
                seen, left = {}, visit
                for one, two in book.value.traverse(point):
                    start, size = held.get((one, two), (0, 0))
                    if size:
                        for block in range(start // length, (start + size - 1) // length + 1):
                            seen.setdefault(block, []).append(one << 16 | two)
                        left -= size
                        if left <= 0:
                            break
                for block, cells in seen.items():
                    ids.append(q), blocks.append(block), groups.append(group), masks.append(cells), rows.append(n)
                    if len(ids) == plan_rows:
                        yield sent()
                        ids, blocks, groups, masks, rows = [], [], [], [], []
            if ids:
                yield sent()

    by_hash = F.xxhash64("vec_id")
    # the traversals are dealt out: the queries' table may be one small file
    spread = max(spark.sparkContext.defaultParallelism, query_blocks * max(1, BLOCK_QUERIES // TRAVERSALS))
    some = wanted.select("vec_id", "v", F.pmod(by_hash, F.lit(query_blocks)).cast("int").alias("query_block")).repartition(spread, "vec_id")
    asked = some.mapInArrow(plan, "query_id long, block int, query_block int, cells array<int>, q array<double>")
    lines = spark.createDataFrame([(one << 16 | two, start, n) for (one, two), (start, n) in line.items()], "cell int, start long, n long")
    block = F.floor((F.col("start") + F.pmod(by_hash, F.col("n"))) / F.lit(length)).cast("int")
    placed = entries.withColumn("cell", F.shiftleft("one", 16).bitwiseOR(F.col("two"))).join(F.broadcast(lines), "cell")  # codewords^2 rows
    every_group = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    return placed.select("vec_id", "v", "cell", block.alias("block"), every_group.alias("query_block")), asked


def brute_force(entries: DataFrame, points: list[tuple[int, np.ndarray]], width: int, k: int) -> DataFrame:
    """``query_id, vec_id, score, one, two``: the exact ``k`` best of a few
    queries over all entries, block by block."""
    ids = [i for i, _ in points]
    matrix = np.array([p for _, p in points]).reshape(-1, width)

    def best(batches):
        for batch in batches:
            own, rows = _matrix(batch.column("v"), width), batch.column("vec_id").to_numpy()
            rough = matrix @ own.T
            for n, q in enumerate(ids):
                able = np.flatnonzero(rows != q)
                exact = (own[able] * matrix[n]).sum(1) if len(able) <= k else rough[n][able]
                top = able[np.lexsort((rows[able], -exact))[:k]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(top), q)), pa.array(rows[top]), pa.array((own[top] * matrix[n]).sum(1)), *(batch.column(c).take(pa.array(top)) for c in ("one", "two"))],
                    names=["query_id", "vec_id", "score", "one", "two"],
                )

    found = entries.mapInArrow(best, "query_id long, vec_id long, score double, one int, two int")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def calibrated(entries, wanted, book: Codebook, sizes: dict, width: int, k: int, recall: float, probes: int) -> int:
    """How many entries a query visits: the smallest number that finds
    ``recall`` of the true neighbours of up to ``probes`` queries (those with
    the smallest hash)."""
    rows = wanted.orderBy(F.xxhash64("vec_id"), "vec_id").limit(probes).collect()
    points = [(r["vec_id"], np.array(r["v"])) for r in rows]
    if not points:
        return 0
    true: dict[int, list[tuple[int, int]]] = {}
    for r in brute_force(entries, points, width, k).select("query_id", "one", "two").collect():
        true.setdefault(r["query_id"], []).append((r["one"], r["two"]))
    needed: list[int] = []
    for q, point in points:
        left, visited = list(true.get(q, [])), 0
        for cell in book.traverse(point):
            if not left:
                break
            visited += sizes.get(cell, 0)
            needed += [visited] * left.count(cell)
            left = [c for c in left if c != cell]
    if not needed:
        return k + 1
    needed.sort()
    return max(k + 1, needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)])
