"""Vector code compression: product codebooks fitted by ball k-means.

Vectors become integers, are cut into ``parts`` equal parts, and each part
position has a codebook fitted by exact Lloyd rounds. The parts assigned to an
entry are its ball: centre (the entry) and radius (the farthest of them). A
round compares as little as the balls allow, and never guesses:

* an entry is a *neighbour* of a ball only if it is nearer than twice the
  radius; no part of the ball can be nearer to any other entry;
* a part within half the distance to the nearest neighbour lies in the *stable
  core* and keeps its entry without any comparison;
* the *annular rings* beyond are bounded by half the distances to the first,
  second, ... neighbour: a part in ring k is compared with the first k
  neighbours only.

All arithmetic is in integers (distances squared, bounds as 4 d^2 against the
squared distance of entries), so bounds are exact and ties go to the lower
index, as in full comparison.

Rounds run over a written table that holds each vector's current codes.
Entry sums, counts and radii are summed inside tasks, then by Spark; only the
codebooks (parts x entries rows, bounded by parameters) pass the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import pick
from candlewick.session import cut_lineage, ship_package

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
STEP_ROWS = 4096


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of ``a`` to each row of ``b``
    (integers; products go through doubles while those hold them exactly)."""
    top = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    exact = 4 * top * top * max(1, a.shape[1]) < 1 << 53
    x, y = (a.astype(float), b.astype(float)) if exact else (a, b)
    return ((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)[None, :]).astype(np.int64)


class Balls:
    """One part position's entries with the balls of the current assignment:
    ``centres`` (entries x width, int64) and squared ``radii`` (-1: empty)."""

    def __init__(self, centres: np.ndarray, radii: np.ndarray):
        self.centres = centres
        gaps = squared(centres, centres)
        np.fill_diagonal(gaps, np.iinfo(np.int64).max)
        self.order = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.order, axis=1)
        #: number of neighbours: entries with distance^2 <= 4 radius^2
        self.neighbours = np.where(radii >= 0, (self.gaps <= 4 * np.maximum(radii, 0)[:, None]).sum(1), 0)

    def reassign(self, points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest entries and squared distances of ``points``, whose entries
        were ``at``; and the number of comparisons with other entries."""
        off = points - self.centres[at]
        own = (off * off).sum(1)
        # ring: how many neighbours are nearer than twice the own distance (0: stable core)
        best, near, compared = at.copy(), own.copy(), 0
        for ball in np.unique(at).tolist():
            rows = np.flatnonzero(at == ball)
            known = self.gaps[ball, : self.neighbours[ball]]
            ring = np.searchsorted(known, 4 * own[rows], side="right")
            outer = np.flatnonzero(ring)
            if not len(outer):
                continue
            rows, ring = rows[outer], ring[outer]
            by_ring = np.argsort(ring, kind="stable")
            rows, ring = rows[by_ring], ring[by_ring]
            # rings of similar reach share one product; each row still sees its own ring's entries only
            for low, high in _bands(ring):
                some, reach = rows[low:high], ring[low:high]
                k = int(reach[-1])
                others = self.order[ball, :k]
                d = squared(points[some], self.centres[others])
                d[np.arange(k)[None, :] >= reach[:, None]] = np.iinfo(np.int64).max
                compared += int(reach.sum())
                least = d.min(1)
                # of the nearest others the lowest index
                first = np.where(d == least[:, None], others[None, :], len(self.centres)).min(1)
                better = (least < near[some]) | ((least == near[some]) & (first < best[some]))
                best[some] = np.where(better, first, best[some])
                near[some] = np.where(better, least, near[some])
        return best, near, compared


def _bands(ring: np.ndarray) -> Iterator[tuple[int, int]]:
    """Slices of the rising ``ring`` within which the reach at most doubles."""
    low = 0
    while low < len(ring):
        high = int(np.searchsorted(ring, 2 * ring[low], side="right"))
        yield low, high
        low = high


def first_codes(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first assignment, when there are no balls yet: all entries are compared."""
    d = squared(points, centres)
    at = d.argmin(1)
    return at, d[np.arange(len(at)), at]


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``vec_id, label, v`` (longs, floor of ``scale`` times each component) of
    the rows whose vector has finite components only."""
    rows = pick(vectors, id_col, vector_col, label_col).toDF("vec_id", "v", "label")
    wide = rows.withColumn("v", F.col("v").cast("array<double>"))
    fine = wide.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    # beyond the range of a long the product saturates, which _check_range reports
    return fine.select("vec_id", "label", F.transform("v", lambda x: F.floor(F.greatest(F.least(x, F.lit(1e15)), F.lit(-1e15)) * scale)).alias("v"))


def _check_shape(rows: DataFrame, parts: int) -> int:
    """The vectors' width; an error names what cannot be coded."""
    widths = [r[0] for r in rows.select(F.size("v").alias("w")).distinct().limit(10).collect()]
    if len(widths) > 1:
        raise ValueError(f"vectors of different widths cannot share codebooks: {sorted(widths)}")
    width = widths[0] if widths else 0
    if width % parts:
        raise ValueError(f"vectors of width {width} cannot be cut into {parts} equal parts")
    top = rows.select(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0
    if width and (2 * top) ** 2 * width >= 1 << 60:
        raise ValueError(f"components up to {top} (scaled) overflow exact squared distances")
    return width


def encode_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, code, error`` per usable vector, and the codebooks (one
    entries x width array per part position).

    ``code`` holds one byte per part (the entry's index), ``error`` the summed
    squared distances. Rows whose vector is null or holds null or non-finite
    components are dropped. A codebook starts with the vectors of the
    ``entries`` smallest ids (null ids last, equal ids by their vector); fewer
    vectors give fewer entries, an empty table an empty result and empty
    codebooks. Entries without parts stay. Vectors of no component code as
    zeros with error 0. Different widths, a width that ``parts`` does not divide,
    and components too large for exact integer distances are errors. Repeated
    rows are coded each. Extra columns are ignored, whatever their names.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries: 1 to 256 (an index is one byte)")
    spark = vectors.sparkSession
    ship_package(spark)
    rows = cut_lineage(integer_vectors(vectors, id_col, vector_col, label_col, scale), "balls-vectors")
    width = _check_shape(rows, parts)
    step = width // parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # at most 256
    start = np.array([r[0] for r in first], np.int64).reshape(len(first), width)
    books = [start[:, p * step : (p + 1) * step] for p in range(parts)]
    if not first:
        empty = rows.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty, books
    id_type, label_type = rows.schema["vec_id"].dataType.simpleString(), rows.schema["label"].dataType.simpleString()
    schema = f"vec_id {id_type}, label {label_type}, v array<bigint>, code binary, far array<bigint>"

    def assign(table: DataFrame, balls: list[Balls] | None) -> DataFrame:
        """``table`` with each part's entry (``code``) and squared distance (``far``)."""
        shared = spark.sparkContext.broadcast((balls, books))  # parts x entries x width numbers

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            balls, books = shared.value
            for whole in batches:
                for begin in range(0, whole.num_rows, STEP_ROWS):
                    batch = whole.slice(begin, STEP_ROWS)
                    n = batch.num_rows
                    points = batch.column("v").flatten().to_numpy().reshape(n, width)
                    codes, far = np.empty((n, parts), np.uint8), np.empty((n, parts), np.int64)
                    if balls is not None:
                        before = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                    for p in range(parts):
                        part = points[:, p * step : (p + 1) * step]
                        if balls is None:
                            codes[:, p], far[:, p] = first_codes(part, books[p])
                        else:
                            codes[:, p], far[:, p], _ = balls[p].reassign(part, before[:, p])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("vec_id"), batch.column("label"), batch.column("v"),
                            pa.array([c.tobytes() for c in codes], pa.binary()),
                            pa.ListArray.from_arrays(pa.array(np.arange(0, n * parts + 1, parts, dtype=np.int32)), pa.array(far.ravel())),
                        ],
                        names=["vec_id", "label", "v", "code", "far"],
                    )

        return cut_lineage(table.mapInArrow(run, schema), "balls-codes")

    names = [f"s{i}" for i in range(step)]
    stats_schema = ", ".join(f"{c} bigint" for c in ("part", "entry", "n", *names))

    def statistics(table: DataFrame) -> list[np.ndarray]:
        """Per part position: rows (entry, count, sums...) of the entries in use."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((parts, entries, 1 + step), np.int64)
            for batch in batches:
                n = batch.num_rows
                points = batch.column("v").flatten().to_numpy().reshape(n, width)
                codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, parts)
                for p in range(parts):
                    order = np.argsort(codes[:, p], kind="stable")
                    used, at = np.unique(codes[order, p], return_index=True)
                    if len(used):
                        total[p, used, 0] += np.diff(np.append(at, n))
                        total[p, used, 1:] += np.add.reduceat(points[order, p * step : (p + 1) * step], at, axis=0)
            part, entry = np.nonzero(total[:, :, 0])
            found = total[part, entry]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(entry), *(pa.array(np.ascontiguousarray(found[:, i])) for i in range(1 + step))], names=["part", "entry", "n", *names]
            )

        partial = table.select("v", "code").mapInArrow(run, stats_schema)
        # at most parts x entries rows; sums of sums as decimals cannot overflow
        sums = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in names]).collect()
        out = [book.copy() for book in books]
        for r in sums:
            out[r["part"]][r["entry"]] = [int(r[c]) // r["n"] for c in names]
        return out

    def radii(table: DataFrame) -> list[np.ndarray]:
        """Squared distance of the farthest part of each ball from its moved
        centre (``books`` as they are now); -1 for an empty ball."""
        shared = spark.sparkContext.broadcast(books)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            books = shared.value
            top = np.full((parts, entries), -1, np.int64)
            for batch in batches:
                n = batch.num_rows
                points = batch.column("v").flatten().to_numpy().reshape(n, width)
                codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, parts)
                for p in range(parts):
                    off = points[:, p * step : (p + 1) * step] - books[p][codes[:, p]]
                    np.maximum.at(top[p], codes[:, p], (off * off).sum(1))
            part, entry = np.nonzero(top >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(top[part, entry])], names=["part", "entry", "radius"])

        found = table.select("v", "code").mapInArrow(run, "part bigint, entry bigint, radius bigint")
        out = [np.full(len(books[0]), -1, np.int64) for _ in range(parts)]
        for r in found.groupBy("part", "entry").agg(F.max("radius").alias("radius")).collect():  # at most parts x entries rows
            out[r["part"]][r["entry"]] = r["radius"]
        return out

    table = assign(rows.withColumn("code", F.lit(None).cast("binary")).withColumn("far", F.lit(None).cast("array<bigint>")), None)
    for _ in range(rounds):
        books = statistics(table)
        table = assign(table, [Balls(b, r) for b, r in zip(books, radii(table))])
    return table.select("vec_id", "label", "code", F.aggregate("far", F.lit(0).cast("long"), lambda a, x: a + x).alias("error")), books


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' decimal components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the summed error of its label (null
    labels together), summed before it is joined."""
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).drop("of")
