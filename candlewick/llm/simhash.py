"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints within ``k`` bits of each other are found without comparing all:
64 bits are cut into ``k // 2 + 1`` segments, so that in any such pair some
segment differs in at most one bit. Each fingerprint is indexed by every
segment as it is and by every segment with one bit taken out (a one-wildcard
variant); pairs meet in an equality join on the variant and are verified bit
by bit. For even ``k`` the last segment needs no wildcards: if all others
differ in two bits or more, it is equal.

A bucket with more than ``bucket`` fingerprints is not joined: its members are
indexed again by variants of their remaining bits (for at most as many
differing bits as are left), until every bucket is small or no bits remain, so
no pair is lost and no bucket is compared all against all. Exact copies of a
fingerprint are one member from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import hidden, pick, position
from candlewick.llm.workers import release_memory
from candlewick.session import cut_lineage, ship_package

SHINGLE_WORDS, MAX_BITS, SEED = 3, 2, 42
BUCKET = 64
BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Signed 64-bit SimHash: a bit is 1 if set in over half the shingle
    hashes (repeats counted); 0 without words."""
    import xxhash

    toks = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not toks:
        return 0
    digest = xxhash.xxh64_digest
    if len(toks) < words:
        shingles = [b" ".join(toks)]
    else:
        shingles = list(map(b" ".join, zip(*(toks[i:] for i in range(words)))))
    ones = np.zeros(64, np.int64)
    for start in range(0, len(shingles), BLOCK):
        raw = b"".join([digest(s, seed) for s in shingles[start : start + BLOCK]])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` per row of ``docs`` (a null text counts as empty)."""
    ship_package(docs.sparkSession)
    small = pick(docs, id_col, text_col).toDF("doc_id", "text")
    schema = T.StructType([T.StructField("doc_id", small.schema["doc_id"].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], names=schema.names)
        release_memory()

    return small.mapInArrow(run, schema)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def variants(open_bits: list[int], k: int) -> list[tuple[list[int], int | None]]:
    """Index variants for pairs that differ in at most ``k`` of ``open_bits``:
    (bits compared, wildcard bit or None)."""
    if k < 1:
        return [(open_bits, None)]
    parts = k // 2 + 1
    size, out = -(-len(open_bits) // parts), []
    for p in range(parts):
        segment = open_bits[p * size : (p + 1) * size]
        out.append((segment, None))
        if p < parts - 1 or k % 2:
            out += [([b for b in segment if b != w], w) for w in segment]
    return out


def _mask(bits) -> int:
    return _signed(sum(1 << b for b in bits))


#: Buckets that leave so few bits open hold few fingerprints: 2 ** (bits + wildcards).
FEW_BITS = 4


def deeper(fixed: int, wild: int, k: int) -> list[tuple[int, int, int]]:
    """The index variants of a bucket's remaining bits: (bits compared,
    wildcard bits, how many remaining bits may differ)."""
    rest = [b for b in range(63, -1, -1) if not (fixed | wild) >> b & 1]
    if k == 1:  # one of two halves is equal
        half = len(rest) // 2
        return [(_signed((fixed | _mask(r)) % (1 << 64)), wild, k) for r in (rest[:half], rest[half:])]
    return [
        (_signed((fixed | _mask(seg)) % (1 << 64)), wild if w is None else _signed((wild | 1 << w) % (1 << 64)), k - (w is not None))
        for seg, w in variants(rest, k)
    ]


def near_pairs(fps: DataFrame, k: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """``fps`` has distinct ``fp``. Pairs ``a < b`` within ``k`` bits, each
    once: all of them, whatever the bucket sizes."""
    if k < 1:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    ship_package(fps.sparkSession)
    path = ["fixed", "wild", "key"]
    first = [F.struct(F.lit(f).alias("fixed"), F.lit(w).alias("wild"), F.lit(left).alias("k")) for f, w, left in deeper(0, 0, k)]
    keyed = fps.select("fp", F.explode(F.array(*first)).alias("v")).select("fp", "v.*").withColumn("key", F.col("fp").bitwiseAND(F.col("fixed")))
    closed = (F.bit_count(F.col("fixed").bitwiseOR(F.col("wild"))) >= 64 - FEW_BITS) | (F.col("k") < 1)
    apart, found = F.col("fp").bitwiseXOR(F.col("b")), []

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(*old, *new) for old in zip(*(c.to_pylist() for c in batch.columns)) for new in deeper(*old)]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=pa.schema([(n, pa.int64()) for n in names]))

    names = ["fixed", "wild", "k", "fixed2", "wild2", "k2"]
    while True:
        shared = keyed.groupBy(*path).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        members = cut_lineage(
            keyed.join(cut_lineage(shared, "simhash-buckets"), path).withColumn("whole", (F.col("n") <= bucket) | closed).drop("n"),
            "simhash-members",
        )
        other = members.where("whole").select(*[F.col(c).alias("_" + c) for c in path], F.col("fp").alias("b"))
        same = reduce(lambda x, y: x & y, [F.col(c) == F.col("_" + c) for c in path])
        within = (F.col("fp") < F.col("b")) & (apart.bitwiseAND(F.col("wild")) == F.col("wild")) & (F.bit_count(apart) <= k)
        found.append(members.where("whole").join(other, same & within).select(F.col("fp").alias("a"), "b"))
        hot = members.where("NOT whole")
        if hot.isEmpty():
            break
        steps = hot.select("fixed", "wild", F.col("k").cast("long").alias("k")).distinct().mapInArrow(refine, ", ".join(f"{n} long" for n in names))
        keyed = (
            hot.drop("k", "key", "whole").join(steps, ["fixed", "wild"])
            .select("fp", F.col("fixed2").alias("fixed"), F.col("wild2").alias("wild"), F.col("k2").alias("k"))
            .withColumn("key", F.col("fp").bitwiseAND(F.col("fixed")))
            .distinct()
        )
    return reduce(DataFrame.unionByName, found).distinct()


def connected(pairs: DataFrame) -> DataFrame:
    """``node, root`` (root: the smallest node of its component) for every node
    of ``pairs`` (``a, b``), by alternating large-star and small-star steps;
    each round is written, so a lost executor repeats one round at most."""
    edges = cut_lineage(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "cc")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        star = small.select("u", F.col("m").alias("v")).unionByName(
            small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = cut_lineage(star.distinct(), "cc")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    bucket: int = BUCKET,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, fp`` (signed 64-bit), ``component_id``,
    the smallest id reachable over links of at most ``max_bits`` bits.

    Texts without words share the fingerprint 0 and are linked like any
    others. Null ids take part in links but name no component (a component
    of null ids only has a null id). Repeated rows give repeated rows; an
    empty table gives an empty result. Very long texts are hashed whole; a bit
    set in exactly half the shingles is 0; extra columns are ignored, whatever
    their names.
    """
    marks = cut_lineage(fingerprints(docs, id_col, text_col, words), "simhash-fp")
    classes = cut_lineage(marks.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    roots = connected(near_pairs(classes.select("fp"), max_bits, bucket))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = rooted.join(names, "root").select(F.col("fp").alias("_fp"), "component_id")
    return marks.join(of, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose id names their component (the smallest id of
    each group stays), with the columns of ``docs``. The ids that go are
    written first; whole rows meet them in one null-safe anti join, which
    Spark broadcasts only while the written ids are under the session's
    threshold. Rows that repeat an id stay together if one of them does."""
    marked = near_duplicates(docs, **options)
    stays = F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = cut_lineage(
        marked.groupBy("doc_id").agg(stays.alias("stays")).where("NOT stays").select(F.col("doc_id").alias("_id")), "simhash-gone"
    )
    raw, names = hidden(docs)
    id_col = F.col(position(names, options.get("id_col", "doc_id")))
    return raw.join(gone, id_col.eqNullSafe(F.col("_id")), "left_anti").toDF(*names)
