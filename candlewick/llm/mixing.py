"""Mixing sources to target weights with hash-threshold histograms.

Every document gets a 60-bit hash of its id. A source that should give
``budget`` words takes the documents whose hash lies under a threshold. The
threshold is found without sorting: words are summed by source and hash bucket
(4,096 buckets), the bucket in which the running sum reaches the budget is the
boundary, and only that bucket's documents are summed again by their next 12
hash bits, down to single hash values. The first and second copy of a document
use the same hash with two budgets, so the thresholds are nested: a document
taken twice is always one taken once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import WORD, hidden, pick, position
from candlewick.session import cut_lineage

HASH_BITS, LEVEL_BITS = 60, 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_hash(doc_id: Column, seed: str = "mix") -> Column:
    """60 bits of md5(seed:id); a null id counts as an empty one."""
    keyed = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(keyed), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``sizes``: ``source, size`` per document. Per source: ``source,
    source_size, target``.

    Sources in code point order (null last) take the weights in turn and share
    ``share`` times all words; a target stops at ``most`` times its source's
    size and the excess is shared again by weight until none is above. This
    table has one row per source, as the weights a user sets have.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_n") - 1, F.lit(len(weights))) + 1).cast("int"))
    everyone = Window.partitionBy()
    per = (
        per.withColumn("_n", F.row_number().over(order))
        .withColumn("_w", weight)
        .withColumn("_cap", F.col("source_size") * F.lit(most))
        .withColumn("_all", F.sum("source_size").over(everyone) * F.lit(share))
    )
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), "_n")
    before = F.coalesce(F.sum("_cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_w").over(fill.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("_full", F.col("_cap") * rest <= F.col("_w") * (F.col("_all") - before))
    full = F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0.0)).over(everyone)
    free = F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("_w"))).over(everyone)
    target = F.when(F.col("_full"), F.col("_cap")).otherwise((F.col("_all") - full) * F.col("_w") / free)
    return per.select("source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``sizes``: ``source, size, h`` per document. Per source the nested hash
    bounds ``t1`` (first copy) and ``t2`` (second copy): a document is taken
    once for each bound above its hash. The document on the boundary is taken
    if that brings the words nearer to the budget."""
    top = 1 << HASH_BITS
    budgets = targets.select(
        "source",
        "source_size",
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("copy"), F.least("target", "source_size").cast("double").alias("left")),
                F.struct(F.lit(2).alias("copy"), F.greatest(F.col("target") - F.col("source_size"), F.lit(0.0)).alias("left")),
            )
        ).alias("b"),
    ).select("source", "source_size", "b.*")
    whole, none = F.col("left") >= F.col("source_size"), F.col("left") <= 0
    done = budgets.where(whole | none).select("source", "copy", F.when(none, F.lit(0)).otherwise(F.lit(top)).alias("t"))
    open_ = budgets.where(~whole & ~none).select("source", "copy", "left", F.lit(0).cast("long").alias("prefix"))
    for level in range(HASH_BITS // LEVEL_BITS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        # one map-side combined sum per source and bucket, over the boundary bucket only
        rows = sizes.select(
            F.col("source").alias("_s"),
            F.shiftright("h", shift).alias("bucket"),
            F.shiftright("h", shift + LEVEL_BITS).alias("_p"),
            "size",
        )
        if level == 0:
            sums = rows.groupBy("_s", "bucket", "_p").agg(F.sum("size").alias("words"))
            joined = open_.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("prefix") == F.col("_p")))
        else:
            joined = (
                rows.join(open_, F.col("source").eqNullSafe(F.col("_s")) & (F.col("prefix") == F.col("_p")))
                .groupBy("source", "copy", "left", "bucket")
                .agg(F.sum("size").alias("words"))
            )
        line = Window.partitionBy("source", "copy").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        cut = joined.withColumn("_cum", F.sum("words").over(line)).where(F.col("_cum") >= F.col("left"))
        first = Window.partitionBy("source", "copy").orderBy("bucket")
        cut = cut.withColumn("_r", F.row_number().over(first)).where("_r = 1")
        open_ = cut.select(
            "source", "copy", (F.col("left") - (F.col("_cum") - F.col("words"))).alias("left"),
            F.col("bucket").alias("prefix"), F.col("words"),
        )
    edge = F.col("prefix") + F.when(F.col("left") * 2 >= F.col("words"), 1).otherwise(0)
    both = done.unionByName(open_.select("source", "copy", edge.alias("t")))
    return both.groupBy("source").agg(
        F.max(F.when(F.col("copy") == 1, F.col("t"))).alias("t1"),
        F.max(F.when(F.col("copy") == 2, F.col("t"))).alias("t2"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """Every row of ``docs`` (all its columns, hidden names ``_inN``) plus
    ``size, source_size, target, copies, taken``; ``copies`` is 0, 1 or 2 and
    ``taken = copies * size``.

    A null text has size 0; a null source is a source of its own, last in
    order; rows that repeat an id share a hash and are taken together. An
    empty table gives an empty result; a corpus without words takes nothing.
    Very long texts count all their words; rows of one hash (ties) are taken or
    left together; extra columns are passed through, whatever their names.
    The table of sources is written once, so Spark broadcasts it only while
    its measured size is under the session's threshold.
    """
    if most != 2.0:
        raise ValueError("a document is taken at most twice: most must be 2.0")
    small = pick(docs, id_col, text_col, source_col).toDF("doc_id", "text", "source")
    small = cut_lineage(
        small.select("source", word_count(F.col("text")).alias("size"), id_hash(F.col("doc_id"), seed).alias("h")), "mix-sizes"
    )
    targets = cut_lineage(source_targets(small, weights, share, most).coalesce(1), "mix-targets")
    bounds = cut_lineage(
        targets.join(thresholds(small, targets).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .select(F.col("source").alias("_s"), "source_size", "target", "t1", "t2").coalesce(1),
        "mix-bounds",
    )
    raw, names = hidden(docs)
    rows = raw.withColumn("size", word_count(F.col(position(names, text_col)))).withColumn(
        "_h", id_hash(F.col(position(names, id_col)), seed)
    )
    copies = reduce(lambda a, b: a + b, [(F.col("_h") < F.col(t)).cast("int") for t in ("t1", "t2")])
    return (
        rows.join(bounds, F.col(position(names, source_col)).eqNullSafe(F.col("_s")))
        .withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("_s", "_h", "t1", "t2")
    )


def sample_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: rows taken twice appear
    twice, rows not taken are left out."""
    _, names = hidden(docs)
    out = mix(docs, **options).where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(*[f"_in{i}" for i in range(len(names))]).toDF(*names)
