"""Splitting each symbol's ordered trade sequence into parallel chunks.

The detectors look at "the last N trades of a symbol" or "the trades of
the last 10 s". Written naively as ``Window.partitionBy('symbol')`` every
symbol becomes one task, and a symbol holding a third of all rows would be
sorted and scanned by a single core. Instead:

* ``plan_chunks`` counts rows per (symbol, time grain) — a partial
  aggregation whose output is tiny (symbols x grains) — re-counts hot
  grains per millisecond, and cuts each symbol's units into consecutive
  chunks of about ``chunk_size`` rows (adaptive to data size and cluster
  parallelism). Chunks are time ranges, so time order across chunks is
  chunk order; one millisecond of one symbol is the smallest unit.
* ``with_frame_halo`` copies the rows that a chunk's first frames reach back
  to (known from the unit counts: at least ``frame - 1`` rows, at most one
  unit more) into that chunk, and ``rolling_rows`` evaluates a ROWS frame
  there: one shuffle and one sort give exact frames, nothing is written.
* ``recent_count`` counts trades of the last ``window_ms`` "seen so far";
  earlier chunks contribute per-millisecond counts (a bounded halo).

Everything is DataFrame/Window code; the only shuffle of full data is the
one keyed by ``(symbol, chunk)``; windows keyed by symbol alone run over the
small per-grain / per-chunk tables only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.params import DEFAULT, Params
from candlewick.session import cut_lineage

ORDER = ("trade_time_ms", "trade_id")


def chunk_size(grains: DataFrame, p: Params = DEFAULT) -> Column:
    """Rows per chunk: ``p.chunk_rows`` if set, else total rows over twice the
    cluster's parallelism (a scalar subquery), clamped to the min/max."""
    if p.chunk_rows:
        return F.lit(p.chunk_rows)
    total = grains.select(F.sum("_cnt")).scalar()
    slots = 2 * grains.sparkSession.sparkContext.defaultParallelism
    return F.greatest(F.lit(p.min_chunk_rows), F.least(F.lit(p.max_chunk_rows), F.ceil(total / F.lit(slots))))


def plan_chunks(trades: DataFrame, p: Params = DEFAULT, key: str = "symbol", ts: str = "trade_time_ms") -> DataFrame:
    """Unit table ``(key, _grain, _ms)`` and ``CHUNK_COLUMNS``.

    A unit is a whole time grain, or — inside a grain holding more rows than
    one chunk — a single millisecond (``_ms`` set). Units are numbered into
    consecutive chunks of ~``chunk_size`` rows with a running sum over the
    unit table, whose size is symbols x grains plus the milliseconds of hot
    grains (independent of the row count otherwise). Only one millisecond of
    one symbol is never split.

    A chunk's *cut* is the start of the latest unit that leaves at least
    ``frame - 1`` rows between it and the chunk (the longer of the two
    frames): ``halo_chunks`` names the later chunks that get a copy of a
    unit's rows (usually none or one), ``next_cut`` the first cut behind the
    unit and the chunks it belongs to.
    """
    grain = F.floor(F.col(ts) / F.lit(p.grain_ms))
    # the grain table is small; materialised so the checks below are cheap
    grains = cut_lineage(trades.groupBy(key, grain.alias("_grain")).agg(F.count(F.lit(1)).alias("_cnt")), "grains")
    size = chunk_size(grains, p)
    hot = grains.where(F.col("_cnt") > size).select(key, "_grain")
    units = grains.withColumn("_ms", F.lit(None).cast("bigint"))
    if not hot.isEmpty():
        # re-count only the hot grains per millisecond
        fine = (
            trades.select(key, ts, grain.alias("_grain"))
            .join(hot, [key, "_grain"], "left_semi")
            .groupBy(key, "_grain", F.col(ts).alias("_ms"))
            .agg(F.count(F.lit(1)).alias("_cnt"))
        )
        units = units.join(hot, [key, "_grain"], "left_anti").unionByName(fine)
    units = units.withColumn("_lo", F.coalesce("_ms", F.col("_grain") * F.lit(p.grain_ms)))
    units = units.withColumn("_hi", F.col("_lo") + F.when(F.col("_ms").isNull(), F.lit(p.grain_ms)).otherwise(1))
    wk = Window.partitionBy(key).orderBy("_lo")
    before = F.coalesce(F.sum("_cnt").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    h = max(p.wash_frame, p.spike_frame) - 1
    u = units.withColumn("_before", before.cast("bigint")).withColumn("chunk", F.floor(F.col("_before") / size).cast("bigint"))
    reach = Window.partitionBy(key).orderBy("_before").rangeBetween(Window.unboundedPreceding, -h)
    u = u.withColumn("_cut", F.coalesce(F.max("_lo").over(reach), F.lit(NO_CUT)))
    # one row per chunk; its successor is the next row
    chunks = u.groupBy(key, "chunk").agg(
        F.min("_lo").alias("chunk_start_ms"),
        F.max("_hi").alias("_end"),
        F.sum("_cnt").alias("_rows"),
        F.min("_cut").alias("_chunk_cut"),
    )
    wc = Window.partitionBy(key).orderBy("chunk")
    # speculative look-back for sequential folds: seq_halo_ms, but no more
    # than about seq_halo_rows rows at this chunk's density
    span = F.col("_end") - F.col("chunk_start_ms")
    halo = F.least(F.lit(p.seq_halo_ms), F.greatest(F.lit(1), F.floor(span * F.lit(p.seq_halo_rows) / F.col("_rows"))))
    # a chunk has a row at least, so only the next h chunks can reach back into one
    later = F.collect_list(F.struct(F.col("chunk").alias("c"), F.col("_chunk_cut").alias("cut"))).over(wc.rowsBetween(1, max(h, 1)))
    chunks = chunks.select(
        key,
        "chunk",
        "chunk_start_ms",
        F.lead("chunk").over(wc).alias("next_chunk"),
        F.lead("chunk_start_ms").over(wc).alias("next_chunk_start_ms"),
        halo.cast("bigint").alias("_spec_halo_ms"),
        "_chunk_cut",
        F.filter(later, lambda x: x["cut"] < F.col("_end")).alias("_later"),
    )
    cuts = chunks.where(F.col("_chunk_cut") != NO_CUT).groupBy(key, F.col("_chunk_cut").alias("_lo")).agg(
        F.sort_array(F.collect_list("chunk")).alias("_of")
    )
    after = Window.partitionBy(key).orderBy(F.col("_lo").desc()).rowsBetween(Window.unboundedPreceding, -1)
    marked = u.select(key, "_grain", "_ms", "_lo", "chunk").join(cuts, [key, "_lo"], "left").withColumn(
        "next_cut", F.min(F.when(F.col("_of").isNotNull(), F.struct(F.col("_lo").alias("ms"), F.col("_of").alias("chunks")))).over(after)
    )
    reached = F.transform(F.filter("_later", lambda x: x["cut"] <= F.col("_lo")), lambda x: x["c"])
    out = marked.join(chunks, [key, "chunk"]).withColumn("halo_chunks", F.when(F.size(reached) > 0, reached))
    return out.select(key, "_grain", "_ms", *CHUNK_COLUMNS)


#: Cut of a chunk that has fewer than a frame of rows ahead of it: all of them.
NO_CUT = -(1 << 62)
CHUNK_COLUMNS = ["chunk", "chunk_start_ms", "next_chunk", "next_chunk_start_ms", "_spec_halo_ms", "halo_chunks", "next_cut"]


def assign_chunks(trades: DataFrame, p: Params = DEFAULT, key: str = "symbol", ts: str = "trade_time_ms") -> DataFrame:
    """Trades plus ``CHUNK_COLUMNS``.

    The plan is small and materialised once (exact statistics), so AQE
    turns both lookups into broadcast joins when it measures them under the
    broadcast threshold, and keeps shuffle joins otherwise. Rows of normal
    grains match by grain; rows of hot grains by millisecond.
    """
    plan = cut_lineage(plan_chunks(trades, p, key, ts), "chunk-plan")
    by_grain = plan.where(F.col("_ms").isNull()).drop("_ms")
    by_ms = plan.where(F.col("_ms").isNotNull()).select(
        key, F.col("_ms").alias(ts), *[F.col(c).alias("_m" + c) for c in CHUNK_COLUMNS]
    )
    t = trades.withColumn("_grain", F.floor(F.col(ts) / F.lit(p.grain_ms)))
    t = t.join(by_grain, [key, "_grain"], "left").join(by_ms, [key, ts], "left")
    return t.select(
        *trades.columns, *[F.coalesce(F.col(c), F.col("_m" + c)).alias(c) for c in CHUNK_COLUMNS]
    )


def with_halo_copies(df: DataFrame, is_halo: Column, chunk: str = "chunk") -> DataFrame:
    """Every row once in its own chunk (``_halo`` false) and, where
    ``is_halo`` holds, once more in the next chunk (``_halo`` true) — one
    scan, a one-to-two ``explode`` instead of a union of two reads."""
    copies = F.when(F.col("next_chunk").isNotNull() & is_halo, F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False))
    )
    out = df.select("*", F.explode(copies).alias("_halo"))
    return out.withColumn(chunk, F.when(F.col("_halo"), F.col("next_chunk")).otherwise(F.col(chunk)))


AggBuilder = Callable[[Window], list[Column]]


def with_frame_halo(df: DataFrame, chunk: str = "chunk") -> DataFrame:
    """Every row in its own chunk (``_copy`` false) and once more in each
    chunk whose frames reach back to it (``_copy`` true, ``halo_chunks``)."""
    own = F.array(F.col(chunk))
    everywhere = F.when(F.col("halo_chunks").isNull(), own).otherwise(F.concat(own, "halo_chunks"))
    out = df.withColumn("_own_chunk", F.col(chunk)).withColumn("_to", F.explode(everywhere))
    return out.withColumn("_copy", F.col("_to") != F.col("_own_chunk")).withColumn(chunk, F.col("_to")).drop("_to", "_own_chunk")


def rolling_rows(
    copies: DataFrame,
    frame: int,
    aggs: AggBuilder,
    key: str = "symbol",
    chunk: str = "chunk",
    order: tuple[str, ...] = ORDER,
) -> DataFrame:
    """Add ``aggs(w)`` over the last ``frame`` rows (current included) of each
    key in ``order``, exactly as one window per key would for every row that
    is no copy, in parallel per (key, chunk). ``copies`` comes from
    ``with_frame_halo``: each chunk holds the rows its first frames need, so
    one shuffle and one sort do; drop the copies when all frames are there.
    """
    w = Window.partitionBy(key, chunk).orderBy(*order).rowsBetween(1 - frame, 0)
    return copies.select("*", *aggs(w))


def recent_count(
    copies: DataFrame,
    trades: DataFrame,
    window_ms: int,
    out: str = "recent_count",
    key: str = "symbol",
    chunk: str = "chunk",
    ts: str = "trade_time_ms",
    order: tuple[str, ...] = ORDER,
    older: DataFrame | None = None,
) -> DataFrame:
    """Trades of the same key with ``ts >= ts_i - window_ms`` that come at or
    before row i in ``order`` (row i included), for every row of ``copies``
    (``with_frame_halo`` of ``trades``). ``older`` (``key, ts, n``): counts per
    millisecond of trades that come before all of ``trades``.

    Inside a chunk and its copies, which begin at the chunk's cut: ``running
    count - rows with ts <= ts_i - window_ms - 1`` (a RANGE frame alone would
    also count later rows with the same ms). What lies before the cut
    contributes *per-millisecond counts* of the last ``window_ms``: at most
    ``window_ms`` rows per chunk whatever the trade density (copying raw
    trades would not be bounded in a dense burst). A millisecond never
    straddles a cut, so nothing is counted twice.
    """
    w = F.lit(window_ms)
    base_cols = copies.columns
    tail = trades.where(F.col("next_cut").isNotNull() & (F.col(ts) >= F.col("next_cut.ms") - w))
    # a millisecond lies in one unit, so it has one next cut
    per_ms = tail.groupBy(key, F.col(ts).alias("_hts"), "next_cut").agg(F.count(F.lit(1)).alias("_hcnt"))
    # Every cut that can receive counts is the next cut of some tail row (the
    # last rows before it are within its window), so the cuts come from the
    # small aggregated tail, not from a pass over all rows.
    cuts = per_ms.select(key, "next_cut").distinct()
    cuts = cuts.select(key, F.col("next_cut.ms").alias("_cut"), F.explode("next_cut.chunks").alias(chunk))
    cuts = cuts.withColumn("_b", F.floor(F.col("_cut") / w))
    # cuts in (ms, ms + window]: equi-join on window-sized buckets
    bucket = F.floor(F.col("_hts") / w)
    if older is not None:
        ahead = older.select(key, F.col("ts").alias("_hts"), F.col("n").alias("_hcnt"))
        per_ms = per_ms.select(*ahead.columns).unionByName(ahead)
    per_ms = per_ms.select(key, "_hts", "_hcnt", F.explode(F.array(bucket, bucket + 1)).alias("_b"))
    halo = per_ms.join(cuts, [key, "_b"]).where((F.col("_cut") > F.col("_hts")) & (F.col("_cut") <= F.col("_hts") + w))
    if older is not None:  # the chunks that reach back to a key's first rows have all of them ahead
        first = trades.where(F.col(chunk) == 0).groupBy(key).agg(F.min_by("halo_chunks", ts).alias("_more"))
        none = F.array().cast("array<bigint>")
        reaching = first.select(key, F.explode(F.concat(F.array(F.lit(0).cast("bigint")), F.coalesce("_more", none))).alias(chunk))
        others = halo.select(key, chunk, "_hts", "_hcnt").join(reaching, [key, chunk], "left_anti")
        halo = others.unionByName(ahead.join(reaching, key).select(key, chunk, "_hts", "_hcnt"))
    halo = halo.select(key, chunk, F.col("_hts").alias(ts), "_hcnt", F.lit(0).alias("_own"))
    own = copies.select("*", F.lit(0).cast("bigint").alias("_hcnt"), F.lit(1).alias("_own"))
    both = own.unionByName(halo, allowMissingColumns=True)
    rows_w = Window.partitionBy(key, chunk).orderBy(*order)
    range_w = Window.partitionBy(key, chunk).orderBy(ts)
    running = F.sum("_own").over(rows_w.rowsBetween(Window.unboundedPreceding, 0))
    older = F.coalesce(F.sum("_own").over(range_w.rangeBetween(Window.unboundedPreceding, -(window_ms + 1))), F.lit(0))
    # halo rows all lie before the cut: those still inside the window are all but the older ones
    halo_total = F.sum("_hcnt").over(Window.partitionBy(key, chunk))
    halo_older = F.coalesce(F.sum("_hcnt").over(range_w.rangeBetween(Window.unboundedPreceding, -(window_ms + 1))), F.lit(0))
    carried = halo_total - halo_older
    counted = both.withColumn(out, (running - older + carried).cast("bigint"))
    return counted.where(F.col("_own") == 1).select(*base_cols, out)
