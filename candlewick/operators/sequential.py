"""Exact per-key sequential rules, run in parallel over time chunks.

Some rules (pump-and-dump's state machine, the volume-spike cooldown) are
a left fold over each symbol's trades. One task per symbol would serialise
a hot symbol, so each symbol is cut into time chunks (see ``chunks``) and
every chunk is folded independently:

1. **Speculative pass.** A chunk first replays the last ``halo_ms`` of the
   previous chunk from the initial state, which gives a guess of the state
   at its first row, then folds its own rows. It reports the assumed
   incoming state and its outgoing state.
2. **Verification.** The true incoming state of a chunk is the outgoing
   state of the previous non-empty chunk of the same key. This is a small
   table (one row per chunk). Where the assumption was wrong, the chunk is
   folded again from the true state; that may change its outgoing state, so
   the re-fold goes on through the next chunks until one was entered with
   the right state, at most to the end of its block (consecutive chunks of a
   key). Blocks are checked against each other the same way, and grow from
   round to round, so the number of rounds does not grow with the number of
   chunks that a wrong state runs through. The earliest wrong chunk is right
   after one round, so the loop ends.

A fold may start from given states (``initial``, one row per key) and return
the states it ends in, so a later run continues where this one stopped.

Each pass is checkpointed into the shared checkpoint folder so a lost
executor recomputes only the current pass. The fold itself runs inside
``mapInArrow`` over sorted rows (one chunk in memory, bounded by the planner):
array searches from event to event, which column expressions cannot state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

import logging

from candlewick.operators.chunks import with_halo_copies
from candlewick.session import cut_lineage, ship_package


log = logging.getLogger("candlewick.sequential")

#: Rows of consecutive chunks that a re-fold runs through in a row: at first,
#: growth from round to round, and at most. Only one chunk is in memory at a time.
BLOCK_ROWS, BLOCK_GROWTH, MAX_BLOCK_ROWS = 20_000, 8, 2_000_000
OUT_ROWS = 10_000  # rows of a fold's results per Arrow batch


@dataclass
class SequentialRule:
    """A left fold over a key's rows in ``(trade_time_ms, trade_id)`` order.

    ``step(state, rows, emit)`` folds a pandas frame of rows (already sorted)
    from ``state`` and returns the new state; ``emit`` collects output
    tuples matching ``out_fields``. ``normalize(state, first_ts)`` maps a
    state to a canonical form given the first row it will meet (states that
    act the same compare equal); ``normalize_cols`` is the same as column
    expressions. ``ties``: input columns that order rows of equal time and id.
    """

    name: str
    input_cols: Sequence[str]
    state_fields: Sequence[StructField]
    out_fields: Sequence[StructField]
    initial: tuple
    step: Callable
    normalize: Callable[[tuple, int], tuple]
    normalize_cols: Callable[[list[Column], Column], list[Column]]
    ties: Sequence[str] = ()


def _schema(rule: SequentialRule, key: str) -> StructType:
    fields = [
        StructField(key, StringType()),
        StructField("chunk", LongType()),
        StructField("_kind", StringType()),
        StructField("_first_ts", LongType()),
        StructField("_rows", LongType()),
    ]
    fields += [StructField(f.name, f.dataType, True) for f in rule.out_fields]
    fields += [StructField("in_" + f.name, f.dataType, True) for f in rule.state_fields]
    fields += [StructField("out_" + f.name, f.dataType, True) for f in rule.state_fields]
    return StructType(fields)


_ARROW = {LongType: pa.int64(), IntegerType: pa.int32(), DoubleType: pa.float64(), BooleanType: pa.bool_(), StringType: pa.string()}


def _chunks_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pd.DataFrame]:
    """The rows of one chunk after the other; ``batches`` are sorted by key and
    chunk, and a chunk may run over several of them."""
    pieces: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, chunks = batch.column(key).to_pandas().to_numpy(), batch.column("chunk").to_numpy()
        starts = np.flatnonzero((chunks[1:] != chunks[:-1]) | (keys[1:] != keys[:-1])) + 1
        for a, b in zip([0, *starts.tolist()], [*starts.tolist(), batch.num_rows]):
            here = (keys[a], chunks[a])
            if pieces and here != last:
                yield pa.Table.from_batches(pieces).to_pandas()
                pieces = []
            pieces.append(batch.slice(a, b - a))
            last = here
    if pieces:
        yield pa.Table.from_batches(pieces).to_pandas()


def _fold_fn(rule: SequentialRule, key: str, speculative: bool):
    """Folds the chunks of a partition (sorted by key, chunk, time and id), one
    in memory at a time."""
    schema = _schema(rule, key)
    n_out = len(rule.out_fields)
    n_state = len(rule.state_fields)
    state_names = [f.name for f in rule.state_fields]

    def given(first, prefix: str) -> tuple:
        return tuple(None if pd.isna(first[prefix + s]) else first[prefix + s] for s in state_names)

    def folds(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pd.DataFrame, tuple]]:
        """Rows to fold and the state ahead of them."""
        block = state = None
        for pdf in _chunks_of(batches, key):
            if speculative:
                mine = pdf[~pdf["_halo"]]
                if len(mine):
                    halo = pdf[pdf["_halo"]]
                    state = rule.step(rule.initial, halo, None) if len(halo) else rule.initial
                    yield mine, rule.normalize(state, int(mine["trade_time_ms"].iloc[0]))
                continue
            first = pdf.iloc[0]
            if block != (first[key], first["_block"]):
                block, state = (first[key], first["_block"]), None
            if state is None:  # the chunk before stays as it was
                if first["_ok"]:
                    continue
                start = rule.normalize(given(first, "exp_"), int(first["trade_time_ms"]))
            else:
                start = rule.normalize(state, int(first["trade_time_ms"]))
                if all(a == b for a, b in zip(start, given(first, "in_"))):
                    state = None
                    continue
            state = yield pdf, start

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recs: list[tuple] = []

        def batch() -> pa.RecordBatch:
            arrays = [pa.array(c, _ARROW[type(f.dataType)], from_pandas=True) for c, f in zip(zip(*recs), schema.fields)]
            return pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

        todo, ended = folds(batches), None
        while True:
            try:
                mine, state = todo.send(ended)
            except StopIteration:
                break
            k, chunk, first_ts = mine[key].iloc[0], int(mine["chunk"].iloc[0]), int(mine["trade_time_ms"].iloc[0])
            rows: list[tuple] = []
            ended = rule.step(state, mine, rows.append)
            recs += [(k, chunk, "out", first_ts, len(mine)) + r + (None,) * (2 * n_state) for r in rows]
            recs.append((k, chunk, "state", first_ts, len(mine)) + (None,) * n_out + tuple(state) + tuple(ended))
            if len(recs) >= OUT_ROWS:
                yield batch()
                recs.clear()
        if recs:
            yield batch()

    return fn


def _folded(rows: DataFrame, rule: SequentialRule, key: str, speculative: bool) -> DataFrame:
    """``rows`` folded chunk by chunk; re-folds keep the chunks of a block together."""
    spread = rows.repartition(key, "chunk" if speculative else "_block")
    ordered = spread.sortWithinPartitions(key, "chunk", "trade_time_ms", "trade_id", *rule.ties)
    return cut_lineage(ordered.mapInArrow(_fold_fn(rule, key, speculative), _schema(rule, key)), rule.name)


def _null_safe_equal(a: Sequence[Column], b: Sequence[Column]) -> Column:
    cond = F.lit(True)
    for x, y in zip(a, b):
        cond = cond & x.eqNullSafe(y)
    return cond


def run_sequential(
    rows: DataFrame,
    rule: SequentialRule,
    halo_ms: int,
    key: str = "symbol",
    initial: DataFrame | None = None,
) -> DataFrame:
    """Fold ``rule`` over ``rows`` (which carry ``chunk``, ``next_chunk`` and
    ``next_chunk_start_ms``) and return the emitted rows (``out_fields`` plus
    ``key``), exactly as one sequential pass per key would. ``initial``: the
    states (``key`` and the state fields) that keys start from; keys without a
    row start from the rule's own."""
    return fold_with_states(rows, rule, halo_ms, key, initial)[0]


def fold_with_states(
    rows: DataFrame,
    rule: SequentialRule,
    halo_ms: int,
    key: str = "symbol",
    initial: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``run_sequential``, and the state that each key of ``rows`` ends in
    (``key`` and the state fields)."""
    ship_package(rows.sparkSession)
    schema = _schema(rule, key)
    cols = list(dict.fromkeys([key, "chunk", "trade_time_ms", "trade_id", *rule.input_cols]))
    # look back halo_ms, or less where the plan says that would be too many rows
    look_back = F.lit(halo_ms)
    if "_spec_halo_ms" in rows.columns:
        look_back = F.least(look_back, F.col("_spec_halo_ms"))
    base = rows.select(*cols, "next_chunk", "next_chunk_start_ms", look_back.alias("_look_back"))
    both = with_halo_copies(base, F.col("trade_time_ms") >= F.col("next_chunk_start_ms") - F.col("_look_back")).select(
        *cols, "_halo"
    )
    spec = _folded(both, rule, key, True)

    results = [spec.where(F.col("_kind") == "out").withColumn("_round", F.lit(0))]
    states = spec.where(F.col("_kind") == "state").select(
        key, "chunk", "_first_ts", "_rows", *[F.col(c) for c in schema.fieldNames() if c.startswith(("in_", "out_"))]
    ).withColumn("_round", F.lit(0))
    names = [f.name for f in rule.state_fields]
    own_rows = rows.select(*cols)
    rnd = 0
    while True:
        w = Window.partitionBy(key).orderBy("chunk")
        prev = [F.lag(F.col("out_" + n)).over(w) for n in names]
        is_first = F.lag(F.col("chunk")).over(w).isNull()
        init, known = [F.lit(v) for v in rule.initial], states
        if initial is not None:  # one row per key, as a key has one first chunk
            given = initial.select(key, F.lit(True).alias("_given"), *[F.col(n).alias("start_" + n) for n in names])
            known = states.join(given, key, "left")
            init = [F.when(F.col("_given"), F.col("start_" + n)).otherwise(i) for n, i in zip(names, init)]
        raw = [F.when(is_first, i).otherwise(pv) for i, pv in zip(init, prev)]
        expected = rule.normalize_cols(raw, F.col("_first_ts"))
        checked = known.select(
            "*", *[e.alias("exp_" + n) for e, n in zip(expected, names)]
        ).withColumn(
            "_ok", _null_safe_equal([F.col("in_" + n) for n in names], [F.col("exp_" + n) for n in names])
        )
        if rnd > 0:
            checked = cut_lineage(checked, rule.name + "-check")
        bad = checked.where(~F.col("_ok"))
        if bad.limit(1).count() == 0:
            break
        log.info("%s: round %d re-folds chunks whose assumed incoming state was wrong", rule.name, rnd + 1)
        rnd += 1
        if rnd == 2:  # more than a single correction: later rounds read the rows instead of computing them again
            own_rows = cut_lineage(own_rows, rule.name + "-rows")
        # re-fold from each block's first wrong chunk on, from its true incoming state
        size = min(BLOCK_ROWS * BLOCK_GROWTH ** (rnd - 1), MAX_BLOCK_ROWS)
        before = F.coalesce(F.sum("_rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        dealt = checked.withColumn("_block", F.floor(before / F.lit(size)).cast("bigint"))
        first_bad = F.min(F.when(~F.col("_ok"), F.col("chunk"))).over(Window.partitionBy(key, "_block"))
        starts = dealt.withColumn("_from", first_bad).where(F.col("chunk") >= F.col("_from")).select(
            key, "chunk", "_block", "_ok", *[F.col(x + n) for n in names for x in ("in_", "exp_")]
        )
        redo = _folded(own_rows.join(starts, [key, "chunk"]), rule, key, False)
        results.append(redo.where(F.col("_kind") == "out").withColumn("_round", F.lit(rnd)))
        new_states = redo.where(F.col("_kind") == "state").select(
            key, "chunk", "_first_ts", "_rows", *[F.col(c) for c in schema.fieldNames() if c.startswith(("in_", "out_"))]
        ).withColumn("_round", F.lit(rnd))
        keep = states.join(new_states.select(key, "chunk"), [key, "chunk"], "left_anti").select(*states.columns)
        states = cut_lineage(keep.unionByName(new_states), rule.name + "-states")

    final_round = states.select(key, "chunk", "_round")
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    out = out.join(final_round, [key, "chunk", "_round"], "left_semi")
    ended = states.groupBy(key).agg(F.max_by(F.struct(*[F.col("out_" + n).alias(n) for n in names]), "chunk").alias("s")).select(key, "s.*")
    return out.select(key, *[f.name for f in rule.out_fields]), ended


def combine_rules(rules: Sequence[tuple[SequentialRule, str | None]], name: str = "combined") -> SequentialRule:
    """Fold several rules in one pass over the same rows.

    ``rules`` pairs each rule with an optional boolean column selecting the
    rows it sees (``None``: all rows). State is the concatenation of the
    states; output rows carry ``_rule`` (index) and the rule's fields
    prefixed ``<rule name>__`` (other rules' fields NULL).
    """
    sizes = [len(r.state_fields) for r, _ in rules]
    offsets = [sum(sizes[:i]) for i in range(len(sizes))]
    outs = [[StructField(f"{r.name}__{f.name}", f.dataType, True) for f in r.out_fields] for r, _ in rules]
    width = sum(len(o) for o in outs)
    out_off = [sum(len(o) for o in outs[:i]) for i in range(len(outs))]

    def split(state):
        return [tuple(state[o : o + n]) for o, n in zip(offsets, sizes)]

    def step(state, rows, emit):
        parts = split(state)
        new = []
        for i, ((rule, col), st) in enumerate(zip(rules, parts)):
            sub = rows if col is None else rows[rows[col].astype(bool)]
            if emit is None:
                new.append(rule.step(st, sub, None))
                continue

            def emit_i(r, i=i):
                row = [None] * width
                row[out_off[i] : out_off[i] + len(r)] = list(r)
                emit((i, *row))

            new.append(rule.step(st, sub, emit_i))
        return tuple(v for st in new for v in st)

    def normalize(state, first_ts):
        return tuple(v for (rule, _), st in zip(rules, split(state)) for v in rule.normalize(st, first_ts))

    def normalize_cols(cols, first_ts):
        out = []
        for (rule, _), o, n in zip(rules, offsets, sizes):
            out += rule.normalize_cols(cols[o : o + n], first_ts)
        return out

    input_cols = []
    for rule, col in rules:
        input_cols += list(rule.input_cols) + ([col] if col else [])
    state_fields = []
    for rule, _ in rules:
        state_fields += [StructField(f"{rule.name}__{f.name}", f.dataType, True) for f in rule.state_fields]
    return SequentialRule(
        name=name,
        input_cols=list(dict.fromkeys(input_cols)),
        state_fields=state_fields,
        out_fields=[StructField("_rule", IntegerType(), True)] + [f for o in outs for f in o],
        initial=tuple(v for rule, _ in rules for v in rule.initial),
        step=step,
        normalize=normalize,
        normalize_cols=normalize_cols,
        ties=list(dict.fromkeys(c for rule, _ in rules for c in rule.ties)),
    )
