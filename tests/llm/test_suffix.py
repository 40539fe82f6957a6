"""Induced sorting against plain sorting; removal of repeats against counting windows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import induced, queries, suffix_dedup

SCHEMA = "doc_id long, text string"


def common(t, i, j, cap):
    k = 0
    while k < cap and i + k < len(t) and j + k < len(t) and t[i + k] == t[j + k]:
        k += 1
    return k


@pytest.mark.parametrize("seed", range(8))
def test_sorted_suffixes(seed, tmp_path):
    """Tiny budgets force spilled runs, blocks of a few tuples and deep recursion."""
    rng = random.Random(seed)
    for trial in range(60):
        kinds, n, cap = rng.choice([1, 2, 3, 5, 50]), rng.randrange(1, 120), rng.choice([3, 7, 1000])
        t = [rng.randrange(1, kinds + 1) for _ in range(n)]
        if rng.random() < 0.4:
            t = (t[: max(1, n // 4)] * 5)[:n]
        t.append(0)
        limits = {"memory_rows": rng.choice([5, 40, 10**6]), "base_symbols": rng.choice([1, 4, 1000]), "block_rows": rng.choice([2, 16, 1000])}
        folder = tmp_path / str(trial)
        folder.mkdir()
        blocks = list(induced.sorted_suffixes(np.array(t, np.uint16), cap, str(folder), **limits))
        pos, lcp = (np.concatenate(c).tolist() for c in zip(*blocks))
        assert sorted(pos) == list(range(len(t))) and not any(folder.iterdir())
        for k in range(1, len(pos)):
            assert lcp[k] == common(t, pos[k], pos[k - 1], cap)
            assert t[pos[k] : pos[k] + cap] <= t[pos[k - 1] : pos[k - 1] + cap]


def test_queue_spills_and_keeps_order(tmp_path):
    rng = np.random.default_rng(1)
    queue, want = induced.TupleQueue(str(tmp_path), memory_rows=10), []
    for batch in range(20):
        key = rng.integers(0, 6, 7)
        queue.push(key, np.arange(7) + 7 * batch, np.zeros(7, np.uint16))
        want += [(int(k), 7 * batch + i) for i, k in enumerate(key)]
    got = []
    while any(len(r) for r in queue.runs):
        (key, pos, _), source = queue.peek(3)
        n = 1 + len(got) % len(key)
        queue.take(source[:n])
        got += list(zip(key[:n].tolist(), pos[:n].tolist()))
    assert queue.spilled > 3 and got == sorted(want)


def brute(rows, window):
    bodies = [(t or "").encode() for _, t in rows]
    count = {}
    for b in bodies:
        for i in range(len(b) - window + 1):
            w = b[i : i + window]
            count[w] = count.get(w, 0) + 1
    out = []
    for (d, _), b in zip(rows, bodies):
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if count[b[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def odd_rows(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(3, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in (12, 20, 40)]
    rows = [(i, text(rng.randrange(0, 30)) + rng.choice([*passages, ""]) + text(rng.randrange(0, 30))) for i in range(120)]
    rows += [(200, rows[3][1]), (3, rows[3][1]), (None, rows[5][1]), (None, rows[5][1]), (201, None), (202, ""), (203, "short")]
    rows += [(204, "a" * 700), (205, "ab" * 300 + passages[0]), (206, text(900) + passages[2] + passages[2]), (207, "x" * 55 + "y"), (208, "z" + "x" * 55)]
    return rows


@pytest.mark.parametrize("hot,piece,step,limits", [
    (256, 16, 1 << 20, {}),
    (3, 4, 300, {"memory_rows": 500, "base_symbols": 200, "block_rows": 64}),
    (1, 1, 1 << 20, {}),
    (8, 8, 1000, {"shard_bytes": 3000}),
])
def test_repeats_equal_counted_windows(spark, hot, piece, step, limits):
    """Low limits cut regions of shared anchors into pieces and single windows."""
    rows = odd_rows(hot)
    table = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("key", "low", "TEXT", "kept", "_key", "n_bytes")])
    got = suffix_dedup.remove_repeats(table, window=60, gram=16, hot_regions=hot, piece=piece, step_bytes=step, **limits)
    digest = F.sha2("kept", 256)
    assert len(got.columns) == len(table.columns) + 4
    assert sorted(map(tuple, got.select("_in0", "n_bytes", "n_removed", "n_spans", digest).collect()), key=repr) == brute(rows, 60)


def test_repeats_of_nothing(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeats_query(spark):
    """The query's own window on whole texts of a given table."""
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.QUERIES["op13_suffix_dedup"](spark, sf).collect()), key=repr)
    assert got == brute(rows, 400) and any(r[2] for r in got) and not all(r[2] for r in got)


def test_tasks_work_on_slices_of_their_batches():
    import pyarrow as pa

    from candlewick.llm import suffix_dedup as SD

    texts = ["a" * 300_000] * 10 + ["", "b" * (3 * SD.SLICE_BYTES), "c"]
    batch = pa.record_batch({"text": pa.array(texts, pa.large_string())}).slice(1)
    parts = list(SD.slices([batch], "text"))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts[1:]
    assert all(p.num_rows == 1 or sum(map(len, p.column("text").to_pylist())) <= SD.SLICE_BYTES for p in parts)


def test_only_regions_that_may_share_windows_are_sorted(spark, monkeypatch):
    """Texts that occur as whole copies only need no sorting: their regions are
    the only ones of their anchors."""
    written, write = {}, suffix_dedup.cut_lineage

    def record(df, name):
        written[name] = write(df, name)
        return written[name]

    monkeypatch.setattr(suffix_dedup, "cut_lineage", record)
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    copied, passage = [text(900) for _ in range(4)], text(300)
    rows = [(10 * i + k, t) for i, t in enumerate(copied) for k in range(3)] + [(90, text(500))]

    def check(rows):
        got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA), window=60, gram=16)
        assert sorted(map(tuple, got.select("_in0", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()), key=repr) == brute(rows, 60)

    check(rows)
    assert written["suffix-distinct"].count() > 0 and written["suffix-pieces"].count() == 0
    # a copied text that another shares in part is sorted as far as it is shared
    check(rows + [(91, text(200) + passage + text(200)), (92, passage + text(50)), (93, copied[0][:400] + text(90))])
    assert 0 < written["suffix-pieces"].count() < written["suffix-distinct"].count()


@pytest.mark.parametrize("window,gram", [(60, 16), (45, 16), (61, 32)])
def test_bodies_that_share_a_window_are_sorted(window, gram):
    rng = random.Random(window)
    text = lambda n: bytes(rng.choice(b"abc") for _ in range(n))
    anchor, bodies, at = text(gram), [], []
    ends = [(text(window), text(window)) for _ in range(3)]
    for _ in range(300):
        left, right = rng.choice(ends)[0], rng.choice(ends)[1]
        a, b = rng.randrange(window - gram + 1), rng.randrange(window - gram + 1)
        if rng.random() < 0.8:  # some bytes that no other body has
            left, right = text(window)[rng.randrange(window) :] + left[len(left) - rng.randrange(1, a + 2) :], right[: rng.randrange(b + 2)] + text(window)
        body = left[max(0, len(left) - a) :] + anchor + right[:b]
        if len(body) >= window:
            bodies.append(body)
            at.append(len(left[max(0, len(left) - a) :]))
    windows = [{(b[i : i + window], p - i) for i in range(len(b) - window + 1)} for b, p in zip(bodies, at)]
    holders = {}
    for i, found in enumerate(windows):
        for w in found:
            holders.setdefault(w, set()).add(i)
    shares = {i for some in holders.values() if len(some) > 1 for i in some}
    kept = set(np.flatnonzero(suffix_dedup.sharing(bodies, at, window, gram)).tolist())
    assert shares and shares <= kept and len(kept) < len(bodies)


def test_hash_blocks_join(monkeypatch):
    """Anchors of windows across blocks are those of the windows by themselves."""
    raw = np.random.default_rng(3).integers(97, 100, 3000).astype(np.uint8)
    raw[1000:1400] = 97
    hashes, places = suffix_dedup.anchors_of(raw, 60, 16)
    monkeypatch.setattr(suffix_dedup, "BLOCK_WINDOWS", 37)
    cut = suffix_dedup.anchors_of(raw, 60, 16)
    assert (hashes == cut[0]).all() and (places == cut[1]).all()
    for i in (0, 36, 37, 999, 1100, 2940):
        one = suffix_dedup.anchors_of(raw[i : i + 60], 60, 16)
        assert one[0][0] == hashes[i] and one[1][0] + i == places[i]
        assert suffix_dedup.gram_hashes(raw[places[i] : places[i] + 16], 16)[0] == hashes[i]


def test_stable_order():
    rng = np.random.default_rng(5)
    for top in (1, 7, 1 << 40, (1 << 63) - 1):
        values = rng.integers(0, top, 500)
        assert (induced.stable_order(values) == np.argsort(values, kind="stable")).all()
    assert len(induced.stable_order(np.empty(0, np.int64))) == 0
