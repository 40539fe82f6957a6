"""Ball k-means codes against full comparison."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import ball_codes, queries
from oracle_compare import duck

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts, entries, rounds):
    ok = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    v = [[int(np.floor(1024.0 * float(np.float32(x)))) for x in r[1]] for r in ok]
    order = sorted(range(len(ok)), key=lambda i: (ok[i][0] is None, ok[i][0] or 0, v[i]))[:entries]
    step = len(v[0]) // parts
    codes, far, books = [[0] * parts for _ in ok], [0] * len(ok), []
    for p in range(parts):
        part = [x[p * step : (p + 1) * step] for x in v]
        book = [part[i] for i in order]
        for r in range(rounds + 1):
            near = [min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(book)) for x in part]
            if r < rounds:
                for j in range(len(book)):
                    mine = [x for x, (_, k) in zip(part, near) if k == j]
                    if mine:
                        book[j] = [sum(c) // len(mine) for c in zip(*mine)]
        books.append(np.array(book))
        for i, (d, j) in enumerate(near):
            codes[i][p], far[i] = j, far[i] + d
    return sorted(((r[0], bytes(c).hex(), f, r[2]) for r, c, f in zip(ok, codes, far)), key=repr), books


def rows_like(seed, n, width):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)], rng.choice([1, 2, None])) for i in range(n)]
    rows += [(i, rows[i][1], 1) for i in range(5)] + [(7, rows[0][1], 3), (None, rows[1][1], None)]  # repeated rows and ids
    rows += [(900, None, 1), (901, [0.0] * (width - 1) + [None], 1), (902, [float("nan")] * width, 1), (903, [float("inf")] + [0.0] * (width - 1), 1)]
    rows += [(904 + i, [0.5] * width, 1) for i in range(20)]  # ties
    return rows


@pytest.mark.parametrize("entries,rounds,width", [(16, 4, 8), (256, 2, 4), (3, 1, 8), (8, 0, 4)])
def test_codes_equal_full_comparison(spark, entries, rounds, width):
    rows = rows_like(entries, 300, width)
    table = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("LABEL", "v", "code", "far")])
    coded, books = ball_codes.encode_vectors(table, entries=entries, rounds=rounds)
    want, want_books = brute(rows, 4, entries, rounds)
    assert all((a == b).all() for a, b in zip(books, want_books))
    assert sorted(map(tuple, coded.select("vec_id", F.lower(F.hex("code")), "error", "label").collect()), key=repr) == want
    by_label = {}
    for _, _, e, label in want:
        by_label[label] = by_label.get(label, 0) + e
    assert all(r["label_error"] == by_label[r["label"]] for r in ball_codes.label_errors(coded).collect())


def test_rings_compare_less_and_exactly():
    rng = np.random.default_rng(5)
    points = np.floor(rng.normal(size=(4000, 4)) * 1024).astype(np.int64)
    centres = points[:64]
    at, far = ball_codes.first_codes(points, centres)
    moved = np.array([points[at == j].sum(0) // max(1, (at == j).sum()) for j in range(64)])
    off = points - moved[at]
    radii = np.full(64, -1)
    np.maximum.at(radii, at, (off * off).sum(1))
    best, near, compared = ball_codes.Balls(moved, radii).reassign(points, at)
    want, want_near = ball_codes.first_codes(points, moved)
    assert (best == want).all() and (near == want_near).all()
    assert 0 < compared < 4000 * 63 / 2


def test_odd_tables(spark):
    empty, books = ball_codes.encode_vectors(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and all(b.size == 0 for b in books)
    nothing, _ = ball_codes.encode_vectors(spark.createDataFrame([(1, [], 1), (2, [], None)], SCHEMA))
    assert sorted((r.vec_id, bytes(r.code), r.error) for r in nothing.collect()) == [(1, b"\0\0\0\0", 0), (2, b"\0\0\0\0", 0)]
    for bad, word in [([[1.0] * 4, [1.0] * 8], "widths"), ([[1.0] * 6], "equal parts"), ([[1e30] * 4], "overflow")]:
        with pytest.raises(ValueError, match=word):
            ball_codes.encode_vectors(spark.createDataFrame([(i, v, 1) for i, v in enumerate(bad)], SCHEMA))


def test_ball_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op11_ball_codes"](spark, sf).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    want = duck(sf).execute(queries.ORACLE["op11_ball_codes"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want) and len(got) == 500
