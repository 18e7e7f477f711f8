import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from clickbasin.llm import vector_codes

NAN, INF = float("nan"), float("inf")


def plain(rows):
    """Codes and errors with every distance computed, in Python's whole numbers."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for size in {len(v) for _, v, _ in kept}:
        own = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in kept if len(v) == size]
        width = -(-size // 16)
        cut = [[(v + [0] * (16 * width))[p * width : (p + 1) * width] for p in range(16)] for _, v, _ in own]
        first = sorted(range(len(own)), key=lambda n: (own[n][0] is None, own[n][0] or 0, own[n][1]))[:64]
        books = [[cut[n][p] for n in first] for p in range(16)]

        def assign():
            return [[min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p])) for p, x in enumerate(parts)] for parts in cut]

        for _ in range(2):
            groups = defaultdict(list)
            for parts, found in zip(cut, assign()):
                for p, (_, k) in enumerate(found):
                    groups[p, k].append(parts[p])
            for (p, k), members in groups.items():
                books[p][k] = [sum(column) // len(members) for column in zip(*members)]
        text = ",".join(str(x) for book in books for entry in book for x in entry)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for (i, _, label), found in zip(own, assign()):
            out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label, sha))
    errors = defaultdict(int)
    for _, _, error, label, _ in out:
        errors[label] += error
    return sorted(((i, code, error, errors[label], sha) for i, code, error, label, sha in out), key=repr)


def compressed(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(parts)
    return sorted((tuple(row) for row in vector_codes.compressed(frame).collect()), key=repr)


def made(n, size, seed, scale=0.2):
    x = (np.random.default_rng(seed).normal(0, scale, (n, size))).astype(np.float32)
    return [(i * 3 - 20, v, None if i % 7 == 0 else i % 3) for i, v in enumerate(x.tolist())]


def test_as_with_every_distance(spark):
    rows = made(300, 32, 1)
    assert compressed(spark, rows) == plain(rows)


def test_ties_copies_and_odd_lengths(spark):
    # Few distinct small vectors, so that entries coincide and distances tie; lengths that 16 does not divide.
    rng = np.random.default_rng(2)
    rows = [(i % 90, rng.integers(-1, 2, 20).astype(float).__truediv__(256).tolist(), i % 2) for i in range(150)]
    rows += [(i, [0.5] * 16, None) for i in range(70)] + [(None, [0.25] * 16, 1), (500, [], 5), (501, [], 5)]
    rows += [(-1, [-0.001] * 20, 9)]
    assert compressed(spark, rows) == plain(rows)


def test_what_is_dropped(spark):
    rows = [(1, None, 0), (2, [1.0, None] * 8, 0), (3, [NAN] * 16, 0), (4, [1.0] * 15 + [INF], 0), (5, [0.0] * 16, 0), (6, [2.0] * 16, None)]
    got = compressed(spark, rows)
    assert got == plain(rows) and [row[0] for row in got] == [5, 6]


def test_large_components_and_empty_tables(spark):
    rows = [(1, [3e38] * 16, 0), (2, [-3e38] * 16, 0), (3, [0.0] * 16, 0)]
    assert [row[2] for row in compressed(spark, rows)] == [0, 0, 0]
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_codes.compressed(frame).count() == 0
    frame = spark.createDataFrame([(1, [1.0] * 16, 2, "x", 3)], "vec_id long, embedding array<double>, label int, code string, size int")
    row = vector_codes.compressed(frame).first()
    assert (row.vec_id, row.code, row.error, row.label_error) == (1, "00" * 16, 0, 0)


@pytest.mark.parametrize("width", [1, 4, 9])
def test_balls_skip_work_and_change_nothing(width):
    rng = np.random.default_rng(width)
    centres = rng.integers(-400, 400, (64, width))
    x = (centres[rng.integers(0, 64, 4000)] + rng.integers(-9, 10, (4000, width))).astype(np.int64)
    held, _ = vector_codes.Balls(centres.astype(np.int64)).nearest(x, None, vector_codes.Work())
    moved = vector_codes.Balls(centres + rng.integers(-3, 4, centres.shape))
    work = vector_codes.Work()
    code, error = moved.nearest(x, held.astype(np.uint8), work)
    full, full_error = moved.nearest(x, None, vector_codes.Work())
    assert (code == full).all() and (error == full_error).all()
    assert work.done < 0.5 * work.full


def test_large_numbers_are_exact():
    rng = np.random.default_rng(0)
    x = rng.integers(-(2**24), 2**24, (50, 4))
    found = vector_codes._squared(x, x[:10])
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, e)) for e in x[:10]] for v in x]
    assert found.tolist() == want
