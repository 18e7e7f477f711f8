import os
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickbasin.llm import components, entries, ngram_join

SF_DIR = "/root/testdata/sf0.001"


def grams(text, n=5):
    words = re.findall(r"\w+", (text or "").lower())
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, threshold=0.8):
    """{id: (class, links)} of (id, text) rows with distinct ids, pair by pair."""
    sets = {i: grams(t) for i, t in rows}
    owners = {}
    for i, own in sets.items():
        for g in own:
            owners.setdefault(g, []).append(i)
    links = {i: set() for i in sets}
    for i, own in sets.items():
        near = {}
        for g in own:
            for j in owners[g]:
                near[j] = near.get(j, 0) + 1
        for j, n in near.items():
            if j != i and n / (len(own) + len(sets[j]) - n) >= threshold:
                links[i].add(j)
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            low = min([label[i], *(label[j] for j in links[i])])
            if low < label[i]:
                label[i], changed = low, True
    return {i: (label[i], len(links[i])) for i in sets}


def found(frame):
    return {r.doc_id: (r.class_id, r.n_links) for r in frame.collect()}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_every_pair(spark, sf):
    path = SF_DIR.replace("sf0.001", sf)
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    assert found(entries.op6_ngram_join(spark, path)) == brute(rows)


def near_copies(count, edits, seed=3):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_a_large_family_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 16)
    texts = near_copies(150, 6) + near_copies(3, 2, seed=9)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert found(ngram_join.classes(frame)) == brute(list(enumerate(texts)))


def test_odd_rows(spark):
    body = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, None, "x"),
        (2, "", "x"),
        (3, "...", "x"),
        (4, body, "x"),
        (5, body.upper() + "!", None),
        (5, body.upper() + "!", None),
        (None, body, "x"),
        (6, "one two", "x"),
        (7, "One, two", "x"),
        (8, " ".join(f"w{i % 50000}" for i in range(120_000)), "x"),
        (9, body.replace("word59", "other"), "x"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    got = sorted((r.doc_id or -1, r.class_id, r.n_links, r.n_copies) for r in ngram_join.classes(frame).collect() if r.doc_id)
    assert got == [
        (1, 1, 0, 1), (2, 2, 0, 1), (3, 3, 0, 1), (4, 4, 3, 3), (5, 4, 3, 3), (5, 4, 3, 3),
        (6, 6, 1, 2), (7, 6, 1, 2), (8, 8, 0, 1), (9, 4, 3, 1),
    ]
    kept = ngram_join.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 6, 8]
    empty = frame.where("false")
    assert ngram_join.classes(empty).count() == 0 and ngram_join.one_of_each(empty).count() == 0


def test_rows_of_one_id_are_one_document(spark):
    one, two = near_copies(1, 1)[0], near_copies(1, 1, seed=8)[0]
    frame = spark.createDataFrame([(1, one), (1, two), (2, two), (3, one)], "doc_id long, text string")
    assert {r.class_id for r in ngram_join.classes(frame).collect()} == {1}
    assert ngram_join.one_of_each(frame).count() == 1


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.9, 1.0):
        join = ngram_join.Join(threshold=threshold)
        bands, rows = join.bands()
        assert 1 - (1 - threshold**rows) ** bands >= join.recall - 1e-12


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=30), min_size=1, max_size=12), st.integers(1, 5))
def test_overlaps_are_exact(sets, split):
    arrays = [np.unique(np.array(s, dtype=np.uint64)) for s in sets]
    left, right = arrays[:split], arrays
    got = ngram_join._overlaps(left, right)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in right] for a in left]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)] + [(300, 200), (300, 250)]
    frame = spark.createDataFrame(edges, "u long, v long")
    got = dict(components.components(frame).collect())
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 250: 200, 300: 200}
    assert got == want
    assert components.components(frame.where("false")).count() == 0
