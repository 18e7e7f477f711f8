import base64
import hashlib
import os
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from clickbasin.llm import entries, fingerprints

SF_DIR = "/root/testdata/sf0.001"


def likeness(a, b):
    """Shared paragraphs over all paragraphs, counted plainly."""
    a, b = Counter(fingerprints.paragraphs(a)), Counter(fingerprints.paragraphs(b))
    union = sum((a | b).values())
    return 1.0 if not union else sum((a & b).values()) / union


def brute(rows):
    """Expected columns of (id, text) rows, null ids first."""
    mix = lambda t: (xxhash.xxh64_intdigest(t.encode(), seed=42) + 2**63) % 2**64
    ordered = sorted(((i if i is not None else -(2**63), t or "", i) for i, t in rows), key=lambda r: (r[0], mix(r[1]), r[1]))
    out = []
    for k, (_, text, i) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        n = len(text) // 4
        version = text[: len(text) - n] + following[:n]
        digest = hashlib.sha256(version.encode()).hexdigest()
        out.append((i, len(text), digest, round(likeness(text, version), 9), round(likeness(text, following), 9)))
    return sorted(out, key=repr)


def got(frame):
    return sorted(
        ((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in frame.collect()),
        key=repr,
    )


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    frame = entries.op3_fingerprints(spark, SF_DIR)
    assert got(frame) == brute([tuple(r) for r in rows])
    texts = dict(rows)
    by_text = {}
    for r in frame.collect():
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        assert len(base64.b64decode(r.fingerprint)) == 14 * fingerprints.CELLS


ROWS = [
    (5, "one. two. three\nfour. 😀é five"),
    (1, None),
    (2, ""),
    (3, "same. " * 400),
    (3, "same. " * 400),
    (None, "no id. at all"),
    (9, "x" * 50_000 + "\n" * 3 + "word " * 5000),
    (7, "one. two. three\nfour. 😀é five"),
]


def test_odd_rows(spark):
    frame = spark.createDataFrame([(i, t, "f") for i, t in ROWS], "doc_id long, text string, fingerprint string")
    assert got(fingerprints.with_edits(frame)) == brute(ROWS)
    assert got(fingerprints.with_edits(frame.limit(1))) == brute(ROWS[:1])
    assert fingerprints.with_edits(frame.where("false")).count() == 0


def test_texts_are_cut_without_loss():
    for _, text in ROWS:
        assert "".join(fingerprints.paragraphs(text or "")) == (text or "")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400))), min_size=1, max_size=6))
def test_differences_are_exact(pairs):
    as_digests = lambda s: fingerprints._mixed(np.array(sorted(s), dtype=np.uint64) + np.uint64(1))
    found = fingerprints.differences([as_digests(a) for a, _ in pairs], [as_digests(b) for _, b in pairs])
    assert found.tolist() == [[len(a - b), len(b - a)] for a, b in pairs]


def test_peeling_recovers_the_digests():
    keys = fingerprints._mixed(np.arange(1, 9, dtype=np.uint64))
    tables = fingerprints.Tables(1, 96)
    tables.add(keys[:5], np.zeros(5, dtype=np.int64), 1)
    tables.add(keys[3:], np.zeros(5, dtype=np.int64), -1)
    found, _, sign, empty = tables.peel()
    assert empty.all()
    assert dict(zip(found.tolist(), sign.tolist())) == {int(k): 1 for k in keys[:3]} | {int(k): -1 for k in keys[5:]}


@pytest.mark.parametrize("size", [60, 400, 10**6])
def test_ranges_of_any_size_and_ids_of_many_rows(spark, monkeypatch, size):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", size)
    rows = [(4, f"text {n} of one id. Sentence {n % 3}.") for n in range(120)] + [(None, f"none {n}") for n in range(60)]
    rows += [(n, f"document {n}. It goes on." * (n % 4)) for n in range(-10, 30)] + [(2**62, "last"), (-(2**63), "first"), (7, "same")] + [(7, "same")] * 20
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(fingerprints.with_edits(frame)) == brute(rows)


def test_an_insertion_at_the_front_changes_little():
    rng = np.random.default_rng(6)
    chinese = "".join(chr(c) for c in rng.integers(0x4E00, 0x9FA5, 640))
    words = " ".join("".join(chr(c) for c in rng.integers(97, 123, rng.integers(2, 9))) for _ in range(400))
    for text in (chinese, words, "word " * 400, "a line of words\n" * 30, "。".join([chinese[:30]] * 30)):
        assert likeness(text, "x" + text) > 0.9 and likeness(text, text[:-1]) > 0.9
        middle = text[: len(text) // 2] + "yy" + text[len(text) // 2 :]
        assert likeness(text, middle) > 0.85


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab 。!\n😀x", max_size=400))
def test_any_text_is_cut_without_loss(text):
    assert "".join(fingerprints.paragraphs(text)) == text and all(fingerprints.paragraphs(text))
