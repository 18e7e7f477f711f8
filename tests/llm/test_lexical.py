import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from clickbasin.llm import lexical
from clickbasin.llm.support import stored

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, k):
    """Every document scored for every item, in whole numbers."""
    held = [(doc_id, Counter(words)) for doc_id, text in docs if (words := plain_terms(text))]
    big_n, big_l = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(term for _, c in held for term in c)
    out = {}
    for item in {i for i, _ in items}:
        wanted = {t for i, text in items if i == item for t in plain_terms(text)}
        scores = []
        for doc_id, counts in held:
            m = 100 - 50 + (50 * sum(counts.values()) * big_n) // big_l
            score = sum(
                math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((1000000000 * counts[t]) // (1000 * counts[t] + 20 * m))
                for t in wanted
                if t in counts
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out[item] = [(rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:k], 1)]
    return {item: rows for item, rows in out.items() if rows}


def made_docs(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Ünlü", "ÉTÉ", "日本語", "naïve", "X9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, rng.choice([" ", ", ", "\n", "_"]).join(rng.choices(words, weights, k=rng.choice([1, 5, 40, 300])))) for i in range(n)]
    return docs, [(i, " ".join(rng.choices(words, k=12))) for i in range(9)]


def result(found):
    out = {}
    for row in sorted(found.collect(), key=lambda r: (str(r.item_id), r.rank)):
        out.setdefault(row.item_id, []).append((row.rank, row.doc_id, row.score))
    return out


def searched(spark, docs, items, k):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return result(lexical.search(stored(lexical.build(docs), "index"), spark.createDataFrame(items, "item_id long, text string"), k))


@pytest.mark.parametrize("text", ["", "A-b_C9 Ü x", "İ ſ K", "tab\tnul\x00del\x7f{}", "日本、語 ÀÉ"])
def test_terms(text):
    assert [t.decode() for t in lexical.terms_of(text.encode())] == plain_terms(text)


@pytest.mark.parametrize("k", [1, 7, 50])
def test_as_scoring_every_document(spark, monkeypatch, k):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 40)
    monkeypatch.setattr(lexical, "ITEMS", 4)
    docs, items = made_docs(400, 3)
    assert searched(spark, docs, items, k) == plain_search(docs, items, k)


def test_bounds_hold_and_leave_most_documents_out(spark):
    docs, items = made_docs(600, 5)
    rows = [lexical._block([(i, t.encode()) for i, t in docs])]
    frame = stored(lexical.build(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)), "index")
    corpus = lexical.corpus_of(frame)
    assert (corpus.documents, corpus.terms) == (600, sum(len(plain_terms(t)) for _, t in docs))
    some = lexical.items_of([(i, sorted({w.encode() for w in plain_terms(t)})) for i, t in items], frame, corpus)
    block = lexical._Block(rows[0], corpus)
    bounds = block.bounds(some)
    item, doc = np.nonzero(np.ones(bounds.shape, bool))
    scores = block.scores(some, item, doc).reshape(bounds.shape)
    assert (bounds >= scores).all()
    # Not vacuous: bounds are close, and few pairs beyond the best have to be scored.
    assert bounds.sum() < 1.5 * scores.sum()
    _, tally = lexical.search_counted(frame, spark.createDataFrame(items, "item_id long, text string"), 5)
    row = tally.first()
    assert row.pairs == 600 * len(items) and row.scored < 0.5 * row.pairs


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,; "), (4, "alpha beta"), (4, "alpha beta"), (None, "alpha beta"), (-5, "alpha beta"),
            (6, "alpha " * 40_000), (7, "gamma"), (7, "delta alpha"), (8, "x" * 300_000 + " beta")]
    items = [(1, "Alpha, BETA"), (2, None), (3, "nowhere"), (4, ""), (5, "gamma"), (5, "delta"), (None, "alpha")]
    for k in (2, 50):
        got = searched(spark, docs, items, k)
        assert got == plain_search(docs, items, k)
    # Ties by ascending id, a null id last, copies each by themselves.
    assert [doc for _, doc, _ in searched(spark, docs, items, 50)[1]][:4] == [-5, 4, 4, None]


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "alpha", 2, "b")], "doc_id long, text string, block int, terms string")
    items = spark.createDataFrame([(1, "alpha", 0, 0, 0)], "item_id long, text string, item int, rank int, `group` int")
    index = stored(lexical.build(docs), "index")
    assert result(lexical.search(index, items)) == plain_search([(1, "alpha")], [(1, "alpha")], 50)
    assert lexical.search(index, items.where("false")).count() == 0
    none = stored(lexical.build(docs.where("false")), "index")
    assert lexical.search(none, items).count() == 0
    assert lexical.search(none, items).columns == ["item_id", "rank", "doc_id", "score"]
