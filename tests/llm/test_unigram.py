import hashlib
import os
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickbasin.llm import entries, unigram

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def full():
    return unigram.encoder(public_tokenizers.path("piece_bpe_32k.model"))


def small_vocabulary(seed=1):
    rng = random.Random(seed)
    texts = {c for c in "▁abcdeé"} | {"▁▁", "▁▁▁"}
    while len(texts) < 60:
        word = "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 5)))
        texts.add(rng.choice(["", "▁"]) + word)
    scores = {300 + i: -rng.random() * 9 for i in range(len(texts))}
    return unigram.Pieces(dict(zip(scores, sorted(texts))), scores, list(range(3, 259)))


def best_score(pieces, text):
    """The largest sum over all ways to cut a text, a character without a piece at the penalty."""
    word = "▁" + text.replace(" ", "▁") if text else ""
    by_text = {t: pieces.scores[i] for i, t in pieces.texts.items()}
    unknown = min(pieces.scores.values()) - unigram.PENALTY
    best = [0.0] + [float("-inf")] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            part = word[start:end]
            if part in by_text:
                best[end] = max(best[end], best[start] + by_text[part])
        if word[end - 1] not in by_text:
            best[end] = max(best[end], best[end - 1] + unknown)
    return best[-1]


def score_of(pieces, ids):
    """The score of an encoding: runs of byte pieces count once a character."""
    unknown = min(pieces.scores.values()) - unigram.PENALTY
    data = bytes(pieces.bytes_.index(i) for i in ids if i in set(pieces.bytes_))
    return sum(pieces.scores.get(i, 0.0) for i in ids) + unknown * len(data.decode())


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abcdeé zß\n漢", max_size=40), st.integers(0, 3))
def test_best_path_and_round_trip(text, seed):
    pieces = small_vocabulary(seed)
    encoder = unigram.Encoder(pieces)
    (ids,) = encoder.encode([text], {})
    assert encoder.decode(ids.tolist()) == text
    assert score_of(pieces, ids.tolist()) == pytest.approx(best_score(pieces, text))


def test_short_and_long_words_agree(full):
    rng = random.Random(2)
    words = ["▁" + "".join(rng.choice("abcdefghinorstué漢😀") for _ in range(rng.randrange(1, 20))) for _ in range(400)]
    for word, ids in zip(words, full.encode_short(words)):
        assert np.frombuffer(ids, "<i4").tolist() == full.encode_long(word)


def test_trie_holds_the_vocabulary():
    keys = {b"a": 1, b"ab": 2, b"\xff\x01": 3, b"b" * 40: 4, "é".encode(): 5}
    trie = unigram.DoubleArray(keys)
    for key, value in keys.items():
        node = 0
        for c in key:
            child = trie.base[node] + c + 1
            assert trie.check[child] == node
            node = child
        assert trie.value[node] == value


ODD = [None, "", " ", "▁a ▁▁ b", "  two  spaces ", "\n\t x\r", "😀é漢字\x00\x01￿", "a" * 3000 + " " + "漢" * 300]


def test_odd_rows(spark, full):
    frame = spark.createDataFrame([(t, "x") for t in ODD * 2], "text string, ids string")
    shared = spark.sparkContext.broadcast(full)
    rows = frame.withColumn("ids", unigram.pieces(shared, frame.text))
    rows = rows.withColumn("back", unigram.decoded(shared, rows.ids)).collect()
    assert [r.back for r in rows] == [t or "" for t in ODD * 2]
    assert rows[0].ids == [] and rows[1].ids == []
    given = spark.createDataFrame([(None,), ([],), ([5, -1, 10**6, None, 5],), ([3 + 0xFF],)], "ids array<int>")
    back = [r.back for r in given.select(unigram.decoded(shared, given.ids).alias("back")).collect()]
    assert back == ["", "", "\x02\x02", "\ufffd"]
    assert frame.where("false").withColumn("ids", unigram.pieces(shared, frame.text)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_query(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    rows = entries.op9_pieces(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.round_trip and r.n_pieces == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
