import os
import zlib

import numpy as np
import pytest

from clickbasin.llm import entries, quality_cnn

SF_DIR = "/root/testdata/sf0.01"


def direct(net, text):
    """The probability of one text, every window of it by itself."""
    data = list(text.encode())
    data += [quality_cnn.PAD] * max(0, net.width - len(data))
    step = net.chunk - net.width + 1
    windows = [data[i : i + net.width] for i in range(max(1, len(data) - net.width + 1))]
    response = np.array([net.table[w].reshape(-1) @ net.filters + net.bias for w in windows])
    # Windows that lie on padding respond as well, in the last chunk only.
    last = step - len(windows) % step if len(windows) % step else 0
    tail = [(data[len(windows) + k :] + [quality_cnn.PAD] * net.width)[: net.width] for k in range(last)]
    response = np.vstack([response, *[net.table[w].reshape(-1) @ net.filters + net.bias for w in tail]])
    live = np.maximum(response, 0)
    chunks = np.array([live[i : i + step].max(axis=0) for i in range(0, len(live), step)])
    features = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)])
    return quality_cnn.sigmoid(features @ net.head + net.offset)


@pytest.fixture(scope="module")
def net():
    texts = [f"A calm sentence number {i}, with words in it." for i in range(60)] + [f"%%% {i} ### &&& $$$ ***" * 4 for i in range(30)]
    return quality_cnn.fit([quality_cnn.all_chunks(t) for t in texts], [1] * 60 + [0] * 30)


@pytest.mark.parametrize("text", ["", "a", "seven..", "exactly8", "Plain words. " * 30, "é😀%% ### " * 400, "x" * 121, "x" * 128, "x" * 129])
def test_scoring_covers_every_window(net, text):
    assert quality_cnn.probabilities(net, [text])[0] == pytest.approx(direct(net, text), abs=1e-4)


def test_chunks_overlap_and_cover():
    for size in (0, 1, 8, 120, 121, 122, 128, 129, 1000, 5000):
        data = bytes(i % 251 for i in range(size))
        chunks = quality_cnn.chunks_of(data, 8, 128)
        step = 121
        joined = np.concatenate([chunk[:step] for chunk in chunks[:-1]] + [chunks[-1]])
        assert joined[:size].tolist() == list(data) and (joined[size:] == quality_cnn.PAD).all()


def test_it_learns_and_one_class_is_a_constant(net):
    good, bad = quality_cnn.probabilities(net, ["Another sentence, calm as ever.", "### %%% $$$ &&& ***" * 5])
    assert good > 0.7 > 0.3 > bad
    for labels, share in (([], 0.5), ([1, 1, 1], 0.875), ([0], 0.25)):
        constant = quality_cnn.fit([quality_cnn.all_chunks("x")] * len(labels), labels)
        assert quality_cnn.probabilities(constant, ["", "any text"]) == pytest.approx([share, share])


def test_odd_rows(spark, net):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, "word " * 100_000, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = frame.withColumn("score", quality_cnn.quality(net, frame.text)).collect()
    assert got[0].score == got[1].score == got[2].score and all(0 <= r.score <= 1 for r in got)
    assert frame.where("false").withColumn("score", quality_cnn.quality(net, frame.text)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = entries.op5_quality(spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    known = [(r.predicted, labels[r.doc_id]) for r in held if r.doc_id in labels]
    assert np.mean([a == b for a, b in known]) >= 0.95
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_the_sample_is_whole_texts_of_bounded_bytes(spark, monkeypatch):
    monkeypatch.setattr(quality_cnn, "SAMPLE_BYTES", 10_000)
    seen = []
    monkeypatch.setattr(quality_cnn, "fit", lambda cut, labels: seen.extend(zip(cut, labels)))
    rows = [(n, "é" * 1000, n % 2) for n in range(8)] + [(9, "z" * 20_000, 1)]
    quality_cnn.train(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    assert len(seen) == 5 and all(cut.shape == quality_cnn.all_chunks("é" * 1000).shape for cut, _ in seen)


def test_samples_look_at_documents_first_and_take_one_row_an_id(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "CONCAT('text ', id) AS text", "'x' AS label")
    docs = docs.union(spark.range(100_000).selectExpr("7", "CONCAT('copy ', id)", "'y'")).union(spark.sql("SELECT NULL, 'no id', 'z'"))
    docs = docs.union(spark.sql("SELECT 8, CAST(NULL AS STRING), 'z'"))
    labels = spark.range(-50_000, 50_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    found = entries.labelled_sample(docs, labels, "quality", 4, 2, 200).collect()
    ids = [r.doc_id for r in found]
    assert len(ids) == len(set(ids)) == 200 and all(0 <= i < 300 and zlib.crc32(str(i).encode()) % 4 != 2 for i in ids)
    every = {r.doc_id: r.text for r in entries.labelled_sample(docs, labels, "quality", 4, 2, 100_000).collect()}
    assert every.get(7, "copy 0") == "copy 0" and every.get(8, "") == ""
    assert entries.labelled_sample(docs.where("false"), labels, "quality", 4, 2, 200).count() == 0
