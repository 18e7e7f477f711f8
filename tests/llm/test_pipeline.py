import os
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_ngram_join import brute
from test_packing import check_rows
from test_pii import BASE, holds

import __spark_entry__ as contract
import corpus_pipeline
from clickbasin.llm import packing, quality_cnn, toxicity
from clickbasin.llm.support import labelled_sample, stored

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def masked_plainly(text):
    """The base kinds masked by plain patterns; the given tables have no others that overlap them."""
    spans = sorted(
        (m.start(), m.end(), kind) for kind, p in BASE.items() for m in re.finditer(p, text or "") if holds(kind, m.group())
    )
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + (text or "")[at:]


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    columns = docs.columns

    kept = stored(corpus_pipeline.quality(spark, docs, SF_DIR), "test")
    net = quality_cnn.train(labelled_sample(docs, labels, "quality", 4, 2, quality_cnn.SAMPLE_ROWS))
    rows = docs.collect()
    scores = quality_cnn.probabilities(net, [r.text for r in rows])
    assert sorted(r.doc_id for r in kept.collect()) == [r.doc_id for r, s in sorted(zip(rows, scores)) if s >= 0.5]
    assert kept.columns == columns

    civil = stored(corpus_pipeline.clean(spark, kept, SF_DIR), "test")
    lexicon = toxicity.learn(labelled_sample(kept, labels, "toxic", 3, 1, toxicity.SAMPLE_ROWS))
    automaton = lexicon.automaton()
    want = [
        r.doc_id for r in kept.collect()
        if toxicity.probability(lexicon.curve, *toxicity.measures(automaton, r.text)) < 0.7
    ]
    assert sorted(r.doc_id for r in civil.collect()) == sorted(want) and civil.columns == columns

    one = stored(corpus_pipeline.distinct(spark, civil, SF_DIR), "test")
    classes = brute([(r.doc_id, r.text) for r in civil.collect()])
    assert sorted(r.doc_id for r in one.collect()) == sorted(i for i, (c, _) in classes.items() if c == i)
    assert one.columns == columns

    masked = stored(corpus_pipeline.private(spark, one, SF_DIR), "test")
    texts = {r.doc_id: r.text for r in one.collect()}
    for r in masked.collect():
        assert re.sub(r"\[(IBAN|SSN)\]", "", r.text) == r.text and r.text == masked_plainly(texts[r.doc_id])
        assert r.n_chars == len(r.text)
    assert masked.columns == columns

    final = corpus_pipeline.packed(spark, masked, SF_DIR).collect()
    check_rows(final, {r.doc_id: r.text for r in masked.collect()})


def test_run_is_the_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "personal_data", "packing"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), "test")
    check_rows(contract.queries()["pipeline"](spark, SF_DIR).collect(), {r.doc_id: r.text for r in docs.collect()})


def test_odd_rows_pass_through(spark, tmp_path):
    rows = [
        (1, None, "en", None, None, "a"), (2, "", None, "s", 0, "b"), (3, "Some words here. And more of them.", "en", "s", 1, "c"),
        (3, "Some words here. And more of them.", "en", "s", 1, "c"), (None, "No id, but mail a@b.co.", "en", "s", 1, "d"),
        (5, "long words " * 40_000, "en", "s", 1, "e"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    docs = spark.createDataFrame(rows, schema)
    sf_dir = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    for frame, count in ((docs, 5), (docs.where("false"), 0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = stored(stage(spark, frame, sf_dir), "test")
            assert frame.columns == docs.columns, name
        # Without labels nothing is rejected; repeated rows become one.
        assert frame.count() == count
        assert frame.where(F.col("text").contains("[EMAIL]")).count() == count // 5
        last = corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir)
        plain = packing.ByteTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
        assert sum(r.length for r in last.collect()) == sum(len(plain.ids(r.text or "")) + 1 for r in frame.collect())
