import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickbasin.llm import entries, packing
from clickbasin.llm.packing import Limits

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def covered(pieces, needs):
    """Every token of every item lies in exactly one piece, and sequences have no gaps."""
    by_item, by_sequence = {}, {}
    for p in pieces:
        by_item.setdefault(p.item, []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence, []).append((p.offset, p.length))
    for spans, size in [(by_item.get(i, []), n) for i, (n, _) in enumerate(needs)] + [(v, None) for v in by_sequence.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at and length > 0
            at += length
        assert size is None or at == max(size, 0)
    return by_sequence


needs_lists = st.lists(st.integers(0, 300).flatmap(lambda n: st.tuples(st.just(n), st.integers(0, n))), max_size=40)


@settings(max_examples=150, deadline=None)
@given(needs_lists, st.integers(1, 6), st.integers(5, 64))
def test_limits_hold_together(needs, segments, loss):
    limits = Limits(tokens=64, segments=segments, loss=loss)
    pieces, _ = packing.pack(needs, limits)
    sequences = covered(pieces, needs)
    for number, spans in sequences.items():
        assert sum(n for _, n in spans) <= 64 and len(spans) <= segments
        bearing = 0
        for p in pieces:
            if p.sequence == number:
                bare = needs[p.item][0] - needs[p.item][1]
                bearing += max(0, p.start + p.length - max(p.start, bare))
        assert bearing <= loss
    assert packing.pack(needs, limits) == packing.pack(needs, limits)


@settings(max_examples=60, deadline=None)
@given(needs_lists)
def test_whole_items_stay_whole(needs):
    pieces, _ = packing.pack(needs, Limits(tokens=128, segments=8, loss=100), cut=False)
    assert sorted((p.item, p.start, p.length) for p in pieces) == [(i, 0, n) for i, (n, _) in enumerate(needs) if n]


@settings(max_examples=60, deadline=None)
@given(needs_lists)
def test_powers_of_two_need_no_padding(needs):
    limits = Limits(tokens=64)
    pieces, after = packing.in_powers_of_two(*[packing.pack(needs, limits)[0], limits, 1000])
    for spans in covered(pieces, needs).values():
        total = sum(n for _, n in spans)
        assert total == 64 or total & (total - 1) == 0


TEXTS = [
    "", "Hello world", "it's 12345  \n\n\t é😀漢 don't", "a<|endoftext|>b", "x" * 3000 + " y", "\n" * 900, "%%% ###!!",
    "word " * 3000, "   　z", "'S 'LL we'Ve",
]


def test_both_tokenizers_agree():
    plain, both = Tokenizer.from_file(PATH), packing.ByteTokenizer(PATH)
    for text in TEXTS:
        assert both.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def check_rows(rows, texts):
    plain = Tokenizer.from_file(PATH)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids = [*plain.encode(texts[doc] or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            part = np.array(ids[r.start : r.start + r.length], dtype="<u4")
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(ids)
    waste = total = 0
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
        total, waste = total + at, waste + (0 if at & (at - 1) == 0 else 1024 - at)
    assert waste <= 0.01 * total


def test_odd_rows(spark):
    texts = dict(enumerate([None, *TEXTS]))
    frame = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, ids string")
    rows = packing.packed_documents(frame.repartition(3), PATH).collect()
    check_rows(rows, texts)
    assert all(len(r.ids) == r.length for r in rows)
    assert packing.packed_documents(frame.where("false"), PATH).count() == 0
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "")], "doc_id long, text string")
    assert sum(r.length for r in packing.packed_documents(twice, PATH).collect()) == 3 + 3 + 1


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_query(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    check_rows(entries.op2_packing(spark, SF_DIR).collect(), texts)


def test_loss_column_limits_sequences(spark):
    rows = [(i, "word " * (40 + i % 7), [None, 0, 5, 30, 10_000, -1][i % 6]) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, answer int").repartition(2)
    limits = Limits(tokens=256, segments=64, loss=64)
    got = packing.packed_documents(frame, PATH, limits, loss="answer").collect()
    check_rows(got, {i: text for i, text, _ in rows})
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + r.loss_tokens
        by_sequence[r.sequence_id] = by_sequence.get(r.sequence_id, 0) + r.loss_tokens
    size = {r.doc_id: r.doc_tokens for r in got}
    assert by_doc == {i: size[i] if n is None else min(max(n, 0), size[i]) for i, _, n in rows}
    assert max(by_sequence.values()) == 64
    assert "loss_tokens" not in packing.packed_documents(frame, PATH).columns
