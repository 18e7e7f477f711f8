import hashlib
import os
import re

import pytest

from clickbasin.llm import entries, pii

SF_DIR = "/root/testdata/sf0.001"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def expected(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in BASE.items()
        for m in re.finditer(pattern, text or "")
        if holds(kind, m.group())
    ]


def base_of(listed):
    return [s for s in listed.split(",") if s and s.split(":")[0] in BASE]


TRICKY = [
    None,
    "",
    "plain words only",
    "write to a@b.co.d_e@f.org, x@y and .@z.com%a@b.c",
    "a@b.c@d.e.f@g.h",
    "1.2.3.4.5.6.7.8 and 256.1.1.1 000255.0.0.1 1.2.3",
    "4111 1111 1111 1111 then 4111-1111-1111-1111-4111 and 4111111111111112",
    "5500 0000 0000 0004 5500 0000 0000 0004",
    "+1 (988) 555-2485, +49 30 1234567. +1 22 +123456789012345678 ++1-2",
    "é😀 a@b.co é 10.0.0.1 ñ +1 988 555 2485",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, not DE88 3704 0044 0532 0130 00",
    "SSN 123-45-6789" + " and so on" * 6 + " with part 123-45-6788",
    "+1 10.0.0.1 5555555 a@b.co",
    "1" * 5000 + " " + "a" * 5000 + "@x." + "(" * 3000,
    "\U0010ffff￿ a@b.co ￿",
]


def test_spans_match_plain_patterns(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string")
    rows = pii.with_spans(frame).select("doc_id", pii.listed(pii.F.col("spans")).alias("s")).collect()
    for row in rows:
        assert base_of(row.s) == expected(TRICKY[row.doc_id]), TRICKY[row.doc_id][:80]


def test_more_kinds_and_scores(spark):
    frame = spark.createDataFrame([(TRICKY[10],), (TRICKY[11],)], "text string")
    first, second = pii.with_spans(frame).collect()
    assert [(s.kind, s.start, s.end) for s in first.spans if s.kind == "iban"] == [("iban", 5, 32), ("iban", 37, 59)]
    assert [(s.kind, s.score) for s in second.spans] == [("ssn", 0.5), ("ssn", 0.0)]


def test_many_spans_use_blocks(spark):
    text = "é a@b.co 10.0.0.1, " * 2000
    frame = spark.createDataFrame([(text,)], "text string")
    row = pii.with_spans(frame).select(pii.listed(pii.F.col("spans")).alias("s")).first()
    assert base_of(row.s) == expected(text)
    assert pii.masked(frame).first().text == "é [EMAIL] [IP], " * 2000


def test_masking(spark):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TRICKY)], "doc_id long, text string, spans string")
    got = pii.masked(frame)
    assert got.columns == frame.columns
    got = {row.doc_id: row.text for row in got.collect()}
    assert got[0] is None and got[1] == "" and got[2] == TRICKY[2]
    assert got[12] == "[PHONE] [EMAIL]"
    assert got[9] == "é😀 [EMAIL] é [IP] ñ [PHONE]"
    assert got[11] == TRICKY[11].replace("123-45-6789", "[SSN]")


def test_empty_table_and_clashing_names(spark):
    frame = spark.createDataFrame([], "text string, `_ip_match` int, `a.b` int")
    assert pii.with_spans(frame).count() == 0
    assert pii.masked(frame).columns == frame.columns


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_query(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    frame = entries.op10_pii(spark, SF_DIR)
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()
    rows = frame.collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = expected(texts[row.doc_id])
        assert base_of(row.spans) == want
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert row.n_email == sum(s.startswith("email") for s in want)


def test_nearby_words_are_seen_across_other_spans(spark):
    far = "x " * 4088 + "SSN: 123-45-6789, 234-56-7890"
    texts = ["SSN: 123-45-6789, 234-56-7890, 345-67-8901", "123-45-6789, 234-56-7890 (ssn)", far, "SSN" + " " * 46 + "123-45-6789"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    scores = {r.doc_id: [s.score for s in r.spans] for r in pii.with_spans(frame).collect()}
    assert scores == {0: [0.5] * 3, 1: [0.5] * 2, 2: [0.5] * 2, 3: [0.3]}
    got = {r.doc_id: r.text for r in pii.masked(frame).collect()}
    assert got[0] == "SSN: [SSN], [SSN], [SSN]" and got[2].endswith("SSN: [SSN], [SSN]") and got[3] == texts[3]


@pytest.mark.parametrize(
    "text, masked",
    [
        ("version 1.2.3.4 is out", "version 1.2.3.4 is out"), ("host 1.2.3.4 is out", "host [IP] is out"), ("at 1.2.3.4 then", "at [IP] then"),
        ("server version at 1.2.3.4", "server version at [IP]"), ("ipso facto versional 1.2.3.4", "ipso facto versional [IP]"),
        ("isbn 4111 1111 1111 1111", "isbn 4111 1111 1111 1111"), ("card 4111 1111 1111 1111", "card [CARD]"),
        ("it equals +12 3456 789", "it equals +12 3456 789"), ("summer party, tell them +12 3456 789", "summer party, tell them [PHONE]"),
        ("noreply: a@example.com", "noreply: [EMAIL]"), ("ssn 123-45-6789", "ssn [SSN]"), ("123-45-6789", "123-45-6789"),
    ],
)
def test_words_nearby_mask_and_clear(spark, text, masked):
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.masked(frame).first().text == masked
    # Spans are listed whatever their score.
    assert pii.with_spans(frame).selectExpr("size(spans) AS n").first().n == 1
