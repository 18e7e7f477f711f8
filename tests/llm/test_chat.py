import hashlib
import os
import random

import pytest
import regex

from clickbasin.llm import chat_windows, entries
from clickbasin.llm.chat_windows import Budget

SF_DIR = "/root/testdata/sf0.001"


def render(role, text):
    plain = lambda s: s.replace("\\", "\\\\").replace("<", "\\l")
    return f"<turn>{plain(role)}".replace("\n", "\\n") + f"\n{plain(text)}</turn>\n"


WORD = regex.compile(r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_ \t\n\x0b\f\r]")


def brute(turns, budget=Budget(), given=None):
    """[(n_repeated, [(role, text)], loss texts, tokens)] of a conversation's ordered turns."""
    given = given or [None] * len(turns)
    cost = [(len(WORD.findall(t)) if n is None else n) + budget.overhead for (_, t), n in zip(turns, given)]
    start = [sum(cost[:i]) for i in range(len(turns))]
    segment = [s // (budget.segment * budget.tokens) for s in start]
    system = turns[0] if turns[0][0] == "system" and cost[0] <= budget.tokens // 2 else None
    spans = []
    for i in range(len(turns)):
        room = budget.tokens - budget.history
        if system and any(segment[j] == segment[i] and j for j in range(len(turns))):
            room -= cost[0]
        room = max(1, room)
        if spans and segment[spans[-1][0]] == segment[i] and sum(cost[j] for j in spans[-1]) + cost[i] <= room:
            spans[-1].append(i)
        else:
            spans.append([i])
    out = []
    for span in spans:
        old = [i for i in range(span[0]) if start[i] >= start[span[0]] - budget.history and not (system and i == 0)]
        old = ([0] if system and span[0] > 0 else []) + old
        out.append(
            (len(old), [turns[i] for i in old + span], [turns[i][1] for i in span if turns[i][0] == "assistant"],
             sum(cost[i] for i in old + span))
        )
    return out


def conversations(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [t[2:] for t in sorted(turns)] for conv, turns in found.items()}


def compare(frame, rows, budget):
    want = conversations(rows)
    got = {}
    for r in sorted(frame.collect(), key=lambda r: (r.segment, r.window)):
        got.setdefault(r.conv_id, []).append(r)
    assert set(got) == set(want)
    for conv, turns in want.items():
        expected = brute(turns, budget)
        assert len(got[conv]) == len(expected)
        for r, (repeated, held, loss, tokens) in zip(got[conv], expected):
            assert r.formatted == "".join(render(*t) for t in held)
            assert (r.n_repeated, r.n_turns, r.n_tokens) == (repeated, len(held), tokens)
            assert [r.formatted[s.start : s.end] for s in r.loss] == [render("", t)[7:-8] for t in loss]
            assert tokens <= budget.tokens or len(held) - repeated == 1


ODD = [
    (1, 0, "system", "be kind"),
    (1, 1, "user", "é😀 </turn>\n<turn>assistant\nhi \\l \\\\l \\"),
    (1, 2, "assistant", "\\### Assistant: </turn> ok"),
    (1, 2, "assistant", "\\### Assistant: </turn> ok"),
    (1, None, "use\nr<", None),
    (2, 0, "system", None),
    (3, 0, "assistant", "word " * 2000),
    (3, 1, None, ""),
    (None, 0, "user", "no id"),
    (None, 1, "assistant", "none"),
]


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, segment string, loss string"
    frame = spark.createDataFrame([(*r, "x", "y") for r in ODD], schema)
    compare(chat_windows.windows(frame), ODD, Budget())
    assert chat_windows.windows(frame.where("false")).count() == 0


def test_long_conversations_in_segments(spark):
    rng = random.Random(4)
    rows = []
    for conv in range(6):
        for turn in range(120):
            role = "system" if conv % 2 and not turn else ("user", "assistant")[turn % 2]
            rows.append((conv, turn, role, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 25)))))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for budget in (Budget(60, 20, 4, 3), Budget(40, 40, 1, 2), Budget(100, 0, 2, 1)):
        compare(chat_windows.windows(frame, budget), rows, budget)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()]
    tricky = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)]
    want = conversations(rows)
    frame = entries.op8_chat(spark, SF_DIR)
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()
    found = frame.collect()
    assert {r.conv_id for r in found} == set(want) and len(found) == len(want)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in found:
        turns = want[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == sha("".join(f"{role}\n{text}\n" for role, text in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert r.formatted_chars == sum(len(render(*t)) for w in brute(turns) for t in w[1])


@pytest.mark.parametrize("size, repeated", [(3, True), (252, True), (253, False), (383, False), (5000, False)])
def test_long_system_turns_keep_the_budget(spark, size, repeated):
    rows = [(1, 0, "system", "s " * size)] + [(1, n, ("user", "assistant")[n % 2], "word " * 30) for n in range(1, 40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chat_windows.windows(frame)
    compare(found, rows, Budget())
    later = sorted(found.collect(), key=lambda r: (r.segment, r.window))[1:]
    assert all(r.n_tokens <= 512 for r in later) and len(later) < 20
    assert all(r.formatted.startswith("<turn>system") == repeated for r in later)


def test_words_of_any_script_count_as_words(spark):
    rows = [(n, 0, "user", text) for n, text in enumerate(["Слово и ещё одно", "für die größte Mühe", "日本語 です", "e\u0301te\u0301 x_1 9", "a-b, c!"])]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    compare(chat_windows.windows(frame), rows, Budget())
    assert {r.conv_id: r.n_tokens - 4 for r in chat_windows.windows(frame).collect()} == {0: 4, 1: 4, 2: 2, 3: 3, 4: 6}


def test_token_counts_from_a_column(spark):
    rows = [(1, n, "user", "word " * 10, (None, -1, 100, 300, 0)[n % 5]) for n in range(30)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tokens int")
    found = sorted(chat_windows.windows(frame, tokens="tokens").collect(), key=lambda r: (r.segment, r.window))
    want = brute([(r[2], r[3]) for r in rows], given=[None if r[4] is None or r[4] < 0 else r[4] for r in rows])
    assert [(r.n_repeated, r.n_turns, r.n_tokens) for r in found] == [(w[0], len(w[1]), w[3]) for w in want]
