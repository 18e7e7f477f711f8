import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickbasin.functions.dates import fixed_clock
from clickbasin.operators.dedup import latest_per_event
from clickbasin.operators.validate import accepted, rejected, with_verdict
from clickbasin.schemas import RAW


def row(event_id, ts, user="u", event_type="search", day="05"):
    return (event_id, ts, user, None, event_type, "2024", "03", day)


def curated(spark, rows):
    return accepted(with_verdict(spark.createDataFrame(rows, RAW)), fixed_clock("2024-03-06 02:00:00"))


def test_latest_wins_also_across_event_types(spark):
    rows = [row("1", "2024-03-05 10:00:00"), row("1", "2024-03-05 11:00:00", event_type="login")]
    (kept,) = latest_per_event(curated(spark, rows)).collect()
    assert kept["event_type"] == "login"


def test_null_times_come_last(spark):
    frame = curated(spark, [row("1", "2024-03-05 10:00:00", "a"), row("1", "2024-03-05 09:00:00", "b")])
    nulled = frame.selectExpr(
        "event_id", "IF(user_id = 'a', NULL, event_ts) AS event_ts",
        *[c for c in frame.columns if c not in ("event_id", "event_ts")],
    )
    (kept,) = latest_per_event(nulled).collect()
    assert kept["user_id"] == "b"


def test_ties_give_the_same_row_whatever_the_order(spark):
    rows = [row("1", "2024-03-05 10:00:00", f"u{i}", t) for i in range(9) for t in ("login", "search")]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        (kept,) = latest_per_event(curated(spark, rows).repartition(1 + seed)).collect()
        seen.add((kept["event_type"], kept["user_id"]))
    assert seen == {("login", "u0")}


def test_days_are_separate_batches(spark):
    rows = [row("1", "2024-03-05 10:00:00"), row("1", "2024-03-05 11:00:00", day="06")]
    assert latest_per_event(curated(spark, rows), within=["year", "month", "day"]).count() == 2
    assert latest_per_event(curated(spark, rows)).count() == 1


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = latest_per_event(curated(spark, [row("1", "2024-03-05 10:00:00")]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, "", " ", "a", "b", "c"]),
            st.sampled_from([None, "bad", "2024-03-05 10:00:00", "2024-03-05 11:00:00"]),
            st.sampled_from(["u", "v", None]),
            st.sampled_from(["search", "login"]),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_brute_force(spark, picks):
    rows = [row(i, ts, user, kind) for i, ts, user, kind in picks]
    judged = with_verdict(spark.createDataFrame(rows, RAW))
    good = accepted(judged, fixed_clock("2024-03-06 02:00:00"))
    assert good.count() + rejected(judged).count() == len(rows)
    expected = {}
    for i, ts, user, kind in picks:
        if i and i.strip() and ts and ts != "bad":
            # later first; then the type and the user in ascending order, null first
            rank = ([-ord(c) for c in ts], kind, user is not None, user or "")
            candidate = (rank, (kind, user))
            expected[i] = min(expected.get(i, candidate), candidate, key=lambda e: e[0])
    kept = {r["event_id"]: (r["event_type"], r["user_id"]) for r in latest_per_event(good).collect()}
    assert kept == {i: choice for i, (_, choice) in expected.items()}
