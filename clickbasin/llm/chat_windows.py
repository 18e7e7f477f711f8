"""Chat formatting in budgeted windows, with DataFrame expressions only.

A conversation's turns get running sums of their tokens. Turn-aligned spans of them become windows
that stay within a budget. Every window repeats the system turn and a limited stretch of the turns
before it; only what is new in a window bears loss, so each assistant text does so exactly once.

The running sums are taken over rows, which Spark streams and spills; what is gathered into one
row is a segment of a conversation, whose length is bounded by its tokens. So a conversation of any
length is cut into windows without being held in one place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickbasin.llm.pii import running

# The template. A turn is OPEN, role, line break, text, CLOSE. Texts are escaped so
# that "<" never occurs in them: "\" becomes "\\", "<" becomes "\l", and in roles a line break "\n".
OPEN, CLOSE = "<turn>", "</turn>\n"


@dataclass(frozen=True)
class Budget:
    """``tokens`` a window holds, ``history`` tokens it may repeat, turns of ``segment`` windows gathered at once.

    A turn costs its words and signs and ``overhead`` more, or what a column of the turns says and ``overhead``.
    What a window repeats, the system turn and the history, and what is new in it are within ``tokens`` together. A
    system turn of more than half of ``tokens`` would leave little room: it stands in the first window only.
    The one exception is a turn that exceeds its room by itself: it is kept whole, in a window whose only new turn
    it is.
    """

    tokens: int = 512
    history: int = 128
    overhead: int = 4
    segment: int = 32


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: Column, role: bool = False) -> Column:
    """The text before it was escaped: pairs of backslashes are split off first, then the rest is plain."""

    def plain(part: Column) -> Column:
        part = F.replace(part, F.lit("\\l"), F.lit("<"))
        return F.replace(part, F.lit("\\n"), F.lit("\n")) if role else part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def n_tokens(text: Column, budget: Budget) -> Column:
    """Words of any script, and signs by themselves."""
    return (F.regexp_count(text, F.lit(r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]")) + budget.overhead).cast("bigint")


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), escaped_role(turn["role"]), F.lit("\n"), escaped(turn["text"]), F.lit(CLOSE))


def segments(turns: DataFrame, budget: Budget, conv: str = "conv_id", tokens: str | None = None) -> DataFrame:
    """(conv, segment, system, turns): the turns of each segment in order, with what may be repeated before them."""
    text = F.coalesce("text", F.lit(""))
    counted = n_tokens(text, budget)
    if tokens is not None:
        given = F.col(f"`{tokens}`").cast("bigint")
        counted = F.when(given >= 0, given + budget.overhead).otherwise(counted)
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), text.alias("text"), counted.alias("tokens")
    )
    in_order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    repeated = (F.col("role") == "system") & (F.col("tokens") <= budget.tokens // 2)
    first = F.first(F.when(repeated, F.struct("role", "text", "tokens"))).over(so_far)
    rows = rows.select(
        "conv",
        F.row_number().over(in_order).alias("at"),
        "role",
        "text",
        "tokens",
        (F.sum("tokens").over(so_far) - F.col("tokens")).alias("start"),
        first.alias("system"),
    )
    rows = rows.withColumn("segment", F.expr(f"start div {budget.segment * budget.tokens}"))
    # A turn is also shown to the next segment if that begins within the history's reach.
    within = Window.partitionBy("conv").orderBy("start").rangeBetween(Window.currentRow, budget.history)
    rows = rows.withColumn("reach", F.max("segment").over(within))
    rows = rows.withColumn("to", F.explode(F.array_distinct(F.array("segment", "reach"))))
    turn = F.struct("at", (F.col("to") != F.col("segment")).alias("old"), "role", "text", "tokens", "start")
    gathered = rows.groupBy("conv", F.col("to").alias("segment")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns"),
        F.first(F.when(F.col("at") != 1, F.col("system")), ignorenulls=True).alias("system"),
    )
    return gathered


def windows(turns: DataFrame, budget: Budget = Budget(), conv: str = "conv_id", tokens: str | None = None) -> DataFrame:
    """(conv, segment, window, n_repeated, n_turns, n_tokens, formatted, loss), one row per window.

    Turns go in the order of ``turn``, equal ones by role and text, a null turn first. A null role or
    text counts as empty. Rows with a null conversation id are one conversation, repeated rows are
    turns of their own, other columns are not looked at; an empty table gives no rows. ``tokens`` names a column of
    the turns' token counts by some tokenizer; where it is null or negative, words and signs are counted. The system
    turn that is repeated is a conversation's first turn, if that is one and not too long. The first ``n_repeated``
    turns of a window were there before; ``loss`` has (start, end) of every new assistant text, in
    code points of ``formatted``, where texts stand escaped.
    """
    rows = segments(turns, budget, conv, tokens)
    fresh = F.filter("turns", lambda t: ~t["old"])
    rows = rows.withColumn("fresh", fresh)
    room = F.greatest(
        F.lit(1), F.lit(budget.tokens - budget.history) - F.coalesce(F.col("system.tokens"), F.lit(0))
    ).cast("bigint")
    # Greedy spans: a window ends before the turn that would exceed it.
    none = F.array().cast("array<struct<first:int,last:int>>")

    def take(state: Column, turn: Column) -> Column:
        open_now = (state["used"] == 0) | (state["used"] + turn["tokens"] > room)
        return F.struct(
            F.when(open_now, turn["tokens"]).otherwise(state["used"] + turn["tokens"]).alias("used"),
            F.when(open_now, turn["at"]).otherwise(state["first"]).alias("first"),
            F.when(open_now & (state["used"] > 0), F.concat(state["done"], F.array(F.struct(state["first"].alias("first"), (turn["at"] - 1).alias("last")))))
            .otherwise(state["done"])
            .alias("done"),
        )

    begin = F.struct(F.lit(0).cast("bigint").alias("used"), F.lit(0).alias("first"), none.alias("done"))
    finish = lambda s: F.concat(
        s["done"],
        F.array(F.struct(s["first"].alias("first"), F.element_at(F.col("fresh"), -1)["at"].alias("last"))),
    )
    rows = rows.where(F.size("fresh") > 0).withColumn("spans", F.aggregate("fresh", begin, take, finish))
    rows = rows.select("conv", "segment", "system", "turns", F.posexplode("spans").alias("window", "span"))
    opening = F.get(F.filter("turns", lambda t: t["at"] == F.col("span.first")), 0)["start"]
    rows = rows.withColumn("begin", opening)
    new = F.filter("turns", lambda t: t["at"].between(F.col("span.first"), F.col("span.last")) & ~t["old"])
    old = F.filter(
        "turns",
        lambda t: (t["at"] < F.col("span.first"))
        & (t["start"] >= F.col("begin") - budget.history)
        & (F.col("system").isNull() | (t["at"] > 1)),
    )
    part = lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), t["tokens"].alias("tokens"))
    held = F.when(F.col("system").isNotNull() & (F.col("span.first") > 1), F.array("system")).otherwise(
        F.array().cast("array<struct<role:string,text:string,tokens:bigint>>")
    )
    rows = rows.withColumn("repeats", F.concat(held, F.transform(old, part))).withColumn("news", F.transform(new, part))
    rows = rows.select(
        "conv",
        "segment",
        "window",
        F.size("repeats").alias("n_repeated"),
        "news",
        F.transform("repeats", _rendered).alias("before"),
        F.transform("news", _rendered).alias("after"),
        F.aggregate(
            F.concat("repeats", "news"), F.lit(0).cast("bigint"), lambda total, t: total + t["tokens"]
        ).alias("n_tokens"),
    )
    lead = F.length(F.array_join("before", ""))
    rows = rows.withColumn(
        "ends", running(F.transform("after", lambda x: F.length(x).cast("bigint")), lambda a, b: a + b)
    ).withColumn("lead", lead)

    def spot(turn: Column, i: Column) -> Column:
        end = F.col("lead") + F.get(F.col("ends"), i) - len(CLOSE)
        return F.struct(
            (end - F.length(escaped(turn["text"]))).alias("start"),
            end.alias("end"),
            (turn["role"] == "assistant").alias("bears"),
        )

    bearing = F.filter(F.transform("news", spot), lambda s: s["bears"])
    loss = F.transform(bearing, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return rows.select(
        F.col("conv").alias(conv),
        "segment",
        "window",
        "n_repeated",
        (F.col("n_repeated") + F.size("news")).alias("n_turns"),
        "n_tokens",
        F.concat(F.array_join("before", ""), F.array_join("after", "")).alias("formatted"),
        loss.alias("loss"),
    )


def turns_in(formatted: Column) -> Column:
    """The (role, text) turns that a formatted window holds, read back from it."""
    pieces = F.filter(F.split(formatted, CLOSE, -1), lambda p: p != "")

    def turn(piece: Column) -> Column:
        body = F.substring(piece, len(OPEN) + 1, 2**31 - 1)
        edge = F.instr(body, "\n")
        return F.struct(
            unescaped(F.left(body, edge - 1), role=True).alias("role"),
            unescaped(body.substr(edge + 1, F.length(body))).alias("text"),
        )

    return F.transform(pieces, turn)


def loss_texts(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped."""
    return F.transform(loss, lambda s: unescaped(formatted.substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
