"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Nearby are the 48 characters on each side of a span, whatever they hold, other spans included.
Everything is a DataFrame expression over one text column: no Python runs on the executors and
nothing is shuffled. Offsets are code points, ends are exclusive. Every pattern needs time in
proportion to the text: runs are taken possessively and never started in their middle, which finds
the same spans as plain greedy matching does.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickbasin.llm.support import free_name

Check = Callable[[Column], Column]


@dataclass(frozen=True)
class Kind:
    """``hint`` is a cheap test that a text must pass before ``pattern`` is tried on it.

    ``score`` is what a confirmed span has by itself; ``near`` words raise and ``far`` words lower it.
    """

    name: str
    pattern: str
    hint: Callable[[Column], Column]
    check: Check
    score: float
    near: str
    far: str = ""


def _always(match: Column) -> Column:
    return F.lit(True)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _byte_parts(match: Column) -> Column:
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _luhn(match: Column) -> Column:
    return F.call_function("luhn_check", _digits(match))


def _phone_digits(match: Column) -> Column:
    return F.length(_digits(match)).between(8, 15)


def _mod_97(match: Column) -> Column:
    """Country and check digits moved to the end, letters as 10 to 35: the remainder by 97 must be 1."""
    plain = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def add(rest: Column, at: Column) -> Column:
        code = F.ascii(moved.substr(at, F.lit(1)))
        value = F.when(code >= 65, code - 55).otherwise(code - 48)
        return (rest * F.when(value >= 10, 100).otherwise(10) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def _issued(match: Column) -> Column:
    return ~match.rlike("^(?:000|666|9)|-00-|-0000$")


# The first four kinds, their patterns and their order.
BASE = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda text: text.contains("@"),
        _always,
        0.9,
        r"e?mails?|contact|write|reach|kontakt|correo",
        r"example|noreply",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda text: text.rlike(r"[0-9]\.[0-9]"),
        _byte_parts,
        0.6,
        r"ip|ips|ipv4|address|addresses|hosts?|servers?|login|clients?|adresse",
        r"versions?|releases?|sections?|chapters?",
    ),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
        lambda text: text.rlike(r"[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]"),
        _luhn,
        0.7,
        r"cards?|visa|mastercard|credit|payments?|karte|kreditkarte|carte|tarjeta",
        r"isbn|serial|tracking",
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        lambda text: text.contains("+"),
        _phone_digits,
        0.6,
        r"phones?|telephone|call|tel|mobile|fax|whatsapp|telefon|appel",
        r"equals|minus|sum of",
    ),
)
MORE = (
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
        lambda text: text.rlike("[A-Z]{2}[0-9]{2}"),
        _mod_97,
        0.9,
        r"iban|accounts?|bank|konto|compte|cuenta",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda text: text.rlike("[0-9]{3}-[0-9]{2}-"),
        _issued,
        0.3,
        r"ssn|social|security|taxpayer",
        r"parts?|orders?|invoices?",
    ),
)
KINDS = BASE + MORE
NEAR_CHARS = 48
# Words for another meaning weigh more, so that they alone take a span below what is masked, except one that has
# little other meaning; with a word for the meaning beside them it stays above.
RAISE, LOWER = 0.2, 0.35
# Spans that score so much are masked.
CERTAIN = 0.4
# Arrays are summed up, and texts cut, in pieces of these sizes, so that the time stays linear.
RUN, BLOCK = 256, 8192


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, also where the body is a loop."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """The running sum or maximum of an array of longs, in blocks: appending to one array is quadratic."""
    empty = F.array().cast("array<bigint>")

    def short(part: Column) -> Column:
        def add(done: Column, value: Column) -> Column:
            last = F.try_element_at(done, F.lit(-1))
            return F.concat(done, F.array(F.when(last.isNull(), value).otherwise(join(last, value))))

        return F.aggregate(part, empty, add)

    count = F.ceil(F.size(values) / RUN).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: short(F.slice(values, b * RUN + 1, RUN)))

    def shifted(both: Column) -> Column:
        add = lambda block, b: F.when(b == 0, block).otherwise(
            F.transform(block, lambda v: join(F.get(both["before"], b - 1), v))
        )
        return F.flatten(F.transform(both["blocks"], add))

    with_last = _let(
        blocks,
        lambda found: F.struct(
            found.alias("blocks"), short(F.transform(found, lambda block: F.element_at(block, -1))).alias("before")
        ),
    )
    return (
        F.when(F.size(values) == 0, empty)
        .when(F.size(values) <= RUN, short(values))
        .otherwise(_let(with_last, shifted))
    )


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _cut_in_blocks(whole: Column) -> Column:
    return F.regexp_extract_all(whole, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _between(blocks: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end``, of which only the blocks in question are read."""
    a, b = (start / BLOCK).cast("int"), (end / BLOCK).cast("int")
    in_a, in_b = (start % BLOCK).cast("int"), (end % BLOCK).cast("int")
    piece = lambda i: F.coalesce(F.get(blocks, i), F.lit(""))
    return F.when(a == b, piece(a).substr(in_a + 1, in_b - in_a)).otherwise(
        F.concat(
            piece(a).substr(in_a + 1, F.lit(BLOCK)),
            F.array_join(F.slice(blocks, a + 2, F.greatest(b - a - 1, F.lit(0))), ""),
            F.left(piece(b), in_b),
        )
    )


def _score(kind: Kind, before: Column, after: Column) -> Column:
    def weigh(around: Column) -> Column:
        score = F.lit(kind.score)
        score = score + F.when(around.rlike(rf"\b(?:{kind.near})\b"), RAISE).otherwise(0.0)
        if kind.far:
            score = score - F.when(around.rlike(rf"\b(?:{kind.far})\b"), LOWER).otherwise(0.0)
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(score, 2)))

    return _let(F.lower(F.concat(before, F.lit(" "), after)), weigh)


def _of_one_kind(frame: DataFrame, kind: Kind, whole: Column, held: str) -> DataFrame:
    """Adds ``held``: the confirmed spans of one kind, null where the pattern is not found."""
    taken = [*frame.columns, held]
    match_name, gap_name, start_name, blocks_name = (
        free_name(f"_{kind.name}_{part}", taken) for part in ("match", "gap", "start", "blocks")
    )
    match, gap, start, blocks = F.col(match_name), F.col(gap_name), F.col(start_name), F.col(blocks_name)
    some = F.size(match) > 0
    found = F.regexp_extract_all(whole, F.lit(kind.pattern), F.lit(0))
    frame = frame.withColumn(match_name, F.when(kind.hint(whole), found).otherwise(F.array().cast("array<string>")))
    frame = frame.withColumn(gap_name, F.when(some, F.split(whole, kind.pattern, -1)))

    def step(m: Column, i: Column) -> Column:
        previous = F.when(i > 0, F.length(F.get(match, i - 1))).otherwise(0)
        return (F.length(F.get(gap, i)) + previous).cast("bigint")

    def span(m: Column, i: Column) -> Column:
        first, end = F.get(start, i), F.get(start, i) + F.length(m)
        before = _between(blocks, F.greatest(first - NEAR_CHARS, F.lit(0)), first)
        after = _between(blocks, end, end + NEAR_CHARS)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            first.alias("start"),
            end.alias("end"),
            F.when(kind.check(m), _score(kind, before, after)).alias("score"),
        )

    frame = frame.withColumn(start_name, F.when(some, running(F.transform(match, step), _sum)))
    frame = frame.withColumn(blocks_name, F.when(some, _cut_in_blocks(whole)))
    spans = F.filter(F.transform(match, span), lambda s: s["score"].isNotNull())
    return frame.withColumn(held, F.when(some, spans)).drop(match_name, gap_name, start_name, blocks_name)


def with_spans(frame: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Adds ``out``: an array of (kind, start, end, score), by kind as listed, then by start.

    A null or empty text has no spans. A column that is called ``out`` is replaced; other columns
    stay, whatever their names. Rows are independent of each other: repeated rows and ids give
    repeated results, an empty table gives an empty one.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = []
    for kind in KINDS:
        found.append(free_name(f"_{kind.name}_spans", [*frame.columns, out]))
        frame = _of_one_kind(frame, kind, whole, found[-1])
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    return frame.withColumn(out, F.concat(*[F.coalesce(F.col(held), none) for held in found])).drop(*found)


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def of_kinds(spans: Column, kinds: tuple[Kind, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin([kind.name for kind in kinds]))


def masked(frame: DataFrame, text: str = "text", certain: float = CERTAIN) -> DataFrame:
    """The same columns, each span of a score of ``certain`` or more replaced by its kind in brackets.

    Overlapping spans become one, named by the kind that starts first. A null text stays null.
    """
    columns = list(frame.columns)
    names = list(columns)

    def inner(part: str) -> str:
        names.append(free_name(f"_mask_{part}", names))
        return names[-1]

    spans, ends, first, groups, blocks = (inner(x) for x in ("spans", "ends", "first", "groups", "blocks"))
    whole = F.col(f"`{text}`")
    frame = with_spans(frame, text, spans)
    sure = F.filter(F.col(spans), lambda s: s["score"] >= certain)
    by_place = F.transform(sure, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    frame = frame.withColumn(spans, F.array_sort(by_place))
    some = F.size(spans) > 0
    frame = frame.withColumn(
        ends, F.when(some, running(F.transform(F.col(spans), lambda s: s["end"]), lambda a, b: F.greatest(a, b)))
    )
    opening = F.filter(
        F.transform(F.col(spans), lambda s, i: F.struct(i.alias("at"), s["start"].alias("start"), s["kind"].alias("kind"))),
        lambda s: (s["at"] == 0) | (s["start"] >= F.get(F.col(ends), s["at"] - 1)),
    )
    frame = frame.withColumn(first, F.when(some, opening))
    last = lambda j: F.coalesce(F.get(F.col(first), j + 1)["at"], F.size(spans)) - 1
    frame = frame.withColumn(
        groups,
        F.when(
            some,
            F.transform(
                F.col(first),
                lambda s, j: F.struct(
                    s["start"].alias("start"), F.get(F.col(ends), last(j)).alias("end"), s["kind"].alias("kind")
                ),
            ),
        ),
    )
    frame = frame.withColumn(blocks, F.when(some, _cut_in_blocks(whole)))
    cut = lambda start, end: _between(F.col(blocks), start, end)
    parts = F.transform(
        F.col(groups),
        lambda g, j: F.concat(
            cut(F.when(j == 0, F.lit(0)).otherwise(F.get(F.col(groups), j - 1)["end"]), g["start"]),
            F.lit("["),
            F.upper(g["kind"]),
            F.lit("]"),
        ),
    )
    rest = cut(F.element_at(F.col(groups), -1)["end"], F.length(whole).cast("bigint"))
    frame = frame.withColumn(text, F.when(some, F.concat(F.array_join(parts, ""), rest)).otherwise(whole))
    return frame.select(*[f"`{name}`" for name in columns])
