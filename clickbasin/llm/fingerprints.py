"""Document fingerprints: invertible Bloom lookup tables over the digests of paragraphs.

A text is cut into paragraphs: lines, at sentence ends, and where a sentence is long at places that a hash of
the characters just before them picks, so that a change moves the cuts around it and no others. Each has a 64-bit digest; a paragraph that repeats gets a digest of its own every time. A table has
cells of a count, the XOR of the digests and the XOR of their check values, and a digest goes to
one cell in each third of it. The table of one text less that of another holds only what differs,
and peeling cells of one digest recovers it. Where that fails the table was too small: it is made
four times as large, until it works. All tables of a batch are worked on together in numpy.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cells of a fingerprint, a multiple of three, and how many times larger the next try is.
CELLS, LARGER = 24, 4
# Longer sentences are cut, on average after so many characters (in ones of more than ``VERY_LONG`` characters after
# ``SELDOM``, at some of the same places), by a hash of so many characters.
LONG, EVERY, VERY_LONG, SELDOM, BEFORE = 160, 16, 1_024, 32, 4
# Bytes of a range of ids and ranges at most, and documents and characters that are compared together.
RANGE_BYTES, MOST_RANGES, TOGETHER, TOGETHER_CHARS = 8_000_000, 100_000, 400, 4_000_000
_SENTENCE = re.compile("[^\n.!?。！？]*[\n.!?。！？]+|[^\n.!?。！？]+")


def paragraphs(text: str) -> list[str]:
    """The pieces of a text; joined they are the text again."""
    sentences = _SENTENCE.findall(text)
    if max(map(len, sentences), default=0) <= LONG:
        return sentences
    places: dict[int, np.ndarray] = {}
    out, at = [], 0
    for sentence in sentences:
        if len(sentence) <= LONG:
            out.append(sentence)
        else:
            every = EVERY if len(sentence) <= VERY_LONG else SELDOM
            if every not in places:
                places[every] = _cuts(text, every)
            out += _between_cuts(text, at, at + len(sentence), places[every], every, every // 2)
        at += len(sentence)
    return out


def _cuts(text: str, every: int) -> np.ndarray:
    """Places behind characters that a hash of the last few picks, on average one in ``every``, a power of two; none inside of runs of one character."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    hashed = np.zeros(max(0, len(codes) - BEFORE + 1), dtype=np.uint64)
    for k in range(BEFORE):
        hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + len(hashed)]
    picked = (_mixed(hashed) & np.uint64(every - 1) == 0) & (codes[BEFORE - 1 :] != codes[BEFORE - 2 : -1])
    return np.flatnonzero(picked) + BEFORE


def _between_cuts(text: str, start: int, stop: int, places: np.ndarray, every: int, least: int) -> list[str]:
    """The stretch of a text cut at places, each ``least`` characters behind the last; what stays long is cut more closely."""
    low, high = np.searchsorted(places, (start, stop), side="right")
    out, at = [], start
    for end in (*places[low:high].tolist(), stop):
        if end >= at + least or end == stop > at:
            piece = text[at:end]
            if len(piece) > 8 * every and every > 1:
                closer = max(1, every // 4)
                out += _between_cuts(piece, 0, len(piece), _cuts(piece, closer), closer, least)
            else:
                out.append(piece)
            at = end
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def digests(text: str) -> np.ndarray:
    """One digest per paragraph; the n-th of equal paragraphs has the n-th digest of that paragraph."""
    found = np.fromiter(map(xxhash.xxh3_64_intdigest, paragraphs(text)), dtype=np.uint64)
    if len(found) < 2:
        return found
    order = np.argsort(found, kind="stable")
    own = found[order]
    new = np.concatenate([[True], own[1:] != own[:-1]])
    if new.all():
        return found
    first = np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
    nth = (np.arange(len(own)) - first).astype(np.uint64)
    return np.where(nth == 0, own, _mixed(own + nth * np.uint64(0x9E3779B97F4A7C15)))


class Tables:
    """Tables of ``cells`` cells each, for ``count`` owners, in one set of arrays."""

    def __init__(self, count: int, cells: int):
        self.third = cells // 3
        self.cells = 3 * self.third
        self.count = np.zeros(count * self.cells, dtype=np.int64)
        self.keys = np.zeros(count * self.cells, dtype=np.uint64)
        self.checks = np.zeros(count * self.cells, dtype=np.uint64)

    def places(self, keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """(3, keys): the cells of each key."""
        out = np.empty((3, len(keys)), dtype=np.int64)
        for j in range(3):
            salt = ((j + 1) * 0xD6E8FEB86659FD93 + self.cells) % 2**64
            hashed = _mixed(keys + np.uint64(salt))
            out[j] = owner * self.cells + j * self.third + (hashed % np.uint64(self.third)).astype(np.int64)
        return out

    def add(self, keys: np.ndarray, owner: np.ndarray, sign: np.ndarray | int) -> None:
        check = _checks(keys)
        for cell in self.places(keys, owner):
            np.add.at(self.count, cell, sign)
            np.bitwise_xor.at(self.keys, cell, keys)
            np.bitwise_xor.at(self.checks, cell, check)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The digests that are left, their owners and signs, and which owners' tables came out empty."""
        keys, owners, signs = [], [], []
        owner_of = np.arange(len(self.count)) // self.cells
        active = np.flatnonzero(self.count | (self.keys != 0))
        for _ in range(len(self.count) + 1):
            pure = active[(np.abs(self.count[active]) == 1) & (_checks(self.keys[active]) == self.checks[active])]
            if not len(pure):
                break
            found = np.rec.fromarrays([owner_of[pure], self.keys[pure]])
            _, once = np.unique(found, return_index=True)
            pure = pure[once]
            key, owner, sign = self.keys[pure].copy(), owner_of[pure], self.count[pure].copy()
            self.add(key, owner, -sign)
            keys.append(key)
            owners.append(owner)
            signs.append(sign)
            active = np.unique(self.places(key, owner))
        empty = np.ones(len(self.count) // self.cells, dtype=bool)
        left = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        empty[owner_of[left]] = False
        if not keys:
            none = np.empty(0, dtype=np.int64)
            return np.empty(0, dtype=np.uint64), none, none, empty
        return np.concatenate(keys), np.concatenate(owners), np.concatenate(signs), empty


def _checks(keys: np.ndarray) -> np.ndarray:
    return _mixed(keys ^ np.uint64(0xA5A5A5A55A5A5A5A)) >> np.uint64(32)


def _joined(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    return (np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)), owner


def differences(left: list[np.ndarray], right: list[np.ndarray], cells: int = CELLS) -> np.ndarray:
    """(pairs, 2): how many digests only the left and only the right set of each pair has."""
    out = np.zeros((len(left), 2), dtype=np.int64)
    todo = np.arange(len(left))
    while len(todo):
        tables = Tables(len(todo), cells)
        for sets, sign in ((left, 1), (right, -1)):
            keys, owner = _joined([sets[i] for i in todo])
            tables.add(keys, owner, sign)
        _, owner, sign, done = tables.peel()
        for column, side in ((0, 1), (1, -1)):
            out[todo, column] = np.bincount(owner[sign == side], minlength=len(todo))
        todo = todo[~done]
        cells *= LARGER
    return out


def likenesses(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shared digests over all digests of each pair, from what peeling recovers; 1 for two empty sets."""
    only = differences(left, right)
    sizes = np.array([len(x) for x in left], dtype=np.int64)
    union = sizes + only[:, 1]
    return np.where(union == 0, 1.0, (sizes - only[:, 0]) / np.maximum(1, union))


def fingerprints(sets: list[np.ndarray]) -> list[str]:
    """The tables of ``CELLS`` cells as text: a cell is a 16-bit count, a digest and a 32-bit check."""
    tables = Tables(len(sets), CELLS)
    tables.add(*_joined(sets), 1)
    cells = np.empty(len(tables.count), dtype=[("count", "<u2"), ("key", "<u8"), ("check", "<u4")])
    cells["count"], cells["key"], cells["check"] = tables.count & 0xFFFF, tables.keys, tables.checks
    size = CELLS * cells.dtype.itemsize
    data = cells.tobytes()
    return [base64.b64encode(data[i * size : (i + 1) * size]).decode() for i in range(len(sets))]


def edited(text: str, following: str) -> str:
    """The last quarter of the characters replaced by the first as many of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


COLUMNS = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _compared(pairs: list[tuple[str, str]]) -> list[list]:
    """The ``COLUMNS`` of texts with the text that follows each."""
    texts = [text for text, _ in pairs]
    versions = [edited(text, following) for text, following in pairs]
    known: dict[str, np.ndarray] = {}
    for text in (*texts, *(following for _, following in pairs)):
        if text not in known:
            known[text] = digests(text)
    own, changed = [known[text] for text in texts], [digests(text) for text in versions]
    return [
        [len(text) for text in texts],
        [hashlib.sha256(version.encode("utf-8", "replace")).hexdigest() for version in versions],
        fingerprints(own),
        fingerprints(changed),
        likenesses(own, changed).tolist(),
        likenesses(own, [known[following] for _, following in pairs]).tolist(),
    ]


def with_edits(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ``COLUMNS``) of each row: its fingerprint, and that of the text with its last quarter
    replaced by the beginning of the next document's.

    Ids are whole numbers. The next document is that of the next larger id; equal ids go by a hash of their
    texts and then by these, rows without an id come before all others, and the first follows the last. A null
    text counts as empty, two empty texts are alike. Other columns are not looked at; an empty table gives no rows.

    Rows are cut into ranges of about equal numbers of rows and ``RANGE_BYTES`` of text, an id that fills several by
    the hashes; a range is a task, and also gets the first row of the range after it. Each text is shuffled once.
    """
    lowest = F.lit(-(2**63)).cast("bigint")
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"`{id_column}`").cast("bigint"), lowest).alias("place"),
    ).withColumn("mix", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(MOST_RANGES, max(1, -(-size // RANGE_BYTES)))
    # Where the cuts lie decides how even the ranges are, not what comes out.
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    bounds = _bounds(rows.agg(F.percentile_approx("place", shares, 10 * ranges)).first()[0] or [0])
    firsts = (
        rows.select("place", "mix", _codes(bounds, {})("place", "mix").alias("codes"))
        .groupBy(F.get("codes", 0).alias("code"))
        .agg(F.min(F.struct("place", "mix")).alias("first"))
        .orderBy("code")
        .collect()
    )
    # One entry per range: its first row's place, and the range before, which shows that row as well.
    ahead = {tuple(row.first): firsts[i - 1].code + 1 for i, row in enumerate(firsts)}
    dealt = (
        rows.withColumn("code", F.explode(_codes(bounds, ahead)("place", "mix")))
        .repartitionById(len(bounds) + 1, F.expr("CAST(code div 2 AS INT)"))
        .sortWithinPartitions("code", "place", "mix", "text")
        .select("id", "text", "code")
    )
    id_type = dealt.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        held = 0
        before = None
        id_arrow = None

        def flush() -> pa.RecordBatch:
            columns = _compared([(text, following) for _, text, following in waiting])
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            out = pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in waiting], id_arrow), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=[id_column, *(c.split()[0] for c in COLUMNS.split(", "))],
            )
            waiting.clear()
            return out

        for batch in batches:
            id_arrow = batch.schema.field("id").type
            for at in range(len(batch)):
                key, text, code = (column[at].as_py() for column in batch.columns)
                if before is not None and before[2] // 2 == code // 2 and before[2] % 2 == 0:
                    waiting.append((before[0], before[1], text))
                    held += len(text)
                    if len(waiting) >= TOGETHER or held >= TOGETHER_CHARS:
                        yield flush()
                        held = 0
                before = key, text, code
        if waiting:
            yield flush()

    return dealt.mapInArrow(work, f"`{id_column}` {id_type}, {COLUMNS}")


def _bounds(cuts: list[int]) -> list[tuple[int, int]]:
    """Where ranges end, in ascending order, as (place, hash): a place that is a cut several times is cut by hashes."""
    out = []
    for place, times in sorted(Counter(cuts).items()):
        if times > 1:
            out.append((place - 1, 2**63 - 1))
            out += [(place, -(2**63) + 2**64 * part // times) for part in range(1, times)]
        out.append((place, 2**63 - 1))
    return sorted(set(out))


def _codes(bounds: list[tuple[int, int]], ahead: dict[tuple[int, int], int]) -> Callable[..., Column]:
    """Where a row goes: twice its range, and for the first rows of a range the odd code of the range before."""

    @F.arrow_udf("array<bigint>")
    def codes(places: pa.Array, mixes: pa.Array) -> pa.Array:
        found = []
        for key in zip(places.to_pylist(), mixes.to_pylist()):
            own = [2 * bisect_left(bounds, key)]
            found.append(own if (more := ahead.get(key)) is None else [*own, more])
        return pa.array(found, pa.list_(pa.int64()))

    return codes
