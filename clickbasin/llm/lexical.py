"""Ranked lexical search over bit-sliced Bloom signatures.

An index row is a block of documents of like length. Its signature has one Bloom filter per
document, stored by slices: slice ``r`` is the bitmap of the block's documents whose filter has bit
``r``. A document's filter holds, for each of its terms, the levels of ``LEVELS`` that the term's
count in it reaches. The ``HASHES`` slices of a term and a level, and-ed, are the documents that may
hold it that often: all that do, and a few that do not.

A search sums the slices of an item's terms with their weights, as if every count were the highest
of its level, which is no less than a document's score. Documents whose sum does not reach the
k-th best score found so far are excluded by that. All others are scored exactly, from the block's own
counts. Scores found in some blocks, looked at first, give every task a mark to start from; they only
say what need not be looked at and never which documents are ranked.

Rules: a null text has no terms, and documents without terms are never found. Rows that share an id
are documents of their own; a null id ranks behind the others. Item rows that share an id are one
item with all their terms. Further columns of either frame are left out.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickbasin.llm.support import stored
from clickbasin.session import small_frame

# The scale of weights and of counts, and the parts of a document's length measure.
WEIGHT_SCALE, COUNT_SCALE, COUNT_PART, LENGTH_PART, LENGTH_SHARE = 1000, 1_000_000_000, 1000, 20, 50
# Counts of a term in a document that its filter tells apart.
LEVELS = np.array([1, 2, 3, 5, 9, 17, 65])
# A filter's bits for each entry of the fullest document of the block, and slices for an entry.
BITS, HASHES = 16, 4
# A block is full with either; a longer document is a block by itself.
BLOCK_DOCS, BLOCK_BYTES = 1024, 2_000_000
# One block in so many is searched first. Items that are searched for at a time.
SEED_BLOCKS, ITEMS = 16, 512

# Terms are runs of what is not in here; ASCII letters are lower-cased.
_KEPT = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(x if x >= 0x80 else ord(chr(x).lower()) if x in _KEPT else 0x20 for x in range(256))

INDEX = """block long, n_docs int, n_terms long, doc_ids binary, doc_nulls binary, lengths binary,
    most binary, bits int, slices binary, terms binary, df binary, starts binary, ids binary, counts binary"""


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order, with repeats."""
    return text.translate(_FOLD).split()


def _positions(hashed: np.ndarray, level: np.ndarray | int, bits: int) -> np.ndarray:
    """(n, HASHES): the slices of terms, by hash, at levels."""
    with np.errstate(over="ignore"):
        x = hashed + np.uint64(0x9E3779B97F4A7C15) * (np.asarray(level).astype(np.uint64) + np.uint64(1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        low, high = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
        return ((low[:, None] + np.arange(HASHES, dtype=np.uint64) * high[:, None]) % np.uint64(bits)).astype(np.int64)


def _hashed(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))


def _block(docs: list[tuple[int | None, bytes]]) -> dict | None:
    """An index row of the documents that have terms; none if there are none."""
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    ids, parts = [], []
    for doc_id, text in docs:
        if words := terms_of(text):
            ids.append(doc_id)
            parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
    if not parts:
        return None
    lengths = np.array([len(part) for part in parts])
    key, counts = np.unique(np.repeat(np.arange(len(parts)), lengths) * len(known) + np.concatenate(parts), return_counts=True)
    owner, local = np.divmod(key, len(known))
    starts = np.searchsorted(owner, np.arange(len(parts) + 1))
    reached = np.searchsorted(LEVELS, counts, side="right")
    bits = int(BITS * max(8, np.add.reduceat(reached, starts[:-1]).max()))
    hashed = _hashed(list(known))
    slices = np.zeros((bits, -(-len(parts) // 8)), dtype=np.uint8)
    for level in range(len(LEVELS)):
        rows = np.flatnonzero(reached > level)
        if len(rows):
            at = _positions(hashed[local[rows]], level, bits)
            np.bitwise_or.at(slices, (at, owner[rows, None] >> 3), (128 >> (owner[rows, None] & 7)).astype(np.uint8))
    return {
        "block": int(hashed[0] >> np.uint64(1)) if len(hashed) else 0,
        "n_docs": len(parts),
        "n_terms": int(lengths.sum()),
        "doc_ids": np.array([x or 0 for x in ids], np.int64).tobytes(),
        "doc_nulls": np.array([x is None for x in ids], np.uint8).tobytes(),
        "lengths": lengths.astype(np.int64).tobytes(),
        "most": np.maximum.reduceat(counts, starts[:-1]).astype(np.int64).tobytes(),
        "bits": bits,
        "slices": slices.tobytes(),
        "terms": b" ".join(known),
        "df": np.bincount(local, minlength=len(known)).astype(np.int32).tobytes(),
        "starts": starts.astype(np.int64).tobytes(),
        "ids": local.astype(np.int32).tobytes(),
        "counts": counts.astype(np.int32).tobytes(),
    }


def _arrow_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in INDEX.split(","))])


def build(docs: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """The index of whole texts, as a frame to be stored: a row a block, no shuffle.

    Blocks are filled by length classes, so that their documents' filters are about equally full.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{column}`").cast("binary").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema()
        held: dict[int, list] = defaultdict(list)
        size: dict[int, int] = defaultdict(int)

        def flush(kind: int) -> Iterator[pa.RecordBatch]:
            size.pop(kind, None)
            if row := _block(held.pop(kind, [])):
                yield pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                if not (data := text.as_py()):
                    continue
                kind = len(data).bit_length()
                if held[kind] and size[kind] + len(data) > BLOCK_BYTES:
                    yield from flush(kind)
                held[kind].append((doc_id.as_py(), data))
                size[kind] += len(data)
                if len(held[kind]) >= BLOCK_DOCS:
                    yield from flush(kind)
        for kind in list(held):
            yield from flush(kind)

    return rows.mapInArrow(work, INDEX)


@dataclass(frozen=True)
class Corpus:
    """Documents with terms, and their terms with repeats."""

    documents: int
    terms: int

    def measure(self, lengths: np.ndarray) -> np.ndarray:
        """The length measure of documents of so many terms."""
        return 100 - LENGTH_SHARE + np.array([LENGTH_SHARE * int(n) * self.documents // self.terms for n in lengths], np.int64)


@dataclass(frozen=True)
class Items:
    """Some items: term ``terms[which[e]]`` of item ``item_ids[of[e]]`` for each entry ``e``, in the items' order."""

    item_ids: list
    terms: list[bytes]
    weights: np.ndarray
    of: np.ndarray
    which: np.ndarray

    @cached_property
    def hashed(self) -> np.ndarray:
        return _hashed(self.terms)

    @cached_property
    def starts(self) -> np.ndarray:
        return np.searchsorted(self.of, np.arange(len(self.item_ids)))


def corpus_of(index: DataFrame) -> Corpus:
    row = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    return Corpus(row[0] or 0, row[1] or 0)


def frequencies(index: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """In how many documents each of these terms is: exact, from the blocks' own lists of terms."""
    shared = index.sparkSession.sparkContext.broadcast(frozenset(terms))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: defaultdict[bytes, int] = defaultdict(int)
        for batch in batches:
            for words, df in zip(batch.column(0), batch.column(1)):
                counts = np.frombuffer(df.as_py(), np.int32)
                for at, word in enumerate(words.as_py().split(b" ")):
                    if word in shared.value:
                        total[word] += int(counts[at])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["term", "df"])

    found = index.select("terms", "df").mapInArrow(work, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    # A row for each of the given terms at most.
    return {bytes(row.term): row.df for row in found.collect()}


def items_of(rows: list[tuple[object, list[bytes]]], index: DataFrame, corpus: Corpus) -> Items:
    """Items by id and terms; terms that no document holds are left out, and items without any other."""
    df = frequencies(index, sorted({term for _, terms in rows for term in terms}))
    terms = sorted(df)
    at = {term: k for k, term in enumerate(terms)}
    weights = [math.floor(WEIGHT_SCALE * math.log((2 * corpus.documents + 2) / (2 * df[term] + 1))) for term in terms]
    held = [(item, [at[t] for t in words if t in at]) for item, words in rows]
    held = [(item, words) for item, words in held if words]
    return Items(
        [item for item, _ in held],
        terms,
        np.array(weights, np.int64),
        np.repeat(np.arange(len(held)), [len(words) for _, words in held]),
        np.array([t for _, words in held for t in words], np.int64),
    )


def _gain(counts: np.ndarray, measure: np.ndarray) -> np.ndarray:
    """What a count of a term adds for each unit of its weight."""
    return (COUNT_SCALE * counts) // (COUNT_PART * counts + LENGTH_PART * measure)


class _Block:
    """An index row, read as far as a search needs it."""

    def __init__(self, row: dict, corpus: Corpus):
        self.row, self.n = row, row["n_docs"]
        self.measure = corpus.measure(np.frombuffer(row["lengths"], np.int64))
        ids = np.frombuffer(row["doc_ids"], np.int64)
        self.docs = np.stack([np.frombuffer(row["doc_nulls"], np.uint8).astype(np.int64), ids], axis=1)

    def bounds(self, items: Items) -> np.ndarray:
        """(items, documents): no less than the scores."""
        bits, most = self.row["bits"], np.frombuffer(self.row["most"], np.int64)
        slices = np.frombuffer(self.row["slices"], np.uint8).reshape(bits, -1)
        total = np.zeros((len(items.item_ids), self.n), np.int64)
        before, live = np.zeros(self.n, np.int64), np.arange(len(items.terms))
        for level, least in enumerate(LEVELS):
            if most.max() < least or not len(live):
                break
            at = _positions(items.hashed[live], level, bits)
            maps = np.bitwise_and.reduce(slices[at], axis=1)
            some = maps.any(axis=1)
            live, maps = live[some], maps[some]
            # What reaching this level adds: from the top of the level below to the top of this one.
            top = np.minimum(LEVELS[level + 1] - 1, most) if level + 1 < len(LEVELS) else most
            gain = np.where(most >= least, _gain(top, self.measure), before)
            step, before = gain - before, gain
            row_of = np.full(len(items.terms), -1)
            row_of[live] = np.arange(len(live))
            entries = np.flatnonzero(row_of[items.which] >= 0)
            if not len(entries):
                break
            shown = np.unpackbits(maps, axis=1, count=self.n)
            of, terms = items.of[entries], items.which[entries]
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            # Some items at a time, so that what is gathered stays small.
            for cut in range(0, len(first), 32):
                heads = first[cut : cut + 32]
                part = terms[heads[0] : first[cut + 32] if cut + 32 < len(first) else len(terms)]
                weighted = shown[row_of[part]] * items.weights[part, None].astype(np.int32)
                total[of[heads]] += np.add.reduceat(weighted, heads - heads[0], axis=0, dtype=np.int64) * step
        return total

    @cached_property
    def _counts(self) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
        words = {word: k for k, word in enumerate(self.row["terms"].split(b" "))}
        starts = np.frombuffer(self.row["starts"], np.int64)
        owner = np.repeat(np.arange(self.n), np.diff(starts))
        return words, owner * len(words) + np.frombuffer(self.row["ids"], np.int32), np.frombuffer(self.row["counts"], np.int32)

    def scores(self, items: Items, item: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The exact scores of pairs, item by item and document by document."""
        words, keys, counts = self._counts
        local = np.array([words.get(term, -1) for term in items.terms], np.int64)
        sizes = np.diff(np.r_[items.starts, len(items.of)])
        out = np.zeros(len(item), np.int64)
        for begin in range(0, len(item), 20_000):
            pair = slice(begin, begin + 20_000)
            n = sizes[item[pair]]
            ends = np.cumsum(n)
            entry = np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(items.starts[item[pair]], n)
            term, of = items.which[entry], np.repeat(np.arange(len(n)), n)
            held = local[term] >= 0
            term, of = term[held], of[held]
            wanted = doc[pair][of] * len(words) + local[term]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            found = keys[at] == wanted
            term, of, at = term[found], of[found], at[found]
            gain = _gain(counts[at].astype(np.int64), self.measure[doc[pair][of]])
            sums = np.zeros(len(n), np.int64)
            np.add.at(sums, of, items.weights[term] * gain)
            out[pair] = sums
        return out


class _Best:
    """The ``k`` best documents of each item so far, and the score that a further one has to reach."""

    def __init__(self, items: Items, k: int, marks: np.ndarray):
        self.k, self.marks = k, marks.copy()
        self.found = np.zeros((0, 4), np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, docs: np.ndarray) -> None:
        keep = score >= self.marks[item]
        rows = np.concatenate([self.found, np.stack([item[keep], score[keep], docs[keep, 0], docs[keep, 1]], axis=1)])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        first = np.searchsorted(rows[:, 0], rows[:, 0])
        place = np.arange(len(rows)) - first
        self.found = rows[place < self.k]
        last = rows[place == self.k - 1]
        self.marks[last[:, 0]] = np.maximum(self.marks[last[:, 0]], last[:, 1])


def _searched(index: DataFrame, items: Items, corpus: Corpus, k: int, marks: np.ndarray) -> DataFrame:
    """(item, score, no_id, id, scored, pairs): each task's best; item is the place among the items.

    ``scored`` and ``pairs``, in the row of item -1, count what was scored exactly, of all pairs.
    """
    # Plain values only: a broadcast is unpickled where this package cannot be imported.
    shared = index.sparkSession.sparkContext.broadcast((items.item_ids, items.terms, items.weights, items.of, items.which, marks))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *parts, marks = shared.value
        items = Items(*parts)
        best, scored, pairs = _Best(items, k, marks), 0, 0
        for batch in batches:
            for at in range(len(batch)):
                block = _Block(batch.slice(at, 1).to_pylist()[0], corpus)
                bounds = block.bounds(items)
                pairs += bounds.size
                # The most promising of each item first: they raise the marks for the rest.
                if block.n > k:
                    top = np.argpartition(-bounds, k, axis=1)[:, :k]
                    first = np.zeros(bounds.shape, bool)
                    np.put_along_axis(first, top, True, axis=1)
                else:
                    first = np.ones(bounds.shape, bool)
                for turn in (first, ~first):
                    item, doc = np.nonzero(turn & (bounds >= best.marks[:, None]))
                    if len(item):
                        scored += len(item)
                        best.add(item, block.scores(items, item, doc), block.docs[doc])
        rows = np.concatenate([np.column_stack([best.found, np.zeros((len(best.found), 2), np.int64)]), [[-1, 0, 0, 0, scored, pairs]]])
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, c]) for c in range(6)], names=["item", "score", "no_id", "id", "scored", "pairs"])

    return index.mapInArrow(work, "item long, score long, no_id long, id long, scored long, pairs long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "no_id", "id")
    return found.where("item >= 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _item_terms(items: DataFrame, id_column: str, column: str) -> DataFrame:
    """(item_id, terms): each item once, with its terms once, in ascending order."""

    @F.arrow_udf("array<binary>")
    def terms(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(set(terms_of(text or b""))) for text in texts.to_pylist()], pa.list_(pa.binary()))

    rows = items.select(F.col(f"`{id_column}`").alias("item_id"), terms(F.col(f"`{column}`").cast("binary")).alias("terms"))
    return rows.groupBy("item_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))).alias("terms"))


def search(
    index: DataFrame, items: DataFrame, k: int = 50, id_column: str = "item_id", column: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents of a stored index, score above 0.

    Items are taken in groups of about ``ITEMS``, which bounds what tasks are sent at a time.
    """
    return search_counted(index, items, k, id_column, column)[0]


def search_counted(
    index: DataFrame, items: DataFrame, k: int = 50, id_column: str = "item_id", column: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The result of ``search``, and a row (scored, pairs) a group of items: how many pairs were scored exactly."""
    spark, corpus = index.sparkSession, corpus_of(index)
    listed = stored(_item_terms(items, id_column, column), "search-items")
    groups = max(1, -(-listed.count() // ITEMS))
    listed = listed.withColumn("group", F.pmod(F.xxhash64("item_id"), F.lit(groups)))
    parts, tallies = [], []
    for group in range(groups):
        rows = [(row.item_id, [bytes(t) for t in row.terms]) for row in listed.where(F.col("group") == group).collect()]
        some = items_of(rows, index, corpus)
        marks = np.ones(len(some.item_ids), np.int64)
        seeds = index.where(F.pmod(F.col("block"), F.lit(SEED_BLOCKS)) == 0)
        seeds = _ranked(_searched(seeds, some, corpus, k, marks), k).where(F.col("rank") == k)
        for row in seeds.select("item", "score").collect():
            marks[row.item] = max(1, row.score)
        found = stored(_searched(index, some, corpus, k, marks), "search-found")
        names = small_frame(spark, list(enumerate(some.item_ids)), f"item long, item_id {listed.schema['item_id'].dataType.simpleString()}")
        doc_id: Column = F.when(F.col("no_id") == 0, F.col("id"))
        parts.append(_ranked(found, k).join(names, "item").select("item_id", "rank", doc_id.alias("doc_id"), "score"))
        tallies.append(found.where("item = -1").agg(F.sum("scored").alias("scored"), F.sum("pairs").alias("pairs")))
    result, tally = parts[0], tallies[0]
    for more, count in zip(parts[1:], tallies[1:]):
        result, tally = result.unionAll(more), tally.unionAll(count)
    return result, tally
