"""Similarity join on sets of word n-grams: MinHash bands propose, full n-gram sets decide.

1. Every text becomes a key of its words, and one value per band. Equal keys are copies: the copy
   of the smallest id stands for all of them from here on.
2. Representatives that share a band value are joined through the smallest one among them, one
   row each, never in pairs. Connected ones form a family.
3. The n-gram sets of a family meet in one task or, where they are many, in blocks of bounded size
   of which each pair meets in one task. There all pairs are decided exactly, as products of
   matrices; what leaves is one row per document and task: how many links, and to whom.

The cost of step 3 is quadratic in a family of near copies, as its number of links is, but it is
spread over tasks of bounded size, and no row is made per pair.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickbasin.llm.components import components
from clickbasin.llm.support import free_name, stored

# A block holds about so many documents and so many n-grams.
BLOCK_DOCS, BLOCK_GRAMS = 512, 250_000
# Pairs of documents that share a rare n-gram are listed so many at a time; so many hashes of words are kept.
LISTED, WORDS_KEPT = 300_000, 60_000
_WORD = re.compile(r"\w+")
_MASK = (1 << 64) - 1


@dataclass(frozen=True)
class Join:
    """Word n-grams of ``n``, links from a Jaccard similarity of ``threshold`` on, found with ``recall``."""

    n: int = 5
    threshold: float = 0.8
    recall: float = 0.9995

    def bands(self) -> tuple[int, int]:
        """How many bands of how many rows: the cheapest pair that reaches ``recall`` at ``threshold``.

        The cost counts a row per band, and pairs of half the threshold that would be proposed.
        """
        best = None
        for rows in range(1, 13):
            hit = self.threshold**rows
            count = 1 if hit >= 1 else max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - hit)))
            cost = count * (1 + 20 * (self.threshold / 2) ** rows)
            if best is None or cost < best[0]:
                best = cost, count, rows
        return best[1], best[2]


class _WordHashes(dict):
    """64-bit hashes of words, forgotten when there are too many."""

    def __missing__(self, word: str) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def grams_of(words: list[str], n: int, hashes: _WordHashes) -> np.ndarray:
    """The set of n-gram hashes, ascending; a text of fewer words is one gram of all its words."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(n, len(words))
    total = np.zeros(len(codes) - size + 1, dtype=np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + len(total)]
    return np.unique(_mixed(total))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class _Bands:
    def __init__(self, join: Join, seed: int = 11):
        self.count, self.rows = join.bands()
        rng = np.random.default_rng(seed)
        n = self.count * self.rows
        self.times = rng.integers(0, _MASK, n, dtype=np.uint64) | np.uint64(1)
        self.plus = rng.integers(0, _MASK, n, dtype=np.uint64)
        self.mix = rng.integers(0, _MASK, self.rows, dtype=np.uint64) | np.uint64(1)
        self.salt = _mixed(np.arange(1, self.count + 1, dtype=np.uint64))

    def values(self, grams: np.ndarray) -> np.ndarray:
        """One 64-bit value per band, with the band's number mixed in."""
        least = np.full(len(self.times), _MASK, dtype=np.uint64)
        for at in range(0, len(grams), 1024):
            hashed = grams[at : at + 1024, None] * self.times
            hashed += self.plus
            np.minimum(least, hashed.min(axis=0), out=least)
        by_band = least.reshape(self.count, self.rows)
        return _mixed((_mixed(by_band) * self.mix).sum(axis=1, dtype=np.uint64) ^ self.salt).view(np.int64)


def signatures(docs: DataFrame, join: Join, id_column: str, text: str) -> DataFrame:
    """(id, key_a, key_b, n_grams, bands) of every row; no key and no bands for a text without words."""
    chosen = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bands = _WordHashes(), _Bands(join)
        for batch in batches:
            keys, sizes, values = [], [], []
            for value in batch.column(1):
                words = words_of(value.as_py())
                grams = grams_of(words, join.n, hashes)
                sizes.append(len(grams))
                keys.append(np.frombuffer(xxhash.xxh3_128_digest(" ".join(words)), dtype="<i8") if words else None)
                values.append(bands.values(grams) if words else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([None if key is None else int(key[0]) for key in keys], pa.int64()),
                    pa.array([None if key is None else int(key[1]) for key in keys], pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(values, pa.list_(pa.int64())),
                ],
                names=["id", "key_a", "key_b", "n_grams", "bands"],
            )

    id_type = chosen.schema[0].dataType.simpleString()
    return chosen.mapInArrow(work, f"id {id_type}, key_a long, key_b long, n_grams long, bands array<long>")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each set of ``left`` shares with each of ``right``.

    Frequent n-grams go through a product of 0/1 matrices, rare ones are listed pair by pair.
    """
    a, b = len(left), len(right)
    common, columns = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    owner = np.concatenate([np.repeat(np.arange(a), [len(x) for x in left]), np.repeat(np.arange(b), [len(x) for x in right])])
    edge = sum(len(x) for x in left)
    row_a, col_a, row_b, col_b = owner[:edge], columns[:edge], owner[edge:], columns[edge:]
    count_a, count_b = np.bincount(col_a, minlength=len(common)), np.bincount(col_b, minlength=len(common))
    shared = np.zeros((a, b), dtype=np.float32)
    product = count_a * count_b
    often = product * 64 > a * b
    number = np.cumsum(often) - 1
    keep_a, keep_b = often[col_a], often[col_b]
    total = int(often.sum())
    for low in range(0, total, 4096):
        width = min(4096, total - low)
        parts = []
        for rows, cols, keep, n in ((row_a, col_a, keep_a, a), (row_b, col_b, keep_b, b)):
            matrix = np.zeros((n, width), dtype=np.float32)
            at = number[cols[keep]] - low
            inside = (at >= 0) & (at < width)
            matrix[rows[keep][inside], at[inside]] = 1
            parts.append(matrix)
        shared += parts[0] @ parts[1].T
    rare = (product > 0) & ~often
    pick_a, pick_b = rare[col_a], rare[col_b]
    order_a, order_b = np.argsort(col_a[pick_a], kind="stable"), np.argsort(col_b[pick_b], kind="stable")
    rows_a, cols_a, rows_b = row_a[pick_a][order_a], col_a[pick_a][order_a], row_b[pick_b][order_b]
    first_b = np.concatenate([[0], np.cumsum(np.where(rare, count_b, 0))])
    reach = count_b[cols_a]
    ends = np.cumsum(reach)
    low = 0
    while low < len(rows_a):
        # As many rows as list a bounded number of pairs.
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + LISTED, side="right")))
        part = slice(low, high)
        low = high
        times = reach[part]
        pair_a = np.repeat(rows_a[part], times)
        inside = np.arange(times.sum()) - np.repeat(ends[part] - times - before, times)
        pair_b = rows_b[np.repeat(first_b[cols_a[part]], times) + inside]
        shared += np.bincount(pair_a * b + pair_b, minlength=a * b).reshape(a, b)
    return shared


def _linked(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    shared = _overlaps(left, right).astype(np.float64)
    sizes_a, sizes_b = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    return shared / (sizes_a[:, None] + sizes_b[None] - shared) >= threshold


def _labels(ids: list, pairs: np.ndarray) -> list:
    """The smallest id that each id is connected to through ``pairs`` of positions."""
    root = list(range(len(ids)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs:
        i, j = find(i), find(j)
        if i != j:
            if ids[j] < ids[i]:
                i, j = j, i
            root[j] = i
    return [ids[find(i)] for i in range(len(ids))]


def _decide(rows: list[tuple], low: int, high: int, threshold: float) -> list[tuple]:
    """(id, links, label) of the (id, copies, block, grams) rows of one pair of blocks.

    A document that came twice, because its row is repeated, counts once.
    """
    once = {(row[2], row[0]): row for row in rows}
    members = [once[key] for key in sorted(once)]
    left = [i for i, row in enumerate(members) if row[2] == low]
    right = left if low == high else [i for i, row in enumerate(members) if row[2] == high]
    if not left or not right:
        return []
    linked = _linked([members[i][3] for i in left], [members[i][3] for i in right], threshold)
    if low == high:
        np.fill_diagonal(linked, False)
    copies = np.array([row[1] for row in members], dtype=np.int64)
    links = np.zeros(len(members), dtype=np.int64)
    links[left] += linked @ copies[right]
    if low != high:
        links[right] += linked.T @ copies[left]
    i, j = np.nonzero(linked)
    pairs = np.column_stack([np.array(left)[i], np.array(right)[j]])
    if low == high:
        pairs = pairs[pairs[:, 0] < pairs[:, 1]]
    label = _labels([row[0] for row in members], pairs)
    return [(row[0], int(n), own) for row, n, own in zip(members, links, label)]


def classes(
    docs: DataFrame, join: Join = Join(), id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, class_id, n_links, n_copies) for each row of ``docs``.

    Two documents are linked when the Jaccard similarity of their n-gram sets reaches the
    threshold; ``n_links`` is how many other rows a row is linked to, copies included, and
    ``n_copies`` how many rows have its words, itself included. A class is what links connect, its
    id the smallest document id in it. Words are runs of letters, digits and underscores, in lower
    case. A text without words (null, empty, signs only) has no n-grams: it is a class of its own.
    A text of fewer than n words is one n-gram. Rows without an id take no part and have a null
    class. Rows of one id are one document: their classes are one. Other columns are not looked at;
    an empty table gives no rows.
    """
    every = stored(signatures(docs, join, id_column, text), "signatures")
    texts = stored(
        every.where("id IS NOT NULL AND key_a IS NOT NULL")
        .groupBy("key_a", "key_b")
        .agg(
            F.min("id").alias("rep"),
            F.count("*").alias("copies"),
            F.first("n_grams").alias("n_grams"),
            F.first("bands").alias("bands"),
        ),
        "texts",
    )
    by_value = texts.select("rep", F.explode("bands").alias("value"))
    shared = by_value.groupBy("value").agg(F.min("rep").alias("pivot"), F.max("rep").alias("other"))
    # Read from a table, so that the join below is split where many share one value; so are other counts here.
    shared = stored(shared.where("pivot <> other").select("value", "pivot"), "shared-values")
    proposed = by_value.join(shared, "value").where("rep <> pivot").select(F.col("rep").alias("u"), F.col("pivot").alias("v"))
    family = stored(components(proposed), "families")
    found = stored(_verified(docs, texts, family, join, id_column, text), "verified")

    final = found.where("blocks = 1").select("id", F.col("label").alias("class_id"))
    across = components(found.where("blocks > 1").select(F.col("id").alias("u"), F.col("label").alias("v")))
    final = final.union(across.select("node", "component")).groupBy("id").agg(F.min("class_id").alias("class_id"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    by_text = (
        texts.select("key_a", "key_b", "rep", "copies")
        .join(final.withColumnRenamed("id", "rep"), "rep", "left")
        .join(links.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "key_a",
            "key_b",
            F.coalesce("class_id", "rep").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.col("copies").alias("n_copies"),
        )
    )
    return every.join(by_text, ["key_a", "key_b"], "left").select(
        F.col("id").alias(id_column),
        F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id")).alias("class_id"),
        F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("id").isNull(), 1).otherwise(F.coalesce("n_copies", F.lit(1))).cast("long").alias("n_copies"),
    )


def _verified(docs: DataFrame, texts: DataFrame, family: DataFrame, join: Join, id_column: str, text: str) -> DataFrame:
    """(id, links, label, blocks): a row for each document and pair of blocks it was compared in."""
    members = family.join(
        texts.select(F.col("rep").alias("node"), "copies", "n_grams", "key_a", "key_b"), "node"
    )
    sizes = family.join(texts.select(F.col("rep").alias("node"), "n_grams"), "node").groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n_grams") / BLOCK_GRAMS)).cast("int").alias("blocks")
    )
    members = members.join(stored(sizes, "sizes"), "component").select(
        F.col("node").alias("id"),
        "component",
        "blocks",
        F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"),
        "copies",
        "key_a",
        "key_b",
    )
    chosen = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text")).where("id IS NOT NULL")
    rows = chosen.join(members, "id")
    id_type = chosen.schema[0].dataType.simpleString()

    def to_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            keep, grams = [], []
            columns = [batch.column(batch.schema.get_field_index(k)) for k in ("text", "key_a", "key_b")]
            for i, (value, key_a, key_b) in enumerate(zip(*columns)):
                words = words_of(value.as_py())
                if not words:
                    continue
                # Of several rows of one id only those with the representative's words are meant.
                key = np.frombuffer(xxhash.xxh3_128_digest(" ".join(words)), dtype="<i8")
                if (int(key[0]), int(key[1])) == (key_a.as_py(), key_b.as_py()):
                    keep.append(i)
                    grams.append(grams_of(words, join.n, hashes).tobytes())
            kept = batch.select(["id", "component", "blocks", "block", "copies"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(grams, pa.binary())], names=[*kept.schema.names, "grams"]
            )

    sets = rows.mapInArrow(
        to_grams, f"id {id_type}, component {id_type}, blocks int, block int, copies long, grams binary"
    )
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    meeting = (
        sets.withColumn("partner", partner)
        .withColumn("low", F.least("block", "partner"))
        .withColumn("high", F.greatest("block", "partner"))
        .drop("partner")
        .repartition("component", "low", "high")
        .sortWithinPartitions("component", "low", "high")
    )

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, key, blocks, done = [], None, 1, []

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in found], id_arrow),
                    pa.array([x[1] for x in found], pa.int64()),
                    pa.array([x[2] for x in found], id_arrow),
                    pa.array([x[3] for x in found], pa.int32()),
                ],
                names=["id", "links", "label", "blocks"],
            )

        id_arrow = None
        for batch in batches:
            id_arrow = batch.schema.field("id").type
            for row in batch.to_pylist():
                own = row["component"], row["low"], row["high"]
                if own != key and group:
                    done += [(*x, blocks) for x in _decide(group, key[1], key[2], join.threshold)]
                    group = []
                    if len(done) > 10_000:
                        yield batch_of(done)
                        done = []
                key, blocks = own, row["blocks"]
                group.append((row["id"], row["copies"], row["block"], np.frombuffer(row["grams"], dtype=np.uint64)))
        if group:
            done += [(*x, blocks) for x in _decide(group, key[1], key[2], join.threshold)]
        if done:
            yield batch_of(done)

    return meeting.mapInArrow(decide, f"id {id_type}, links long, label {id_type}, blocks int")


def one_of_each(docs: DataFrame, join: Join = Join(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row for each class: that of the smallest id, and of several rows of it one.

    Rows without an id all stay. Columns and their names stay as they are.
    """
    key = free_name("kept_id", docs.columns)
    kept = classes(docs, join, id_column, text).where(f"class_id = `{id_column}`")
    kept = kept.select(F.col(f"`{id_column}`").alias(key)).distinct()
    rank = free_name("kept_rank", docs.columns)
    order = Window.partitionBy(F.col(key)).orderBy(F.xxhash64(F.col(f"`{text}`")), F.col(f"`{text}`"))
    chosen = (
        docs.join(kept, F.col(f"`{id_column}`") == F.col(key))
        .withColumn(rank, F.row_number().over(order))
        .where(F.col(rank) == 1)
        .drop(key, rank)
    )
    return chosen.unionByName(docs.where(F.col(f"`{id_column}`").isNull()))
