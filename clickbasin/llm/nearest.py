"""Approximate nearest neighbours by inner product: cross-polytope hashing with several probes.

Vectors are brought to unit length (where lengths differ, by one more coordinate that turns inner
products into angles) and turned by pseudo-rotations: three rounds of random signs and a fast
Hadamard transform. A table's hash is the signed axis that is nearest then. A query looks into the
buckets of the axes nearest to it, in order; how many, is fitted so that a sample of queries finds
the wanted share of its true neighbours. Candidates are ranked by their exact inner products.

Buckets are cut into blocks of vectors and blocks of queries of bounded size, each pair of which is
one product of matrices; every block hands on a short list per query. The nearest few buckets are
searched first: what they give bounds what the others still have to hand on. Equal vectors are searched
for and found as one: of their ids only the smallest ones can be among the nearest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickbasin.llm.support import stored

# Sizes of a block, and how many vectors a bucket should hold before hashes are made of two axes.
BLOCK_VECTORS, BLOCK_QUERIES, BUCKET = 8_192, 2_048, 200_000
# Buckets of each table that are searched first.
FIRST = 4


@dataclass(frozen=True)
class Search:
    """``k`` neighbours, ``tables`` of hashes, ``recall`` to reach on ``sample`` queries when fitting."""

    k: int = 20
    tables: int = 2
    recall: float = 0.96
    sample: int = 64
    seed: int = 3


def _butterfly(x: np.ndarray) -> np.ndarray:
    """The Hadamard transform of each row, whose length is a power of two."""
    n, size = x.shape
    half = 1
    while half < size:
        x = x.reshape(n, -1, 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return x


class Hashes:
    """The tables of one dimension. ``axes`` axes make a hash; ``most`` is the largest length there is."""

    def __init__(self, dimension: int, search: Search, axes: int, most: float, even: bool):
        self.even, self.most, self.tables, self.axes = even, most, search.tables, axes
        inner = dimension if even else dimension + 1
        self.size = 1 << max(1, (inner - 1).bit_length())
        rng = np.random.default_rng([search.seed, self.size])
        self.signs = rng.choice([-1.0, 1.0], (search.tables, axes, 3, self.size))

    def turned(self, x: np.ndarray, query: bool) -> np.ndarray:
        """(tables, axes, n, size): the rotated unit vectors."""
        length = np.linalg.norm(x, axis=1, keepdims=True)
        padded = np.zeros((len(x), self.size))
        if self.even or query:
            padded[:, : x.shape[1]] = x / length
        else:
            padded[:, : x.shape[1]] = x / self.most
            padded[:, x.shape[1]] = np.sqrt(np.maximum(0, 1 - (length[:, 0] / self.most) ** 2))
        out = np.empty((self.tables, self.axes, len(x), self.size))
        for t in range(self.tables):
            for a in range(self.axes):
                y = padded
                for sign in self.signs[t, a]:
                    y = _butterfly(y * sign)
                out[t, a] = y
        return out

    def codes(self, x: np.ndarray) -> np.ndarray:
        """(n, tables): the bucket of each vector in each table."""
        y = self.turned(x, query=False)
        axis = np.abs(y).argmax(axis=3)
        negative = np.take_along_axis(y, axis[..., None], axis=3)[..., 0] < 0
        return self._joined(2 * axis + negative).T

    def _joined(self, signed: np.ndarray) -> np.ndarray:
        code = signed[:, 0].astype(np.int64)
        for a in range(1, self.axes):
            code = code * 2 * self.size + signed[:, a]
        return code

    def buckets(self) -> int:
        return (2 * self.size) ** self.axes

    def probes(self, x: np.ndarray, most: int) -> np.ndarray:
        """(n, tables, probes): the buckets a query looks into, nearest first."""
        y = self.turned(x, query=True)
        nearness = np.concatenate([y[..., None], -y[..., None]], axis=-1).reshape(*y.shape[:3], -1)
        most = min(most, self.buckets())
        if self.axes == 1:
            return np.argsort(-nearness[:, 0], axis=2, kind="stable")[..., :most].transpose(1, 0, 2)
        total = nearness[:, 0]
        for a in range(1, self.axes):
            total = (total[..., None] + nearness[:, a][:, :, None, :]).reshape(*total.shape[:2], -1)
        return np.argsort(-total, axis=2, kind="stable")[..., :most].transpose(1, 0, 2)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, every component finite."""
    whole = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & whole & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a column, all of one length, as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _keyed(vectors: DataFrame) -> DataFrame:
    """(id, key_a, key_b, size, length, vector): a key for equal vectors, their dimension and length."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lengths, sizes = [], [], []
            for row in batch.column(1):
                x = np.asarray(row.values.to_numpy(zero_copy_only=False), dtype=np.float64) + 0.0
                keys.append(np.frombuffer(xxhash.xxh3_128_digest(x.tobytes()), dtype="<i8"))
                lengths.append(float(np.linalg.norm(x)))
                sizes.append(len(x))
            key = np.array(keys, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array(sizes, pa.int32()), pa.array(lengths, pa.float64()), batch.column(1)],
                names=["id", "key_a", "key_b", "size", "length", "vector"],
            )

    kind = vectors.schema["vector"].dataType.simpleString()
    return vectors.mapInArrow(work, f"id long, key_a long, key_b long, size int, length double, vector {kind}")


def _best(
    queries: np.ndarray, keys: list, bounds: np.ndarray, members: list[tuple[np.ndarray, list]], k: int
) -> list[tuple]:
    """(query key, id, score): for each query the ``k`` best ids of a block of vectors that reach its bound."""
    matrix = np.concatenate([x for x, _ in members])
    ids = [own for _, part in members for own in part]
    scores = queries @ matrix.T
    out = []
    width = min(k, len(ids))
    for i, key in enumerate(keys):
        row = scores[i]
        least = bounds[i]
        if width < len(ids):
            # Everything that is not worse than the k-th best, so that ties are settled by id.
            least = max(least, np.partition(row, len(ids) - width)[len(ids) - width])
        top = np.flatnonzero(row >= least)
        found = sorted((-float(row[j]), own) for j in top for own in ids[j])[:k]
        out += [(*key, own, -score) for score, own in found]
    return out


_FOUND = "key_a long, key_b long, vec_id long, score double"


def _found_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["key_a", "key_b", "vec_id", "score"]
    )


def _fit(texts: DataFrame, queries: DataFrame, search: Search, hashes: dict[int, Hashes]) -> dict[int, int]:
    """Probes per table for each dimension, such that sampled queries find their true neighbours.

    The sample is compared with every vector. What comes back is, for each of its neighbours, at
    which probe it would have been found.
    """
    ranks: dict[int, list[int]] = {size: [] for size in hashes}
    for size, own in hashes.items():
        sample = queries.where(F.col("size") == size).orderBy(F.xxhash64("key_a", "key_b")).limit(search.sample)
        sample = sample.select("key_a", "key_b", "vector").collect()
        if not sample:
            continue
        matrix = np.array([row.vector for row in sample], dtype=np.float64)
        keys = [(row.key_a, row.key_b) for row in sample]
        wanted = search.k + 1

        def compare(batches: Iterator[pa.RecordBatch], matrix=matrix, keys=keys, own=own) -> Iterator[pa.RecordBatch]:
            order = own.probes(matrix, own.buckets())
            place = np.empty_like(order)
            np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[2]), order.shape), axis=2)
            for batch in batches:
                x = _matrix(batch.column(1))
                scores, codes = matrix @ x.T, own.codes(x)
                top = np.argsort(-scores, axis=1, kind="stable")[:, :wanted]
                rows = []
                for i, key in enumerate(keys):
                    rank = np.min([place[i, t, codes[top[i], t]] for t in range(own.tables)], axis=0)
                    rows += [(*key, int(r), float(scores[i, j])) for r, j in zip(rank, top[i])]
                yield _found_batch(rows)

        found = texts.where(F.col("size") == size).select("key_a", "vector").mapInArrow(compare, _FOUND)
        order = Window.partitionBy("key_a", "key_b").orderBy(F.desc("score"), "vec_id")
        kept = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= wanted)
        # The first is the query itself.
        ranks[size] = [row.vec_id for row in kept.where("place > 1").select("vec_id").collect()]
    out = {}
    for size, own in hashes.items():
        found = np.sort(np.array(ranks[size] or [own.buckets() - 1]))
        out[size] = int(found[min(len(found) - 1, int(np.ceil(search.recall * len(found))) - 1)]) + 1
    return out


def nearest(
    vectors: DataFrame, is_query: Column, search: Search = Search(), id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` nearest others that were found.

    Ranked by inner product in double precision, ties by the smaller id; all others, if there are
    fewer than k. ``is_query`` is a condition on the rows. Ids are whole numbers. Rows without an id
    and vectors that are null, empty, zero, or hold null or non-finite components take no part;
    vectors of different dimensions never meet. An id that occurs with several vectors is a
    candidate with each, and found once, by its best score. Other columns are not looked at; an
    empty table gives no rows. A query that finds less than it could looks into every bucket.
    """
    chosen = vectors.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{vector}`").alias("vector"), is_query.alias("asks")
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    keyed = _keyed(chosen.select("id", "vector"))
    asks = chosen.where("asks").select(F.col("id").alias("query_id")).distinct()
    keyed = stored(keyed, "vectors")
    # The k + 1 smallest ids of equal vectors: more can never be among the nearest.
    order = Window.partitionBy("key_a", "key_b").orderBy("id")
    few = keyed.dropDuplicates(["key_a", "key_b", "id"]).withColumn("n", F.row_number().over(order))
    few = few.where(F.col("n") <= search.k + 1)
    texts = stored(
        few.groupBy("key_a", "key_b").agg(
            F.array_sort(F.collect_list("id")).alias("ids"),
            F.first("size").alias("size"),
            F.first("length").alias("length"),
            F.first("vector").alias("vector"),
        ),
        "distinct-vectors",
    )
    asking = stored(
        keyed.join(asks, keyed.id == asks.query_id).select("query_id", "key_a", "key_b").distinct(), "queries"
    )
    queries = texts.join(asking.select("key_a", "key_b").distinct(), ["key_a", "key_b"], "left_semi")
    unbounded = F.lit(float("-inf"))
    queries = stored(queries.select("key_a", "key_b", "size", "vector", unbounded.alias("bound")), "query-vectors")

    # One row per dimension.
    shapes = texts.groupBy("size").agg(
        F.count("*").alias("n"), F.min("length").alias("least"), F.max("length").alias("most")
    )
    hashes = {}
    for row in shapes.collect():
        even = row.most - row.least <= 1e-3 * row.most
        own = Hashes(row["size"], search, 1, row.most, even)
        hashes[row["size"]] = own if row.n <= BUCKET * own.buckets() else Hashes(row["size"], search, 2, row.most, even)
    probes = _fit(texts, queries, search, hashes)

    def ranked(frame: DataFrame, keep: int) -> DataFrame:
        once = frame.groupBy("key_a", "key_b", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("key_a", "key_b").orderBy(F.desc("score"), "vec_id")
        return once.withColumn("n", F.row_number().over(order)).where(F.col("n") <= keep).drop("n")

    first = {size: (0, min(FIRST, most)) for size, most in probes.items()}
    close = stored(ranked(_looked_up(texts, queries, search, hashes, first), search.k + 1), "close")
    # Rounding may differ by block, so the bound leaves a little room.
    bounds = close.groupBy("key_a", "key_b").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    bounds = bounds.where(F.col("n") > search.k).select("key_a", "key_b", "least")
    bounded = queries.join(bounds, ["key_a", "key_b"], "left").select(
        "key_a", "key_b", "size", "vector", F.coalesce(F.col("least") - 1e-9 * F.abs("least"), "bound").alias("bound")
    )
    rest = {size: (FIRST, most) for size, most in probes.items() if most > FIRST}
    found = close
    if rest:
        far = bounded.where(F.col("size").isin(list(rest)))
        found = close.union(_looked_up(texts, stored(far, "bounded-queries"), search, hashes, rest))
    best = stored(ranked(found, search.k + 1), "best")
    # What a query could find: every vector of its dimension, up to the k it needs and itself.
    could = few.groupBy("size").agg(F.least(F.count("*"), F.lit(search.k + 1)).alias("could"))
    short = (
        queries.join(best.groupBy("key_a", "key_b").agg(F.count("*").alias("n")), ["key_a", "key_b"], "left")
        .join(F.broadcast(could), "size")  # one row per dimension
        .where(F.coalesce("n", F.lit(0)) < F.col("could"))
        .select(*queries.columns)
    )
    every = {size: (0, own.buckets()) for size, own in hashes.items()}
    again = _looked_up(texts, stored(short, "short-queries"), search, hashes, every, tables=1)
    best = ranked(best.union(again), search.k + 1)
    results = asking.join(best, ["key_a", "key_b"]).where("query_id <> vec_id")
    results = results.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    results = results.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= search.k)
    return results.select("query_id", F.col("rank").cast("int"), F.col("vec_id"), "score")


def _looked_up(
    texts: DataFrame,
    queries: DataFrame,
    search: Search,
    hashes: dict[int, Hashes],
    probes: dict[int, tuple[int, int]],
    tables: int | None = None,
) -> DataFrame:
    """``_FOUND`` rows: the best ids of every block of the buckets that a query looks into.

    ``probes`` has, by dimension, from which to which of its buckets in order of nearness.
    """
    tables = tables or search.tables

    def placed(asking: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes = batch.column(2).to_numpy()
                for size in np.unique(sizes):
                    own = hashes[int(size)]
                    for at in range(0, len(batch), 256):
                        part = batch.slice(at, 256)
                        part = part.take(pa.array(np.flatnonzero(sizes[at : at + 256] == size)))
                        if not len(part):
                            continue
                        x = _matrix(part.column(3))
                        if asking:
                            start, end = probes[int(size)]
                            codes = own.probes(x, end)[:, :, start:]
                        else:
                            codes = own.codes(x)[:, :, None]
                        codes = codes[:, :tables]
                        spread = codes * tables + np.arange(tables)[None, :, None]
                        lists = pa.array(spread.reshape(len(part), -1).tolist(), pa.list_(pa.int64()))
                        yield pa.RecordBatch.from_arrays([*part.columns[:2], part.column(2), lists], names=["key_a", "key_b", "size", "buckets"])

        return work

    schema = "key_a long, key_b long, size int, buckets array<long>"
    columns = ["key_a", "key_b", "size", "vector"]

    def spread(frame: DataFrame, asking: bool) -> DataFrame:
        found = frame.select(*columns).mapInArrow(placed(asking), schema)
        return found.select("key_a", "key_b", "size", F.explode("buckets").alias("bucket"))

    # Rows without their vectors settle how many blocks a bucket needs: a row per bucket, of which there
    # are as many as signed axes (or pairs of them) in all tables.
    homes = stored(spread(texts.where(F.col("size").isin(list(probes))), False), "homes")
    asked = stored(spread(queries, True), "asked")
    need = homes.groupBy("size", "bucket").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("blocks"))
    want = asked.groupBy("size", "bucket").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("parts"))
    plan = stored(need.join(want, ["size", "bucket"]), "blocks")
    mix = F.xxhash64("key_a", "key_b")
    group = ["size", "bucket", "block", "part"]
    kind = texts.schema["vector"].dataType.simpleString()
    data = (
        homes.join(plan, ["size", "bucket"])
        .withColumn("block", F.pmod(mix, "blocks"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .join(texts.select("key_a", "key_b", "ids", "vector"), ["key_a", "key_b"])
        .select(*group, F.lit(1).alias("side"), "key_a", "key_b", "ids", "vector", F.lit(0.0).alias("bound"))
    )
    asking = (
        asked.join(plan, ["size", "bucket"])
        .withColumn("part", F.pmod(mix, "parts").cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks").cast("bigint") - 1)))
        .join(queries.select("key_a", "key_b", "vector", "bound"), ["key_a", "key_b"])
        .select(*group, F.lit(0).alias("side"), "key_a", "key_b", F.array().cast("array<bigint>").alias("ids"), F.col("vector").cast(kind).alias("vector"), "bound")
    )
    meeting = data.unionByName(asking).repartition(*group).sortWithinPartitions(*group, "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, keys, bounds, asked_rows, members = None, [], [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if keys and members:
                queries_at, least = np.concatenate(asked_rows), np.concatenate(bounds)
                for at in range(0, len(keys), 256):
                    part = slice(at, at + 256)
                    yield _found_batch(_best(queries_at[part], keys[part], least[part], members, search.k + 1))

        for batch in batches:
            marks = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]).astype(np.int64)
            edges = np.flatnonzero(np.any(marks[1:] != marks[:-1], axis=1)) + 1
            for start, end in zip([0, *edges], [*edges, len(marks)]):
                own = tuple(marks[start, :4])
                if own != current:
                    yield from flush()
                    current, keys, bounds, asked_rows, members = own, [], [], [], []
                part = batch.slice(start, end - start)
                x = _matrix(part.column(8))
                if marks[start, 4] == 0:
                    keys += list(zip(part.column(5).to_pylist(), part.column(6).to_pylist()))
                    asked_rows.append(x)
                    bounds.append(part.column(9).to_numpy())
                else:
                    members.append((x, part.column(7).to_pylist()))
        yield from flush()

    return meeting.mapInArrow(compare, _FOUND)
