"""Vector code compression: vectors cut into parts, each part coded by its nearest codebook entry, found by ball k-means.

Components become whole numbers, so that every distance, sum and mean is exact. Entries are the means of
their parts after each of some rounds. A part that already has an entry lies in that entry's ball:

* the ball's radius, of the parts of a block of vectors, says which entries are neighbours at all, namely
  those not farther from the ball's entry than twice the radius;
* the ball's stable core are the parts nearer to the entry than half way to the closest neighbour: they
  keep the entry without a comparison;
* the others lie in rings by how many neighbours are within twice their own distance, and a ring is
  compared with these neighbours only.

What is left out is farther away, by the triangle inequality, so that codes are those of a full
comparison, ties to the lower index included.

Rules: null vectors and vectors with null or non-finite components are dropped. Rows that share an id are
coded each. Null ids come last when the first entries are chosen; equal ids go by the vector. Vectors of
each length have codebooks of their own (lengths are few: an embedding model has one); a length that the
parts do not divide counts as if zeros followed. Components beyond ``LARGEST`` count as that, so that sums
fit their type. Further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickbasin.llm.support import stored

# What a component is multiplied by, parts, entries of a codebook, rounds.
SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
LARGEST = 2**24
# Components that a task holds at a time.
BLOCK_VALUES = 2_000_000
# Rings by the number of entries to compare with.
RINGS = (1, 2, 4, 8, 16, 32)

Codebooks = dict[int, np.ndarray]


def whole(vector: Column) -> Column:
    """Whether a vector is coded: not null, every component finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))


def _integers(vector: Column) -> Column:
    scaled = F.transform(vector, lambda x: x.cast("double") * SCALE)
    held = F.transform(scaled, lambda x: F.greatest(F.least(x, F.lit(float(LARGEST))), F.lit(float(-LARGEST))))
    return F.transform(held, lambda x: F.floor(x).cast("int"))


def _cut(flat: np.ndarray, n: int) -> np.ndarray:
    """(n, PARTS, width) of ``n`` vectors of one length, one after the other."""
    vectors = flat.reshape(n, -1).astype(np.int64)
    width = -(-vectors.shape[1] // PARTS)
    out = np.zeros((n, PARTS * width), np.int64)
    out[:, : vectors.shape[1]] = vectors
    return out.reshape(n, PARTS, width)


def _squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """(rows, entries): squared distances, exact."""
    if not x.shape[1]:
        return np.zeros((len(x), len(entries)), np.int64)
    most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * int(most) ** 2 * x.shape[1] < 2**52:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None]).astype(np.int64)
    return np.stack([((x - entry) ** 2).sum(axis=1) for entry in entries], axis=1)


@dataclass
class Work:
    """Squared distances that were computed, of those a full comparison takes."""

    done: int = 0
    full: int = 0


class Balls:
    """The entries of one part's codebook, each with the others in order of distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        between = _squared(entries, entries)
        self.order = np.argsort(between, axis=1, kind="stable")
        self.apart = np.take_along_axis(between, self.order, axis=1)

    def nearest(self, x: np.ndarray, held: np.ndarray | None, work: Work) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest entry and the squared distance; ``held`` are the entries they had, if any."""
        work.full += len(x) * len(self.entries)
        if held is None:
            work.done += len(x) * len(self.entries)
            found = _squared(x, self.entries)
            code = found.argmin(axis=1)
            return code, np.take_along_axis(found, code[:, None], axis=1)[:, 0]
        code, error = held.astype(np.int64), ((x - self.entries[held]) ** 2).sum(axis=1)
        work.done += len(x)
        by_ball = np.argsort(held, kind="stable")
        ends = np.searchsorted(held[by_ball], np.arange(len(self.entries) + 1))
        for ball in np.flatnonzero(np.diff(ends)):
            rows = by_ball[ends[ball] : ends[ball + 1]]
            # Neighbours within twice the radius, and of these, how many each row has to be compared with.
            near = self.apart[ball][: np.searchsorted(self.apart[ball], 4 * error[rows].max(), side="right")]
            if len(near) == 1:
                continue
            count = np.searchsorted(near, 4 * error[rows], side="right")
            for least, most in zip(RINGS, (*RINGS[1:], len(self.entries))):
                ring = rows[(count > least) & (count <= most)]
                if len(ring):
                    # In ascending order of index: the first of equal ones is the lowest.
                    others = np.sort(self.order[ball][: min(most, len(near))])
                    work.done += len(ring) * len(others)
                    found = _squared(x[ring], self.entries[others])
                    best = found.argmin(axis=1)
                    code[ring], error[ring] = others[best], np.take_along_axis(found, best[:, None], axis=1)[:, 0]
        return code, error


def coded(x: np.ndarray, balls: list[Balls], held: np.ndarray | None, work: Work) -> tuple[np.ndarray, np.ndarray]:
    """(n, PARTS) entries of cut vectors, and each vector's squared distances, summed."""
    code, error = np.zeros(x.shape[:2], np.uint8), np.zeros(len(x), np.int64)
    for part, ball in enumerate(balls):
        code[:, part], found = ball.nearest(x[:, part], None if held is None else held[:, part], work)
        error += found
    return code, error


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(length, rows) of vectors of one length, of bounded size."""
    held: dict[int, list[pa.RecordBatch]] = {}
    rows: dict[int, int] = {}
    for batch in batches:
        lengths = batch.column("size").to_numpy()
        for size in np.unique(lengths):
            own = np.flatnonzero(lengths == size)
            held.setdefault(int(size), []).append(batch if len(own) == len(batch) else batch.take(pa.array(own)))
            rows[int(size)] = rows.get(int(size), 0) + len(own)
            if rows[int(size)] * max(1, size) >= BLOCK_VALUES:
                rows.pop(int(size))
                yield int(size), pa.Table.from_batches(held.pop(int(size))).combine_chunks().to_batches()[0]
    for size, parts in held.items():
        yield size, pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _vectors(block: pa.RecordBatch) -> np.ndarray:
    return _cut(block.column("vector").flatten().to_numpy(), len(block))


def _codes(block: pa.RecordBatch) -> np.ndarray | None:
    if block.column("code").null_count:
        return None
    return np.frombuffer(b"".join(block.column("code").to_pylist()), np.uint8).reshape(-1, PARTS)


def _assigned(rows: DataFrame, codebooks: Codebooks, with_vector: bool) -> DataFrame:
    """``rows`` with the codes and errors of these codebooks, with the vector or with the codebook's digest."""
    shared = rows.sparkSession.sparkContext.broadcast(codebooks)
    names = ["id", "label", "size", "code", "error", "vector" if with_vector else "digest"]
    last = rows.schema["vector"] if with_vector else T.StructField("digest", T.StringType())
    schema = T.StructType([*(rows.schema[name] for name in names[:4]), T.StructField("error", T.LongType()), last])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls, digests = {}, {}
        for size, block in _blocks(batches):
            if size not in balls:
                balls[size] = [Balls(entries) for entries in shared.value[size]]
                digests[size] = digest(shared.value[size])
            code, error = coded(_vectors(block), balls[size], _codes(block), Work())
            code = pa.FixedSizeBinaryArray.from_buffers(pa.binary(PARTS), len(block), [None, pa.py_buffer(code.tobytes())])
            last = block.column("vector") if with_vector else pa.array([digests[size]] * len(block), pa.string())
            yield pa.RecordBatch.from_arrays([*block.columns[:3], code.cast(pa.binary()), pa.array(error), last], names=names)

    return rows.select("id", "label", "size", "code", "vector").mapInArrow(work, schema)


def _means(rows: DataFrame, codebooks: Codebooks) -> Codebooks:
    """The codebooks after their entries are replaced by their parts' means; unused ones stay.

    What reaches the driver is a number for each component of a codebook.
    """
    entries = {size: book.shape[1] for size, book in codebooks.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for size, block in _blocks(batches):
            x, code = _vectors(block), _codes(block)
            one = np.concatenate([x, np.ones((*x.shape[:2], 1), np.int64)], axis=2)
            total = sums.setdefault(size, np.zeros((PARTS, entries[size], one.shape[2]), np.int64))
            for part in range(PARTS):
                np.add.at(total[part], code[:, part], one[:, part])
        for size, total in sums.items():
            part, entry = np.nonzero(total[:, :, -1])
            columns = [pa.array(np.full(len(part), size, np.int32)), pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32))]
            places = np.arange(total.shape[2] - 1)
            for at in places:
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.full(len(part), at, np.int32)), pa.array(total[part, entry, at]), pa.array(total[part, entry, -1])],
                    names=["size", "part", "entry", "place", "sum", "n"],
                )

    found = rows.select("size", "code", "vector").mapInArrow(work, "size int, part int, entry int, place int, sum long, n long")
    found = found.groupBy("size", "part", "entry", "place").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))
    out = {size: book.copy() for size, book in codebooks.items()}
    for row in found.collect():
        out[row.size][row.part, row.entry, row.place] = row.sum // row.n
    return out


def _first(rows: DataFrame) -> Codebooks:
    """The parts of the vectors of the smallest ids, for each length of vector."""
    order = Window.partitionBy("size").orderBy(F.col("id").asc_nulls_last(), "vector")
    chosen = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= ENTRIES)
    found: dict[int, list] = {}
    for row in sorted(chosen.select("size", "place", "vector").collect()):
        found.setdefault(row.size, []).append(row.vector)
    return {size: _cut(np.array(vectors, np.int64).reshape(-1), len(vectors)).transpose(1, 0, 2) for size, vectors in found.items()}


def digest(codebook: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, codebook.reshape(-1).tolist())).encode()).hexdigest()


def trained(
    vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", label_column: str = "label", rounds: int = ROUNDS
) -> tuple[DataFrame, Codebooks]:
    """Every vector that is coded, with the entries it has in the last codebooks, and these codebooks.

    The frame has id, label, size, code (a byte a part), error and the codebook's digest.
    """
    vector = F.col(f"`{column}`")
    rows = vectors.where(whole(vector)).select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{label_column}`").alias("label"),
        F.size(vector).alias("size"),
        _integers(vector).alias("vector"),
        F.lit(None).cast("binary").alias("code"),
    )
    codebooks = _first(rows)
    for _ in range(rounds):
        rows = stored(_assigned(rows, codebooks, with_vector=True), "vector-round")
        codebooks = _means(rows, codebooks)
    return stored(_assigned(rows, codebooks, with_vector=False), "vector-codes"), codebooks


def compressed(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", label_column: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256): the codes in hexadecimal, and the error of all vectors of a label."""
    rows, _ = trained(vectors, id_column, column, label_column)
    total = rows.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.col("label").alias("of_label"), "label_error")
    joined = rows.join(total, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select(
        F.col("id").alias(id_column),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.col("digest").alias("codebooks_sha256"),
    )
