"""Quality classifier: a byte-level convolutional network in numpy.

A document's UTF-8 bytes are cut into chunks that overlap by the filter width less one, so that
every window of the document lies in exactly one chunk and no byte is left out. Learned filters
run over each chunk, their largest response per chunk is kept, and the mean and the maximum over
the chunks are combined into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickbasin.llm.support import stored
from clickbasin.session import small_frame

# The fit sees at most so many labelled documents, whole, of so many bytes together.
SAMPLE_ROWS, SAMPLE_BYTES = 4_000, 12_000_000
EPOCHS = 12
# Bytes a filter sees, and bytes in a chunk.
WIDTH, CHUNK = 8, 128
PAD = 256


@dataclass(frozen=True)
class Network:
    """``table`` embeds bytes, ``filters`` is (width * dimensions, n), ``head`` weighs the pooled responses."""

    width: int
    chunk: int
    table: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    head: np.ndarray
    offset: float


def chunks_of(data: bytes, width: int, chunk: int) -> np.ndarray:
    """(chunks, chunk length) byte values, padded with ``PAD``; an empty text is one chunk of padding."""
    step = chunk - width + 1
    n = max(1, -(-(len(data) - width + 1) // step))
    padded = np.full((n - 1) * step + chunk, PAD, dtype=np.int16)
    padded[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, chunk)[::step]


def responses(net: Network, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest response of each filter in each chunk, and where it is."""
    n, dim = len(chunks), net.table.shape[1]
    places = net.chunk - net.width + 1
    embedded = net.table[chunks].reshape(n, -1)
    windows = np.lib.stride_tricks.sliding_window_view(embedded, net.width * dim, axis=1)[:, ::dim]
    out = (windows.reshape(n * places, -1) @ net.filters).reshape(n, places, -1)
    at = out.argmax(axis=1)
    return np.take_along_axis(out, at[:, None], axis=1)[:, 0] + net.bias, at


def pooled(best: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document the mean and the maximum over its chunks of the rectified responses."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    live = np.maximum(best, 0)
    mean = np.add.reduceat(live, starts, axis=0) / sizes[:, None]
    return np.concatenate([mean, np.maximum.reduceat(live, starts, axis=0)], axis=1), starts


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _PairTables:
    """The convolution as table look-ups: the response to every pair of bytes, for scoring only."""

    def __init__(self, net: Network):
        dim, n = net.table.shape[1], net.filters.shape[1]
        single = [net.table @ net.filters[j * dim : (j + 1) * dim] for j in range(net.width)]
        self.pairs = [
            (single[j][:, None] + single[j + 1][None]).reshape(-1, n).astype(np.float32)
            for j in range(0, net.width, 2)
        ]
        self.net = net

    def best(self, chunks: np.ndarray) -> np.ndarray:
        codes = chunks[:, :-1].astype(np.int32) * (PAD + 1) + chunks[:, 1:]
        places = self.net.chunk - self.net.width + 1
        total = self.pairs[0][codes[:, :places]]
        for k, part in enumerate(self.pairs[1:], 1):
            total += part[codes[:, 2 * k : 2 * k + places]]
        return total.max(axis=1) + self.net.bias


def probabilities(net: Network, texts: list[str], tables: _PairTables | None = None) -> np.ndarray:
    """One probability a text; chunks are worked off in blocks, so memory does not grow with a text."""
    tables = tables or _PairTables(net)
    features = np.empty((len(texts), 2 * len(net.bias)))
    for i, text in enumerate(texts):
        chunks = chunks_of(text.encode("utf-8", "replace"), net.width, net.chunk)
        total, most = 0.0, np.zeros(len(net.bias))
        for at in range(0, len(chunks), 64):
            live = np.maximum(tables.best(chunks[at : at + 64]), 0)
            total = total + live.sum(axis=0, dtype=np.float64)
            most = np.maximum(most, live.max(axis=0))
        features[i] = np.concatenate([total / len(chunks), most])
    return sigmoid(features @ net.head + net.offset)


def constant(share: float) -> Network:
    """A network that gives every text the same probability."""
    share = min(max(share, 0.01), 0.99)
    return Network(
        2, 16, np.zeros((PAD + 1, 1), np.float32), np.zeros((2, 1), np.float32), np.zeros(1, np.float32),
        np.zeros(2), float(np.log(share / (1 - share))),
    )


def all_chunks(text: str, width: int = WIDTH, chunk: int = CHUNK) -> np.ndarray:
    return chunks_of(text.encode("utf-8", "replace"), width, chunk)


def fit(
    cut: list[np.ndarray], labels: list[int], filters: int = 16, width: int = WIDTH, chunk: int = CHUNK, dim: int = 8,
    epochs: int = EPOCHS, seed: int = 7,
) -> Network:
    """Adam on the log loss of documents given as chunks, with the gradient through both poolings written out.

    With no labels, or labels of one class, every text gets the smoothed share of that class.
    """
    y = np.asarray(labels, dtype=np.float64)
    if len(y) == 0 or y.min() == y.max():
        return constant((y.sum() + 0.5) / (len(y) + 1))
    rng = np.random.default_rng(seed)
    p = {
        "table": rng.normal(0, 0.5, (PAD + 1, dim)).astype(np.float32),
        "filters": rng.normal(0, 1 / np.sqrt(width * dim), (width * dim, filters)).astype(np.float32),
        "bias": np.zeros(filters, np.float32),
        "head": rng.normal(0, 0.1, 2 * filters).astype(np.float32),
        "offset": np.array([np.log(y.mean() / (1 - y.mean()))], np.float32),
    }
    p["table"][PAD] = 0
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0
    size = max(8, min(64, len(y) // 8))
    # A small sample is gone over more often, for about as many steps.
    if len(y) < 1000:
        epochs = max(epochs, min(60, 1200 * size // len(y)))
    for epoch in range(epochs):
        rate = 0.01 * 0.5 * (1 + np.cos(np.pi * epoch / epochs)) + 1e-4
        order = rng.permutation(len(y))
        for at in range(0, len(y), size):
            rows = order[at : at + size]
            net = Network(width, chunk, p["table"], p["filters"], p["bias"], p["head"], float(p["offset"][0]))
            sizes = np.array([len(cut[i]) for i in rows])
            chunks = np.concatenate([cut[i] for i in rows])
            best, place = responses(net, chunks)
            features, starts = pooled(best, sizes)
            error = (sigmoid(features @ p["head"] + p["offset"][0]) - y[rows]) / len(rows)
            grad = {"head": features.T @ error + 1e-4 * p["head"], "offset": np.array([error.sum()])}
            outer = error[:, None] * p["head"][None]
            owner = np.repeat(np.arange(len(rows)), sizes)
            to_best = outer[owner, :filters] / sizes[owner, None]
            live = np.maximum(best, 0)
            is_most = live == np.maximum.reduceat(live, starts, axis=0)[owner]
            to_best = (to_best + outer[owner, filters:] * is_most) * (best > 0)
            grad["bias"] = to_best.sum(axis=0)
            which, by = np.nonzero(to_best)
            g = to_best[which, by].astype(np.float32)
            seen = chunks[which[:, None], place[which, by][:, None] + np.arange(width)]
            embedded = p["table"][seen].reshape(len(which), -1)
            grad["filters"] = np.zeros_like(p["filters"])
            for f in range(filters):
                own = by == f
                grad["filters"][:, f] = g[own] @ embedded[own]
            back = (g[:, None] * p["filters"].T[by]).reshape(-1, dim)
            flat = seen.reshape(-1)
            grad["table"] = np.stack([np.bincount(flat, back[:, k], PAD + 1) for k in range(dim)], axis=1)
            grad["table"][PAD] = 0
            step += 1
            for k, (m, v) in moments.items():
                m[...] = 0.9 * m + 0.1 * grad[k]
                v[...] = 0.999 * v + 0.001 * grad[k] ** 2
                p[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Network(
        width, chunk, p["table"], p["filters"], p["bias"], p["head"].astype(np.float64), float(p["offset"][0])
    )


def train(sample: DataFrame) -> Network:
    """Fit on (doc_id, text, label) rows, whose number the caller has bounded.

    They are taken in the order of a hash of the id while their texts have ``SAMPLE_BYTES`` bytes together; one
    that would exceed them is passed over. Texts are never cut: the fit pools over all chunks, as scoring does.
    """
    sample = stored(sample, "quality-sample")
    sizes = sample.select("doc_id", F.octet_length("text").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id", "n")
    taken, room = [], SAMPLE_BYTES
    for row in sizes.collect():  # an id and a number each
        if row.n <= room:
            taken.append(row.doc_id)
            room -= row.n
    chosen = small_frame(sample.sparkSession, [(doc_id,) for doc_id in taken], T.StructType([sample.schema["doc_id"]]))
    rows = sorted(sample.join(chosen, "doc_id", "left_semi").collect(), key=lambda row: (row.doc_id, row.text))
    return fit([all_chunks(row.text) for row in rows], [row.label for row in rows])


def quality(net: Network, text: Column) -> Column:
    """The probability of label 1 for each text; a null text counts as empty."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = _PairTables(net)
        for batch in batches:
            yield pa.array(probabilities(net, [x or "" for x in batch.to_pylist()], tables), pa.float64())

    return score(text)
