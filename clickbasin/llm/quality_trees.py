"""Quality rules: gradient-boosted trees over document statistics, behind two fixed rules.

A document's statistics are counted over its whole text, as bytes. Too few words, or too many words
in repeated windows, fail a document by rule. What passes is judged by trees, which are fitted with
constraints: on the features named in ``FALLING`` the score never rises as the feature does, whatever
the other features are. For scoring, the trees are flattened into arrays of nodes, and all rows of a
batch go down all trees together.

Rules: a null text counts as empty and has no words. Rows that share an id are judged each. Texts are cut
at white space while words are numbered, so that a very long one takes memory in proportion to its
distinct words and eight bytes a word.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules, the window of words, the symbols. White space is ASCII's.
LEAST_WORDS, MOST_REPEATED, WINDOW, SYMBOLS = 50, 50, 3, b"#*$%&|<>"
# The fit sees at most so many labelled documents; only their features reach the driver.
SAMPLE_ROWS = 8_000
# A document that passes the rules is kept from this score on.
LEAST_SCORE = 0.5
TREES, DEPTH, RATE, BINS, RIDGE, LEAST_WEIGHT = 120, 3, 0.15, 48, 2.0, 1.0

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "words", "word_length", "symbols", "dup_lines", "repeats", "capitals", "digits", "shouts", "stops",
    "distinct", "commonest", "line_words", "bare_words", "closed_lines", "other_bytes",
)
# The score never rises with these.
FALLING = ("symbols", "dup_lines", "repeats", "shouts", "commonest", "bare_words")

_SPACE = b" \t\n\x0b\x0c\r"
_ASCII_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")
_FOLLOWING = bytes(range(0x80, 0xC0))
_CAPITALS, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_LETTERLESS = bytes(x for x in range(128) if not chr(x).isalpha())
_ASCII = bytes(range(128))
_PIECE = 1 << 20


def _pieces(data: bytes) -> Iterator[bytes]:
    """The text in parts that end at white space."""
    at = 0
    while at < len(data):
        end = _ASCII_SPACE.search(data, at + _PIECE) if len(data) - at > _PIECE else None
        stop = end.end() if end else len(data)
        yield data[at:stop]
        at = stop


def _count(data: bytes, of: bytes) -> int:
    return len(data) - len(data.translate(None, of))


def _repeated(ids: np.ndarray, distinct: int) -> int:
    """Words that lie in windows found twice or more, the first included."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    key = ids[:n]
    for k in range(1, WINDOW):
        if int(key.max()) >= 2**62 // (distinct + 1):
            key = np.unique(key, return_inverse=True)[1]
        key = key * (distinct + 1) + ids[k : k + n]
    _, which, counts = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[which] > 1)
    covered = np.zeros(len(ids), bool)
    for k in range(WINDOW):
        covered[starts + k] = True
    return int(covered.sum())


def statistics(data: bytes) -> tuple[list[int], list[float]]:
    """The counts of ``BASE`` and the values of ``FEATURES`` of one UTF-8 text."""
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    ids = np.concatenate([np.fromiter(map(known.__getitem__, piece.split()), np.int64) for piece in _pieces(data)] or [np.zeros(0, np.int64)])
    lines = [line for line in data.split(b"\n") if line.strip(_SPACE)]
    letters = len(data.translate(None, _SPACE))
    n, chars = len(ids), letters - _count(data, _FOLLOWING)
    symbols, dup, repeats = _count(data, SYMBOLS), len(lines) - len(set(lines)), _repeated(ids, len(known))
    base = [n, chars, symbols, dup, repeats]
    counts = np.bincount(ids, minlength=1)
    bare = sum(int(counts[k]) for word, k in known.items() if not word.translate(None, _LETTERLESS))
    words, size, rows = max(1, n), max(1, letters), max(1, len(lines))
    features = [
        float(np.log1p(n)),
        chars / words,
        symbols / words,
        dup / rows,
        repeats / words,
        _count(data, _CAPITALS) / size,
        _count(data, _DIGITS) / size,
        data.count(b"!") / words,
        _count(data, b".?") / words,
        len(known) / words,
        float(counts.max()) / words,
        n / rows,
        bare / words,
        sum(line.rstrip(_SPACE).endswith((b".", b"!", b"?", b'"')) for line in lines) / rows,
        len(data.translate(None, _ASCII)) / size,
    ]
    return base, features


# The trees ---------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """All trees' nodes in arrays. A node's rows go left where the feature is at most the threshold; leaves lead to themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    offset: float
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of features."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return 1 / (1 + np.exp(-np.clip(self.value[node].sum(axis=1) + self.offset, -30, 30)))


def _best_split(g: np.ndarray, h: np.ndarray, low: float, high: float, direction: np.ndarray, cuts: list[np.ndarray]):
    """(gain, feature, bin, left value, right value) of one node's histograms, or none that gains."""

    def value(gs: np.ndarray, hs: np.ndarray) -> np.ndarray:
        return np.clip(-gs / (hs + RIDGE), low, high)

    def loss(v: np.ndarray, gs: np.ndarray, hs: np.ndarray) -> np.ndarray:
        return gs * v + 0.5 * (hs + RIDGE) * v * v

    gl, hl = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    gt, ht = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
    gr, hr = gt - gl, ht - hl
    vl, vr = value(gl, hl), value(gr, hr)
    gain = loss(value(gt, ht), gt, ht) - loss(vl, gl, hl) - loss(vr, gr, hr)
    fits = (hl >= LEAST_WEIGHT) & (hr >= LEAST_WEIGHT) & (direction[:, None] * (vr - vl) >= 0)
    fits &= np.arange(gl.shape[1])[None] < np.array([len(c) for c in cuts])[:, None]
    gain = np.where(fits, gain, 0)
    at = np.unravel_index(gain.argmax(), gain.shape)
    return (float(gain[at]), *map(int, at), float(vl[at]), float(vr[at])) if gain[at] > 1e-6 else None


def fit(x: np.ndarray, y: np.ndarray, falling: tuple[str, ...] = FALLING, trees: int = TREES) -> Forest:
    """Trees for rows of ``FEATURES`` and labels 0 or 1; without both labels a smoothed constant.

    A node that is split on a constrained feature hands the middle of its children's values down as a bound,
    so that the constraint holds across the whole tree, and so for the sum of all.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    offset = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []
    roots = []
    direction = np.array([-1 if name in falling else 0 for name in FEATURES])
    if len(set(y.tolist())) == 2:
        cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for column in x.T]
        cuts = [c[c < column.max()] for c, column in zip(cuts, x.T)]
        binned = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, x.T)], axis=1)
        flat = binned + np.arange(x.shape[1]) * BINS
        raw = np.full(len(y), offset)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            g, h = p - y, p * (1 - p)
            roots.append(len(nodes))
            nodes.append([0, np.inf, 0, 0, 0.0])
            open_nodes = [(roots[-1], np.arange(len(y)), -np.inf, np.inf, 0)]
            while open_nodes:
                node, rows, low, high, depth = open_nodes.pop()
                split = None
                if depth < DEPTH:
                    size = x.shape[1] * BINS
                    shape = (x.shape[1], BINS)
                    hist = [np.bincount(flat[rows].ravel(), np.repeat(w[rows], x.shape[1]), size).reshape(shape) for w in (g, h)]
                    split = _best_split(*hist, low, high, direction, cuts)
                if split is None:
                    value = float(np.clip(-g[rows].sum() / (h[rows].sum() + RIDGE), low, high)) * RATE
                    nodes[node] = [0, np.inf, node, node, value]
                    raw[rows] += value
                    continue
                _, feature, at, left_value, right_value = split
                middle = (left_value + right_value) / 2
                left_low, right_high = (middle, middle) if direction[feature] < 0 else (low, high)
                goes_left = binned[rows, feature] <= at
                left, right = len(nodes), len(nodes) + 1
                nodes += [[0, np.inf, left, left, 0.0], [0, np.inf, right, right, 0.0]]
                nodes[node] = [feature, float(cuts[feature][at]), left, right, 0.0]
                open_nodes.append((left, rows[goes_left], left_low, high, depth + 1))
                open_nodes.append((right, rows[~goes_left], low, right_high, depth + 1))
    if not nodes:
        nodes, roots = [[0, np.inf, 0, 0, 0.0]], [0]
    feature, threshold, left, right, value = map(np.array, zip(*nodes))
    whole = [a.astype(np.int64) for a in (feature, left, right)]
    return Forest(whole[0], threshold.astype(float), whole[1], whole[2], value.astype(float), np.array(roots, np.int64), offset, DEPTH)


# On Spark ------------------------------------------------------------------------


def _fields(scored: bool) -> str:
    names = [f"{name}: bigint" for name in BASE] + ["features: array<double>"] + ["score: double"] * scored
    return f"struct<{', '.join(names)}>"


def _measured(texts: pa.Array, forest: Forest | None) -> pa.Array:
    rows = [statistics(text.as_py() or b"") for text in texts]
    base = np.array([b for b, _ in rows], np.int64).reshape(-1, len(BASE))
    features = np.array([f for _, f in rows], np.float64).reshape(-1, len(FEATURES))
    arrays = [pa.array(column) for column in base.T]
    arrays.append(pa.ListArray.from_arrays(np.arange(0, features.size + 1, len(FEATURES), dtype=np.int32), features.reshape(-1)))
    names = [*BASE, "features"]
    if forest is not None:
        arrays.append(pa.array(forest.scores(features)))
        names.append("score")
    return pa.StructArray.from_arrays(arrays, names=names)


def measured(text: Column, forest: Forest | None = None) -> Column:
    """A structure of the counts of ``BASE``, the features and, with a forest, the score of a text."""

    @F.arrow_udf(_fields(forest is not None))
    def measure(texts: pa.Array) -> pa.Array:
        return _measured(texts, forest)

    return measure(text.cast("binary"))


def train(sample: DataFrame) -> Forest:
    """Fit on (doc_id, text, label) rows, whose number the caller has bounded."""
    rows = sample.select(measured(F.col("text"))["features"].alias("x"), "label").collect()
    rows = sorted((list(row.x), row.label) for row in rows)
    return fit(np.array([x for x, _ in rows]).reshape(-1, len(FEATURES)), np.array([y for _, y in rows], float))


def judged(docs: DataFrame, forest: Forest, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, the counts of ``BASE``, base_failed, kept, score): every document's counts and whether it is kept."""
    rows = docs.select(F.col(f"`{id_column}`"), measured(F.col(f"`{column}`"), forest).alias("m"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = rows.select(f"`{id_column}`", *[F.col("m")[name].alias(name) for name in BASE], F.col("m")["score"].alias("score"))
    return rows.select(f"`{id_column}`", *BASE, failed.alias("base_failed"), (~failed & (F.col("score") >= LEAST_SCORE)).alias("kept"), "score")
