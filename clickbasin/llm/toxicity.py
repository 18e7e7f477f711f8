"""Toxicity: a weighted lexicon, matched by Aho-Corasick over folded text.

Marks that stand by themselves and characters without width go first. Folding then is one character for one
character: letters become lower case, look-alikes of other scripts and decorated forms become Latin, and
digits and signs between letters, or before the first one, become the letters they replace. Some characters may
be meant either way, namely digits and signs behind a word's last letter ("idio7", "idiot1") and letters with
marks that are letters of their own in some language ("idiöt", "schön"): texts with such are matched in both forms.
An exclamation mark at the end stays one. ``spans`` says where in the original text the matches are.

A term counts where a word begins; a whole-word term must also end there, but for the ending of a plural. Matches
inside an exception phrase do not count. The summed weights, taken by themselves and per hundred words, give one
probability.

Word beginnings are learned only where several different words share one: what a single word begins with says
nothing of other words that begin alike ("pathetic", "pathology").
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickbasin.llm.support import stored

# The fit sees at most so many labelled documents.
SAMPLE_ROWS = 12_000
# A learned term is a whole word or a word beginning of one of these lengths.
STEM_LENGTHS = range(4, 10)
# A term needs this many toxic documents, and this much more of them than chance gives.
LEAST_SUPPORT = 4
LEAST_LOG_ODDS = 2.5
# A word beginning needs so many different words, each of them telling and found in so many toxic documents.
LEAST_WORDS, LEAST_WORD_SUPPORT = 3, 2

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
    "ᴀ": "a", "ʙ": "b", "ᴄ": "c", "ᴅ": "d", "ᴇ": "e", "ꜰ": "f", "ɢ": "g", "ʜ": "h", "ɪ": "i", "ᴊ": "j", "ᴋ": "k",
    "ʟ": "l", "ᴍ": "m", "ɴ": "n", "ᴏ": "o", "ᴘ": "p", "ʀ": "r", "ꜱ": "s", "ᴛ": "t", "ᴜ": "u", "ᴠ": "v", "ᴡ": "w",
    "ʏ": "y", "ᴢ": "z",
}
# What digits and signs between letters stand for.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
# Letters with marks that are letters of their own in the languages at hand.
OWN_LETTERS = set("äöüßàâæçéèêîôœùûñáíóú")
# Terms every lexicon starts from, with their weights, and phrases that lift them.
SEED_TERMS = {
    "idiot": 1.0, "moron": 1.0, "imbecile": 1.0, "stupid": 0.7, "loser": 0.7, "scum": 1.0, "scumbag": 1.5,
    "bastard": 1.0, "asshole": 1.5, "bitch": 1.2, "pathetic": 0.6, "worthless": 0.6, "disgusting": 0.6,
}
EXCEPTIONS = ("idiot proof", "idiot's guide", "sore loser", "pond scum", "stupid question")

_BETWEEN = re.compile(r"(?:(?<=[^\W\d_])|(?<![\w@$!]))[0134578@$!]++(?=[^\W\d_])")
_BEHIND = re.compile(r"[0134578@$!](?<=[^\W\d_][0134578@$!])[0134578@$!]*(?<!!)(?![^\W_])")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_SIGNS = str.maketrans(SUBSTITUTES)
# Marks that are set on the letter before, and characters without width.
_MARKS = "\u0300-\u036f\u0483-\u0489\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f"
_WIDTHLESS = "\u00ad\u180e\u200b-\u200f\u2060-\u2064\ufeff"
_ANY_LOOSE = re.compile(f"[{_MARKS}{_WIDTHLESS}]")
_LOOSE = re.compile(f"([^{_MARKS}{_WIDTHLESS}])([{_MARKS}{_WIDTHLESS}]+)|[{_MARKS}{_WIDTHLESS}]+")
# Scripts that write words without spaces, two characters to a word.
_UNSPACED = re.compile("[\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")
_BARE = str.maketrans({letter: unicodedata.normalize("NFKD", letter)[0] for letter in OWN_LETTERS} | {"ß": "s", "æ": "a", "œ": "o"})


class _Letters(dict):
    """One folded character for each character, worked out when first met."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        lower = char.lower()
        lower = lower[0] if lower else char
        if lower in LOOK_ALIKES:
            out = LOOK_ALIKES[lower]
        elif ord(lower) < 128 or lower in OWN_LETTERS:
            out = lower
        else:
            base = unicodedata.normalize("NFKD", lower)[0].lower()[:1]
            out = base if base.isascii() and base.isalpha() else lower
        self[code] = out
        return out


_LETTERS = _Letters()


def _bound(found: re.Match) -> str:
    """One character for a letter and what is set on it: the letter with its mark where there is such a one."""
    if not found[1]:
        return ""
    whole = unicodedata.normalize("NFC", found[1] + "".join(c for c in found[2] if unicodedata.combining(c)))
    return whole if len(whole) == 1 else found[1]


def tight(text: str) -> str:
    """The text without loose marks and widthless characters."""
    return text if text.isascii() or not _ANY_LOOSE.search(text) else _LOOSE.sub(_bound, text)


def _places(text: str) -> list[int]:
    """For each place of ``tight(text)``, and its end, the place in the text."""
    out, at = [], 0
    for found in _LOOSE.finditer(text):
        out += range(at, found.start() + (1 if found[1] else 0))
        at = found.end()
    return [*out, *range(at, len(text) + 1)]


def folded(text: str) -> str:
    """The text in folded form, of the same length."""
    text = text.translate(_LETTERS)
    return _BETWEEN.sub(lambda m: m.group().translate(_SIGNS), text)


def forms(low: str) -> tuple[str, ...]:
    """A folded text in each way it may be meant, of the same length: digits or signs at the ends of words, letters with marks."""
    other = _BEHIND.sub(lambda m: m.group().translate(_SIGNS), low)
    bare = other if low.isascii() else other.translate(_BARE)
    return tuple(dict.fromkeys((low, other, bare)))


@dataclass
class Lexicon:
    """Terms with weights: ``words`` match whole words, ``stems`` match where words begin."""

    words: dict[str, float] = field(default_factory=lambda: dict(SEED_TERMS))
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    # Weights of: a constant, the summed weights (logarithm), the same per hundred words.
    curve: tuple[float, float, float] = (-4.0, 4.0, 1.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        entries: dict[str, list[tuple[str, int, float]]] = {}
        for kind, terms in (("word", self.words), ("stem", self.stems)):
            for term, weight in terms.items():
                entries.setdefault(folded(term), []).append((kind, len(term), weight))
        for phrase in self.exceptions:
            entries.setdefault(folded(phrase), []).append(("exception", len(phrase), 0.0))
        for term, uses in entries.items():
            found.add_word(term, tuple(uses))
        if entries:
            found.make_automaton()
        return found


def _word_ends(low: str, end: int) -> bool:
    """Whether a word ends here, or after the ending of a plural."""
    for ending in ("", "s", "es"):
        stop = end + len(ending)
        if low.startswith(ending, end) and (stop == len(low) or not low[stop].isalpha()):
            return True
    return False


def matches(automaton: ahocorasick.Automaton, *lows: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the terms that count in any form: at each place where a word begins, the heaviest."""
    if not len(automaton):
        return []
    best: dict[int, tuple[int, int, float]] = {}
    lifted = []
    for low in lows:
        for last, uses in automaton.iter(low):
            for kind, size, weight in uses:
                start, end = last + 1 - size, last + 1
                if start and low[start - 1].isalpha():
                    continue
                if kind == "exception":
                    if end == len(low) or not low[end].isalpha():
                        lifted.append((start, end))
                elif (kind == "stem" or _word_ends(low, end)) and (start not in best or weight > best[start][2]):
                    best[start] = (start, end, weight)
    if not lifted:
        return list(best.values())
    # Of the phrases that begin no later than a match, the one that ends last decides.
    lifted.sort()
    begins = [start for start, _ in lifted]
    ends = list(accumulate((end for _, end in lifted), max))
    covered = lambda m: (k := bisect_right(begins, m[0])) and ends[k - 1] >= m[1]
    return [m for m in best.values() if not covered(m)]


def spans(automaton: ahocorasick.Automaton, text: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) of what counts, by place in the text as it is, in ascending order."""
    places = _places(text)
    return [(places[start], places[end], weight) for start, end, weight in sorted(matches(automaton, *forms(folded(tight(text)))))]


def measures(automaton: ahocorasick.Automaton, text: str) -> tuple[float, float]:
    """The summed weights, and the same per hundred words (a text has one word at least)."""
    low = folded(tight(text))
    total = sum(weight for _, _, weight in matches(automaton, *forms(low)))
    if not total:
        return 0.0, 0.0
    words = len(_WORD.findall(low)) + len(_UNSPACED.findall(low)) // 2
    return total, 100 * total / max(1, words)


def probability(curve: tuple[float, float, float], total: float, density: float) -> float:
    z = curve[0] + curve[1] * math.log1p(total) + curve[2] * math.log1p(density)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _fit_curve(features: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Penalised logistic regression whose two slopes are kept from falling below zero."""
    x = np.column_stack([np.ones(len(y)), np.log1p(features)])
    w = np.array([-3.0, 1.0, 0.5])
    pull = np.array([1e-3, 0.05, 0.05])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + pull * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        w = w - np.clip(np.linalg.solve(bend, slope), -1, 1)
        w[1:] = np.maximum(w[1:], 0)
    return tuple(float(v) for v in w)


def _terms_of(low: str) -> tuple[set[str], set[str]]:
    words = {word for form in forms(low) for word in _WORD.findall(form)}
    return words, {word[:n] for word in words for n in STEM_LENGTHS if len(word) > n}


def _choose(counts: Iterable[tuple[str, str, int, int]], toxic: int, clean: int) -> tuple[dict, dict]:
    """Words and stems that tell toxic documents, with their log odds as weights.

    Stems are looked at from the longest to the shortest. One needs several different telling words; it takes the
    place of the longer ones inside it where it is about as telling and has several telling words more than they
    have. A word that a kept stem covers is dropped.
    """
    telling: dict[str, dict[str, float]] = {"word": {}, "stem": {}}
    members: dict[str, set[str]] = {}
    for kind, term, n, others in counts:
        weight = math.log((n + 0.5) / (toxic + 1)) - math.log((others + 0.5) / (clean + 1))
        if weight < LEAST_LOG_ODDS:
            continue
        if kind == "word" and n >= LEAST_WORD_SUPPORT:
            for size in STEM_LENGTHS:
                if len(term) > size:
                    members.setdefault(term[:size], set()).add(term)
        # Chance alone gives rare terms high odds: ask for more the fewer documents there are.
        if n >= LEAST_SUPPORT and n * weight >= 20:
            telling[kind][term] = weight
    stems: dict[str, float] = {}
    for term in sorted(telling["stem"], key=lambda t: (-len(t), t)):
        own, inside = members.get(term, set()), [stem for stem in stems if stem.startswith(term)]
        more = own.difference(*(members[stem] for stem in inside))
        if len(more) >= LEAST_WORDS and all(telling["stem"][term] >= stems[stem] - 1 for stem in inside):
            stems = {stem: weight for stem, weight in stems.items() if stem not in inside} | {term: telling["stem"][term]}
    words = {
        term: weight
        for term, weight in telling["word"].items()
        if not any(stems.get(term[:n], -1) >= weight - 0.5 for n in STEM_LENGTHS)
    }
    return dict(sorted(words.items())), dict(sorted(stems.items()))


def _exceptions(
    counts: Iterable[tuple[str, str, int, int]], stems: dict[str, float], toxic: int, clean: int
) -> tuple[str, ...]:
    """Whole words that a stem would catch although they do not tell toxic documents themselves.

    Counts are weighed by how many documents of each label there are: a word is lifted where its documents
    are likelier for a word that tells nothing than for one of the stem's log odds, unless its own log odds
    would do for a term.
    """
    share = toxic / (toxic + clean)
    lifted = []
    for kind, term, n, others in counts:
        weight = max((stems[term[:k]] for k in STEM_LENGTHS if term[:k] in stems), default=None)
        if kind != "word" or weight is None:
            continue
        own = math.log((n + 0.5) / (toxic + 1)) - math.log((others + 0.5) / (clean + 1))
        if n >= LEAST_SUPPORT and own >= LEAST_LOG_ODDS:
            continue
        if n * weight < (n + others) * math.log1p(share * math.expm1(weight)):
            lifted.append(term)
    return tuple(lifted)


def learn(sample: DataFrame) -> Lexicon:
    """A lexicon from (doc_id, text, label) rows, whose number the caller has bounded.

    Documents are counted by term on the executors; what reaches the driver is the terms that
    tell, which the sample's size bounds, and three numbers for each document of the sample. Without toxic documents among the
    rows the seed terms remain.
    """
    sample = stored(sample, "toxicity-sample")
    sizes = dict(sample.groupBy("label").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    lexicon = Lexicon()
    if not toxic or not clean:
        return lexicon

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {("word", 0): Counter(), ("word", 1): Counter(), ("stem", 0): Counter(), ("stem", 1): Counter()}
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, stems = _terms_of(folded(tight(text)))
                found["word", label].update(words)
                found["stem", label].update(stems)
        for (kind, label), terms in found.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "kind": pa.array([kind] * len(terms), pa.string()),
                    "term": pa.array(terms.keys(), pa.string()),
                    "toxic": pa.array([n if label else 0 for n in terms.values()], pa.int64()),
                    "clean": pa.array([0 if label else n for n in terms.values()], pa.int64()),
                }
            )

    by_term = (
        sample.select("text", "label")
        .mapInArrow(count_terms, "kind string, term string, toxic long, clean long")
        .groupBy("kind", "term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("toxic") >= LEAST_SUPPORT) | (F.col("kind") == "word") & ((F.col("clean") >= 1) | (F.col("toxic") >= LEAST_WORD_SUPPORT)))
    )
    by_term = stored(by_term, "toxicity-terms")
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    least = F.when(F.col("kind") == "word", LEAST_WORD_SUPPORT).otherwise(LEAST_SUPPORT)
    strong = by_term.where((F.col("toxic") >= least) & (odds >= LEAST_LOG_ODDS)).collect()
    words, stems = _choose(strong, toxic, clean)
    lexicon.words |= words
    lexicon.stems |= stems
    starts = {term[: STEM_LENGTHS[0]] for term in stems}
    if starts:
        near = by_term.where(F.col("kind") == "word").where(F.substring("term", 1, STEM_LENGTHS[0]).isin(*starts))
        lexicon.exceptions += _exceptions(near.where(F.col("clean") >= 1).collect(), stems, toxic, clean)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            both = [measures(automaton, text) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "total": pa.array([a for a, _ in both], pa.float64()),
                    "density": pa.array([b for _, b in both], pa.float64()),
                    "label": batch.column(1),
                }
            )

    rows = sample.select("text", "label").mapInArrow(measure, "total double, density double, label int").collect()
    seen = np.array([(r.total, r.density, r.label) for r in rows], dtype=np.float64)
    lexicon.curve = _fit_curve(seen[:, :2], seen[:, 2])
    return lexicon


def toxicity(lexicon: Lexicon, text: Column) -> Column:
    """The probability that a text is toxic; a null text counts as empty."""
    curve = lexicon.curve

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [probability(curve, *measures(automaton, x or "")) for x in batch.to_pylist()]
            yield pa.array(found, pa.float64())

    return score(text)
