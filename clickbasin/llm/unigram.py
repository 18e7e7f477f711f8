"""Encoding and decoding by pieces with scores: the best path over a double-array trie.

The scores are the model's. Those of a BPE model, as the given one, are negative merge ranks and not log
probabilities: the path is then no likeliest one, and its ids need not be SentencePiece's. Texts come back exactly.

A text is a lattice whose edges are the pieces of a vocabulary that occur in it; the path with the
largest sum of scores is its encoding (Viterbi). Pieces are found by walking a trie, kept in two
arrays, over the text's bytes. A character that no piece covers alone may be taken at a penalty and
is written as its bytes. Spaces are whitespace markers, and one stands before the text.

No piece has a marker behind another character, so paths never cross from a word into the markers of
the next, and each different word is encoded once per task and a cache holds it. Short words are
worked on together, a step of the lattice of all of them at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column
from pyspark.sql import functions as F

from clickbasin.llm.support import per_worker

MARKER = "▁"
# Words of more characters are encoded one by one; so many encoded words are kept; so many texts go together.
SHORT, CACHED, TOGETHER = 24, 250_000, 250
# Fixed value: how much less than the worst piece an uncovered character scores.
PENALTY = 10.0
# Stands for a marker character that the text itself has; no text has it, and it is encoded as bytes.
_OWN = "\udc81"


@dataclass(frozen=True)
class Pieces:
    """The vocabulary: ``texts`` and ``scores`` of normal pieces by id, and the ids of the 256 byte pieces."""

    texts: dict[int, str]
    scores: dict[int, float]
    bytes_: list[int]

    @staticmethod
    def read(path: str) -> Pieces:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts, scores, by_byte = {}, {}, {}
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                by_byte[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                texts[i], scores[i] = model.id_to_piece(i), model.get_score(i)
        if len(by_byte) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        return Pieces(texts, scores, [by_byte[b] for b in range(256)])


class DoubleArray:
    """A trie in two arrays: the child of node ``s`` by byte ``c`` is ``t = base[s] + c + 1`` if ``check[t] == s``."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for key, value in keys.items():
            node = 0
            for c in key:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    values.append(-1)
                node = children[node][c]
            values[node] = value
        size = 2 * len(children) + 512
        base, check, value = (np.full(size, fill, dtype=np.int64) for fill in (0, -1, -1))
        check[0] = 0
        free = np.ones(size, dtype=bool)
        free[0] = False
        place = [0] * len(children)
        low = 257  # so that any child's place can be the lowest free one
        for node in sorted(range(len(children)), key=lambda n: -len(children[n])):
            if not children[node]:
                continue
            codes = np.array(sorted(children[node]), dtype=np.int64) + 1
            while not free[low]:
                low += 1
            start = low - int(codes[0])
            while len(codes) > 1:
                if start + 300 >= len(free):
                    grow = len(free)
                    base, check, value = (np.concatenate([a, np.full(grow, f, dtype=np.int64)]) for a, f in ((base, 0), (check, -1), (value, -1)))
                    free = np.concatenate([free, np.ones(grow, dtype=bool)])
                window = free[start : start + 257 + 1024]
                # All places of a stretch at once: free for every child.
                tries = np.arange(min(1024, len(window) - 257))
                fits = free[start + tries[:, None] + codes].all(axis=1)
                if fits.any():
                    start += int(fits.argmax())
                    break
                start += max(1, len(tries))
            if start + 300 >= len(free):
                raise ValueError("no room")
            free[start + codes] = False
            base[node] = -1 - start  # remembered by number of node until places are known
            for c, child in children[node].items():
                place[child] = start + c + 1
        final_base = np.zeros(len(check), dtype=np.int64)
        for node, own in enumerate(children):
            value[place[node]] = values[node]
            if own:
                start = -1 - int(base[node])
                final_base[place[node]] = start
                for c in own:
                    check[start + c + 1] = place[node]
        self.base, self.check, self.value = final_base, check, value


class Encoder:
    """Encodes words; what it needs of the vocabulary is small and of fixed size, so it is sent to every task."""

    def __init__(self, pieces: Pieces):
        self.trie = DoubleArray({text.encode(): i for i, text in pieces.texts.items()})
        self.name = xxhash.xxh3_128_hexdigest(repr(pieces))
        top = max([*pieces.texts, *pieces.bytes_]) + 1
        self.score = np.full(top, -np.inf)
        self.score[list(pieces.scores)] = list(pieces.scores.values())
        self.unknown = min(pieces.scores.values(), default=0.0) - PENALTY
        self.longest = max((len(t.encode()) for t in pieces.texts.values()), default=1)
        self.byte_ids = np.array(pieces.bytes_, dtype=np.int64)
        # What each id stands for, one behind the other; the last place is for what is no piece.
        plain = {i: text.replace(MARKER, " ").encode() for i, text in pieces.texts.items()}
        plain |= {i: bytes([b]) for b, i in enumerate(pieces.bytes_)}
        self.lengths = np.array([len(plain.get(i, b"")) for i in range(top + 1)])
        self.places = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(plain.get(i, b"") for i in range(top + 1)), dtype=np.uint8)
        if any(MARKER in text.lstrip(MARKER) for text in pieces.texts.values()):
            raise ValueError("a piece has a marker behind another character")
        # Where no piece may reach across: before markers, and around characters of no piece.
        known = {c for text in pieces.texts.values() for c in text}
        alone = _OWN + "".join(c for c in "\n\t\r" if c not in known)
        self.word = re.compile(rf"{MARKER}*[^{MARKER}{alone}]+|{MARKER}+" + f"|[{alone}]")

    def words(self, text: str) -> list[str]:
        """The words of a text, with markers for spaces. A marker that the text itself has becomes ``_OWN``."""
        if not text:
            return []
        return self.word.findall(MARKER + text.replace(MARKER, _OWN).replace(" ", MARKER))

    def encode_long(self, word: str) -> list[int]:
        """The best path of one word, by a loop over its bytes."""
        data = word.encode("utf-8", "replace")
        n = len(data)
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.score
        best = [-np.inf] * (n + 1)
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        best[0] = 0.0
        for s in range(n):
            if best[s] == -np.inf:
                continue
            lead = data[s]
            size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            node, covered = 0, False
            for k in range(s, min(n, s + self.longest)):
                child = int(base[node]) + data[k] + 1
                if check[child] != node:
                    break
                node = child
                piece = int(value[node])
                if piece >= 0:
                    covered |= k + 1 - s == size
                    total = best[s] + scores[piece]
                    if total > best[k + 1]:
                        best[k + 1], back[k + 1] = total, (s, piece)
            if not covered and best[s] + self.unknown > best[s + size]:
                best[s + size], back[s + size] = best[s] + self.unknown, (s, -1)
        out: list[int] = []
        at = n
        while at > 0:
            start, piece = back[at]
            out += [piece] if piece >= 0 else self.byte_ids[np.frombuffer(data[start:at], np.uint8)][::-1].tolist()
            at = start
        return out[::-1]

    def encode_short(self, words: list[str]) -> list[bytes]:
        """The best paths of many short words as 32-bit ids, all words one step of the lattice at a time."""
        data = [word.encode("utf-8", "replace") for word in words]
        sizes = np.array([len(d) for d in data])
        width, count = int(sizes.max()), len(data)
        # One row per place in the words, one column per word.
        grid = np.zeros((width, count), dtype=np.int32)
        flat = np.frombuffer(b"".join(data), dtype=np.uint8)
        owner = np.repeat(np.arange(count), sizes)
        grid[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), owner] = flat
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        best = np.full((width + 5, count), -np.inf)
        back = np.full((width + 5, count), -1, dtype=np.int32)
        came = np.zeros((width + 5, count), dtype=np.int32)
        best[0] = 0
        for s in range(width):
            here = best[s]
            rows = np.flatnonzero((here > -np.inf) & (sizes > s))
            if not len(rows):
                continue
            lead = grid[s][rows]
            end = s + 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
            bare = np.ones(count, dtype=bool)
            char_end = np.zeros(count, dtype=np.int64)
            char_end[rows] = end
            live, node = rows, np.zeros(len(rows), dtype=np.int64)
            for k in range(s, min(width, s + self.longest)):
                # Past a word's end its column is zero, a byte that no piece has.
                child = base[node] + grid[k][live] + 1
                ok = check[child] == node
                live, node = live[ok], child[ok]
                if not len(live):
                    break
                piece = value[node]
                ends = piece >= 0
                at, piece = live[ends], piece[ends]
                bare[at[char_end[at] == k + 1]] = False
                total = here[at] + self.score[piece]
                better = total > best[k + 1][at]
                which = at[better]
                best[k + 1][which], back[k + 1][which], came[k + 1][which] = total[better], piece[better], s
            rows, end = rows[bare[rows]], end[bare[rows]]
            total = here[rows] + self.unknown
            better = total > best[end, rows]
            rows, end = rows[better], end[better]
            best[end, rows], back[end, rows], came[end, rows] = total[better], -1, s
        # All paths backwards at once; those over uncovered characters are written out one by one.
        every, at = np.arange(count), sizes.copy()
        steps, marks = [], []
        odd = np.zeros(count, dtype=bool)
        while (going := at > 0).any():
            piece = back[at, every]
            odd |= going & (piece < 0)
            steps.append(piece)
            marks.append(going)
            at = np.where(going, came[at, every], 0)
        path, used = np.array(steps[::-1]).T, np.array(marks[::-1]).T
        lengths = used.sum(axis=1)
        joined = path[used].astype("<i4").tobytes()
        stops = (4 * np.cumsum(lengths)).tolist()
        out = [joined[stop - 4 * n : stop] for stop, n in zip(stops, lengths.tolist())]
        for i in np.flatnonzero(odd):
            out[i] = np.array(self.encode_long(words[i]), dtype="<i4").tobytes()
        return out

    def fill(self, cache: dict[str, bytes], words: set[str]) -> None:
        """Encodes what the cache does not hold yet."""
        if _OWN in words:
            words.remove(_OWN)
            cache[_OWN] = self.byte_ids[np.frombuffer(MARKER.encode(), np.uint8)].astype("<i4").tobytes()
        short = sorted((w for w in words if len(w) <= SHORT), key=len)
        for at in range(0, len(short), 4096):
            part = short[at : at + 4096]
            cache.update(zip(part, self.encode_short(part)))
        for word in words:
            if len(word) > SHORT:
                cache[word] = np.array(self.encode_long(word), dtype="<i4").tobytes()

    def encode(self, texts: list[str], cache: dict[str, bytes]) -> list[np.ndarray]:
        """The ids of each text; an empty text has none."""
        split = [self.words(text) for text in texts]
        if len(cache) > CACHED:
            cache.clear()
        self.fill(cache, set().union(*split).difference(cache))
        return [np.frombuffer(b"".join(map(cache.__getitem__, words)), dtype="<i4") for words in split]

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text that ids stand for: markers become spaces, byte pieces bytes, and the first space goes.

        Ids that are no pieces stand for nothing, bytes that are no text for the replacement character.
        """
        return self.decode_all(np.asarray(ids, dtype=np.int64), np.array([0, len(ids)]))[0]

    def decode_all(self, ids: np.ndarray, edges: np.ndarray) -> list[str]:
        """The texts of several lists of ids, which lie one behind the other between ``edges``."""
        ids = np.where((ids < 0) | (ids >= len(self.lengths) - 1), len(self.lengths) - 1, ids)
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        data = self.letters[np.repeat(self.places[ids] - ends + sizes, sizes) + np.arange(total)].tobytes()
        cuts = np.concatenate([[0], ends])[edges].tolist()
        return [data[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in zip(cuts, cuts[1:])]


def encoder(path: str) -> Encoder:
    return Encoder(Pieces.read(path))


def pieces(shared: Broadcast, text: Column) -> Column:
    """The piece ids of each text; none for a null or empty one. ``shared`` holds an ``Encoder``."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own, cache = shared.value, per_worker(("words", shared.value.name), dict)
        for batch in batches:
            found = []
            for at in range(0, len(batch), TOGETHER):
                found += own.encode([t or "" for t in batch[at : at + TOGETHER].to_pylist()], cache)
            edges = np.concatenate([[0], np.cumsum([len(ids) for ids in found])]).astype(np.int32)
            flat = np.concatenate(found) if found else np.empty(0, np.int32)
            yield pa.ListArray.from_arrays(edges, pa.array(flat, pa.int32()))

    return encode(text)


def decoded(shared: Broadcast, ids: Column) -> Column:
    """The text of each list of ids; empty for null and for unknown ids."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for batch in batches:
            batch = batch.fill_null([])
            edges = batch.offsets.to_numpy()
            flat = batch.values.fill_null(-1).to_numpy()
            found = []
            for at in range(0, len(batch), 50):
                part = edges[at : at + 51]
                found += own.decode_all(flat[part[0] : part[-1]], part - part[0])
            yield pa.array(found, pa.string())

    return decode(ids)
