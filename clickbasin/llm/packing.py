"""Vector bin packing of token runs into training sequences.

A sequence is limited in three ways at once: tokens, segments, and tokens that bear loss. Items are
placed by the dot-product heuristic: of the items that fit, the one whose needs, weighted by what
is left of each limit, are largest. Where no whole item fits, one is cut to fill the sequence.

Documents are packed where they are read: a task reads its documents once, tokenizes them, and
packs them window by window, so nothing is shuffled and memory is bounded by the window.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickbasin.llm.support import per_worker

END_OF_TEXT = 0
# Documents of so many tokens together are packed at a time.
WINDOW_TOKENS = 1_000_000
# A single word of so many characters is left to the slower tokenizer, whose time is not quadratic in it.
LONG_RUN = 500


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most. ``least_cut``: no item is cut into a part shorter than this."""

    tokens: int = 1024
    segments: int = 128
    loss: int = 1024
    least_cut: int = 1


@dataclass(frozen=True)
class Piece:
    """Tokens ``start`` to ``start + length`` of item ``item``, at ``offset`` of sequence ``sequence``."""

    item: int
    start: int
    length: int
    sequence: int
    offset: int


class _Shelf:
    """Waiting items in classes of equal (tokens, loss) needs: a search looks at classes, not items."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.waiting: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
        self.needs = np.empty((0, 2), dtype=np.int64)
        self.alive = np.empty(0, dtype=bool)
        self.place: dict[tuple[int, int], int] = {}

    def put(self, item: int, start: int, tokens: int, loss: int) -> None:
        key = (tokens, loss)
        if key not in self.place:
            if len(self.place) == len(self.needs):
                grown = max(64, 2 * len(self.needs))
                self.needs = np.resize(self.needs, (grown, 2))
                self.alive = np.concatenate([self.alive, np.zeros(grown - len(self.alive), dtype=bool)])
            self.place[key] = len(self.place)
            self.needs[self.place[key]] = key
        self.alive[self.place[key]] = True
        self.waiting.setdefault(key, []).append((item, start, tokens, loss))

    def take(self, tokens_left: int, segments_left: int, loss_left: int) -> tuple[int, int, int, int] | None:
        """The waiting item with the largest dot product of needs and what is left, each in parts of its limit."""
        if segments_left < 1 or not self.place:
            return None
        n = len(self.place)
        needs = self.needs[:n]
        fits = self.alive[:n] & (needs[:, 0] <= tokens_left) & (needs[:, 1] <= loss_left)
        if not fits.any():
            return None
        limits = self.limits
        worth = needs[:, 0] * (tokens_left / limits.tokens**2) + needs[:, 1] * (loss_left / limits.loss**2)
        return self._pop(int(np.where(fits, worth, -1.0).argmax()))

    def largest(self) -> tuple[int, int, int, int] | None:
        n = len(self.place)
        return self._pop(int(np.where(self.alive[:n], self.needs[:n, 0], -1).argmax())) if self.alive[:n].any() else None

    def _pop(self, at: int) -> tuple[int, int, int, int]:
        key = tuple(int(v) for v in self.needs[at])
        item = self.waiting[key].pop()
        if not self.waiting[key]:
            self.alive[at] = False
        return item


def pack(
    needs: list[tuple[int, int]], limits: Limits, cut: bool = True, first_sequence: int = 0
) -> tuple[list[Piece], int]:
    """Pieces of items with (tokens, loss tokens) needs, and the next free sequence number.

    With ``cut``, items longer than a sequence are split and a part of one fills what is left of a
    sequence; the loss tokens of a cut item are taken to be its last ones. Without, an item that
    exceeds a limit by itself gets a sequence of its own. Ties go to the latest item. Items without
    tokens get no piece.
    """
    pieces: list[Piece] = []
    sequence = first_sequence
    shelf = _Shelf(limits)
    for item, (tokens, loss) in enumerate(needs):
        if tokens <= 0:
            continue
        start, bare = 0, tokens - loss
        while cut and tokens - start > limits.tokens:
            length = limits.tokens
            # A cut off part takes no more loss tokens than a sequence may bear.
            length = min(length, max(bare - start, 0) + limits.loss)
            if length < limits.tokens:
                shelf.put(item, start, length, length - max(bare - start, 0))
            else:
                pieces.append(Piece(item, start, length, sequence, 0))
                sequence += 1
            start += length
        while cut and tokens - start - max(bare - start, 0) > limits.loss:
            length = max(bare - start, 0) + limits.loss
            shelf.put(item, start, length, limits.loss)
            start += length
        if not cut and (tokens > limits.tokens or loss > limits.loss):
            pieces.append(Piece(item, 0, tokens, sequence, 0))
            sequence += 1
        elif tokens > start:
            shelf.put(item, start, tokens - start, tokens - start - max(bare - start, 0))
    while (opening := shelf.largest()) is not None:
        left = [limits.tokens, limits.segments, limits.loss]
        offset, chosen = 0, opening
        while chosen is not None:
            item, start, tokens, loss = chosen
            pieces.append(Piece(item, start, tokens, sequence, offset))
            offset += tokens
            left = [left[0] - tokens, left[1] - 1, left[2] - loss]
            chosen = shelf.take(*left)
            if chosen is None and cut and left[0] >= limits.least_cut and left[1] > 0 and left[2] > 0:
                chosen = _cut(shelf, left[0], left[2], limits.least_cut)
        sequence += 1
    return pieces, sequence


def _cut(shelf: _Shelf, tokens_left: int, loss_left: int, least: int) -> tuple[int, int, int, int] | None:
    """The front part of the largest waiting item that fits; the rest goes back."""
    item = shelf.largest()
    if item is None:
        return None
    number, start, tokens, loss = item
    bare = tokens - loss
    length = min(tokens_left, bare + loss_left)
    if length < least or tokens - length < least:
        shelf.put(*item)
        return None
    own_loss = max(0, length - bare)
    shelf.put(number, start + length, tokens - length, loss - own_loss)
    return number, start, length, own_loss


def in_powers_of_two(pieces: list[Piece], limits: Limits, next_sequence: int) -> tuple[list[Piece], int]:
    """Sequences that are not full are split into ones whose lengths are powers of two, which need no padding."""
    filled: dict[int, int] = {}
    for piece in pieces:
        filled[piece.sequence] = max(filled.get(piece.sequence, 0), piece.offset + piece.length)
    out, parts = [], {}
    for sequence, total in filled.items():
        if total < limits.tokens and total & (total - 1):
            edge, own = 0, []
            for power in range(total.bit_length() - 1, -1, -1):
                if total >> power & 1:
                    own.append((edge, edge + (1 << power), sequence if not own else next_sequence))
                    next_sequence += len(own) > 1
                    edge += 1 << power
            parts[sequence] = own
    for piece in pieces:
        for low, high, sequence in parts.get(piece.sequence, [(0, limits.tokens, piece.sequence)]):
            start, end = max(piece.offset, low), min(piece.offset + piece.length, high)
            if start < end:
                out.append(Piece(piece.item, piece.start + start - piece.offset, end - start, sequence, start - low))
    return out, next_sequence


class ByteTokenizer:
    """The ids of a byte-level BPE file, by two libraries that give the same ones.

    The file's vocabulary is handed to the faster library as ranks. Texts with very long unbroken
    runs go to the other one.
    """

    # Fixed value: the rule by which byte-level BPE cuts a text into words.
    WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        special = {token["content"]: token["id"] for token in described["added_tokens"]}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in printable}
        rest = (b for b in range(256) if b not in set(printable))
        byte_of |= {chr(256 + n): b for n, b in enumerate(rest)}
        ranks = {
            bytes(byte_of[c] for c in token): rank
            for token, rank in described["model"]["vocab"].items()
            if token not in special
        }
        self.fast = tiktoken.Encoding("bpe", pat_str=self.WORDS, mergeable_ranks=ranks, special_tokens=special)
        self.special = list(special)
        self.long_space = re.compile(rf"\s{{{LONG_RUN}}}")

    def ids(self, text: str) -> np.ndarray:
        longest = max(map(len, text.split()), default=0)
        if longest > LONG_RUN or self.long_space.search(text) or any(token in text for token in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.fast.encode_to_numpy(text, disallowed_special=())


# Columns of a packed piece, beside the id.
PIECE_COLUMNS = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"
)


def packed_documents(
    docs: DataFrame,
    tokenizer_path: str,
    limits: Limits = Limits(),
    id_column: str = "doc_id",
    text: str = "text",
    loss: str | None = None,
) -> DataFrame:
    """One row per piece: the id, ``PIECE_COLUMNS``.

    A document is its ids and then one end-of-text id, so a null or empty text is one id. All
    tokens bear loss, unless ``loss`` names a column that tells how many of a document's last ids do,
    the end-of-text id included (null: all); rows then have ``loss_tokens`` last, the same for the piece. Repeated rows are packed as often as they occur, null ids are kept, other
    columns are not looked at. An empty table gives no rows. Sequences are numbered by task, so
    the numbers are unique but not without gaps.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = per_worker(("tokenizer", tokenizer_path), lambda: ByteTokenizer(tokenizer_path))
        yield from _pack_rows(batches, tokenizer.ids, limits, TaskContext.get().partitionId() << 32)

    further = [] if loss is None else [F.col(f"`{loss}`").cast("long")]
    chosen = docs.select(f"`{id_column}`", f"`{text}`", *further)
    id_type = chosen.schema[0].dataType.simpleString()
    columns = PIECE_COLUMNS + ", loss_tokens long" * len(further)
    return chosen.mapInArrow(work, f"`{id_column}` {id_type}, {columns}")


def _pack_rows(
    batches: Iterator[pa.RecordBatch], ids_of: Callable[[str], np.ndarray], limits: Limits, sequence: int
) -> Iterator[pa.RecordBatch]:
    keys: list[pa.Scalar] = []
    held: list[np.ndarray] = []
    bearing: list[int] | None = None
    name, waiting, id_type = "", 0, None
    for batch in batches:
        name, id_type = batch.schema.names[0], batch.schema.types[0]
        told = batch.column(2).to_pylist() if batch.num_columns > 2 else None
        if told is not None and bearing is None:
            bearing = []
        for row, (key, text) in enumerate(zip(batch.column(0), batch.column(1))):
            keys.append(key)
            held.append(np.append(ids_of(text.as_py() or ""), np.array([END_OF_TEXT], dtype="<u4")))
            if told is not None:
                size = len(held[-1])
                bearing.append(size if told[row] is None else min(max(told[row], 0), size))
            waiting += len(held[-1])
            if waiting >= WINDOW_TOKENS:
                out, sequence = _window(keys, held, bearing, limits, sequence, name, id_type)
                yield from out
                keys, held, waiting = [], [], 0
                bearing = None if bearing is None else []
    if keys:
        out, sequence = _window(keys, held, bearing, limits, sequence, name, id_type)
        yield from out


def _window(keys, held, bearing, limits, sequence, name, id_type) -> tuple[Iterator[pa.RecordBatch], int]:
    sizes = [len(ids) for ids in held]
    pieces, sequence = pack(list(zip(sizes, sizes if bearing is None else bearing)), limits, first_sequence=sequence)
    pieces, sequence = in_powers_of_two(pieces, limits, sequence)

    def borne(p: Piece) -> int:
        bare = sizes[p.item] - bearing[p.item]
        return max(0, p.start + p.length - max(p.start, bare))

    def rows() -> Iterator[pa.RecordBatch]:
        for at in range(0, len(pieces), 4096):
            part = pieces[at : at + 4096]
            spans = [held[p.item][p.start : p.start + p.length] for p in part]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[p.item].as_py() for p in part], id_type),
                    pa.array([p.start for p in part], pa.int64()),
                    pa.array([p.length for p in part], pa.int64()),
                    pa.array([zlib.crc32(ids.tobytes()) for ids in spans], pa.int64()),
                    pa.array([len(held[p.item]) for p in part], pa.int64()),
                    pa.array([p.sequence for p in part], pa.int64()),
                    pa.array([p.offset for p in part], pa.int64()),
                    pa.ListArray.from_arrays(
                        np.concatenate([[0], np.cumsum([len(ids) for ids in spans])]).astype(np.int32),
                        np.concatenate(spans).astype(np.int32),
                    ),
                    *([] if bearing is None else [pa.array([borne(p) for p in part], pa.int64())]),
                ],
                names=[name, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
                + ["loss_tokens"] * (bearing is not None),
            )

    return rows(), sequence
