"""Pack tokenised documents into fixed windows by non-negative least squares.

Documents are tokenised and cut at the window; what is left of each is a piece
shorter than the window.  Shallow combinations of piece lengths that fill a
window are enumerated; non-negative least squares finds how often to repeat
each so that the histogram of lengths is used up; the repeats are rounded and
applied, and the residual pieces are packed greedily.

Every task packs what it reads, in chunks of bounded size, so nothing is
shuffled and a lost task is simply run again; of the pieces that a chunk's plan
leaves over, half a chunk at most joins the next one, and the rest is packed
greedily at once.  A task's last window, if not full, is split into sequences
whose lengths are powers of two, which need no padding.

Defined results: a null or empty text is one piece with the end token only; a
text of any length is tokenised whole; repeated rows are packed each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 2048
# lengths are planned in units; a window is WINDOW / UNIT units
UNIT = 16
DEPTH = 3
END_ID = 1
# tokens of cut-off pieces that a task holds at once; a piece counts as a unit at least
CHUNK_TOKENS = 1 << 21

# characters on which the two tokenizer libraries cannot disagree about classes of characters
_COMMON = re.compile(r"[\x00-\x1b\x20-\x7f\xa0-ɏ‐-‧€]*")
_END_OF_TEXT = "<|endoftext|>"


@cache
def _encoders(tokenizer_path: str, ranks_path: str, pattern: str):
    import tiktoken
    from tokenizers import Tokenizer

    ranks = {}
    if ranks_path:
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) if ranks else None
    return Tokenizer.from_file(tokenizer_path), fast


def encoder(tokenizer_path: str, ranks_path: str = "", pattern: str = "") -> Callable[[str], list[int]]:
    """A function from a text to the ids of the tokenizer in ``tokenizer_path``.

    ``ranks_path`` may name the same vocabulary as ranks with its ``pattern``;
    texts of common Latin characters then go to a faster library, which gives
    the same ids.
    """

    def encode(text: str) -> list[int]:
        exact, fast = _encoders(tokenizer_path, ranks_path, pattern)
        if fast is not None and _END_OF_TEXT not in text and _COMMON.fullmatch(text):
            return fast.encode_ordinary(text)
        return exact.encode(text, add_special_tokens=False).ids

    return encode


@cache
def patterns(units: int, depth: int) -> tuple[tuple[int, ...], ...]:
    """All combinations of up to ``depth`` lengths, in units, that fill a window exactly."""
    found = [(units,)]
    for parts in range(1, depth):
        for rest in combinations_with_replacement(range(1, units), parts):
            last = units - sum(rest)
            if last >= rest[-1]:
                found.append((*rest, last))
    return tuple(found)


@cache
def _incidence(units: int, depth: int) -> np.ndarray:
    """How often each length (row) occurs in each pattern (column)."""
    plan = patterns(units, depth)
    matrix = np.zeros((units, len(plan)))
    for column, parts in enumerate(plan):
        for part in parts:
            matrix[part - 1, column] += 1
    return matrix


def nnls(matrix: np.ndarray, target: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative x that minimises ``|matrix @ x - target|``, by active sets (Lawson and Hanson)."""
    gram, projected = matrix.T @ matrix, matrix.T @ target
    x = np.zeros(matrix.shape[1])
    passive = np.zeros(len(x), bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(projected).max(initial=0)))
    for _ in range(rounds):
        gradient = projected - gram @ x
        gradient[passive] = -np.inf
        best = int(gradient.argmax())
        if gradient[best] <= tolerance:
            break
        passive[best] = True
        while True:
            index = np.flatnonzero(passive)
            inner = gram[np.ix_(index, index)]
            solved = np.linalg.solve(inner + 1e-9 * np.eye(len(index)), projected[index])
            if solved.min() > 0:
                x[:] = 0
                x[index] = solved
                break
            negative = solved <= 0
            steps = x[index][negative] / np.maximum(x[index][negative] - solved[negative], 1e-300)
            x[index] += steps.min() * (solved - x[index])
            x[x < 1e-12] = 0
            passive &= x > 0
            if not passive.any():
                break
    return x


def planned_repeats(histogram: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """How often to use each pattern: the rounded solution, never more than the pieces allow."""
    units = len(histogram)
    matrix = _incidence(units, depth)
    wish = np.rint(nnls(matrix, histogram.astype(float))).astype(np.int64)
    left, repeats = histogram.astype(np.int64).copy(), np.zeros(len(wish), np.int64)
    for column in np.argsort(-wish, kind="stable"):
        if wish[column] == 0:
            break
        used = np.flatnonzero(matrix[:, column])
        need = matrix[used, column].astype(np.int64)
        repeats[column] = max(0, min(int(wish[column]), int((left[used] // need).min())))
        left[used] -= repeats[column] * need
    return repeats


class _Packer:
    """The state of one task: open pieces, the next sequence number, rows for output."""

    def __init__(self, window: int, unit: int, depth: int, first_sequence: int):
        self.window, self.unit, self.depth = window, unit, depth
        self.sequence = first_sequence
        self.pieces: list[tuple[int, int, np.ndarray]] = []
        self.held = 0
        self.docs: list[tuple[object, int]] = []
        self.rows: list[tuple] = []

    def add(self, doc_id: object, ids: np.ndarray) -> None:
        total, doc = len(ids), len(self.docs)
        self.docs.append((doc_id, total))
        cut = total - total % self.window
        for start in range(0, cut, self.window):
            self._emit(doc, start, ids[start : start + self.window], 0)
            self.sequence += 1
        if cut < total:
            self.pieces.append((doc, cut, ids[cut:].copy()))
            self.held += self._weight(ids[cut:])

    def _weight(self, ids: np.ndarray) -> int:
        return max(len(ids), self.unit)

    def _emit(self, doc: int, start: int, ids: np.ndarray, offset: int) -> None:
        doc_id, total = self.docs[doc]
        checksum = zlib.crc32(ids.astype("<u4").tobytes())
        self.rows.append((doc_id, start, len(ids), checksum, total, self.sequence, offset))

    def _sequence_of(self, pieces: list[tuple[int, int, np.ndarray]]) -> None:
        offset = 0
        for doc, start, ids in pieces:
            self._emit(doc, start, ids, offset)
            offset += len(ids)
        self.sequence += 1

    def plan(self) -> None:
        """Apply the plan to the open pieces; what it leaves over stays open."""
        units = self.window // self.unit
        by_length: list[list] = [[] for _ in range(units)]
        for piece in self.pieces:
            by_length[-(-len(piece[2]) // self.unit) - 1].append(piece)
        for pool in by_length:
            pool.sort(key=lambda piece: len(piece[2]))
        repeats = planned_repeats(np.array([len(pool) for pool in by_length]), self.depth)
        for parts, times in zip(patterns(units, self.depth), repeats, strict=True):
            for _ in range(times):
                self._sequence_of([by_length[part - 1].pop() for part in parts])
        self._keep([piece for pool in by_length for piece in pool])

    def _keep(self, pieces: list) -> None:
        docs = [self.docs[piece[0]] for piece in pieces]
        self.pieces = [(i, start, ids) for i, (_, start, ids) in enumerate(pieces)]
        self.docs, self.held = docs, sum(self._weight(piece[2]) for piece in pieces)

    def fill(self, most: int) -> None:
        """Pack pieces, longest first, cut where a sequence is full, until ``most`` tokens at most are held.

        Sequences are whole windows; only the last of all splits at powers of two.
        """
        rest = sorted(self.pieces, key=lambda piece: -len(piece[2]))[::-1]
        left = sum(len(piece[2]) for piece in rest)
        while rest and self.held > most:
            room = self._room(left)
            left -= room
            taken: list = []
            while room:
                doc, start, ids = rest.pop()
                part, after = ids[:room], ids[room:]
                taken.append((doc, start, part))
                room -= len(part)
                self.held -= self._weight(ids)
                if len(after):
                    rest.append((doc, start + len(part), after))
                    self.held += self._weight(after)
            self._sequence_of(taken)
        self._keep(rest[::-1])

    def _room(self, left: int) -> int:
        return self.window if left >= self.window else 1 << max(0, left.bit_length() - 1)

    def drained(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(
    docs: DataFrame,
    encode: Callable[[str], list[int]],
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    unit: int = UNIT,
    depth: int = DEPTH,
    chunk_tokens: int = CHUNK_TOKENS,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``window`` must be a power of two.  A sequence's number holds the task's
    number in its upper bits, so numbers are unique but not consecutive.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = f"doc_id {id_type}, " + ", ".join(f"{n} long" for n in names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        packer = _Packer(window, unit, depth, (context.partitionId() if context else 0) << 40)
        kind = None

        def rows() -> pa.RecordBatch:
            columns = list(zip(*packer.drained(), strict=True)) or [[]] * 7
            arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:])]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", *names])

        for batch in batches:
            kind = batch.schema.field(0).type
            for one_id, one_text in zip(batch.column(0), batch.column(1), strict=True):
                packer.add(one_id.as_py(), np.array([*encode(one_text.as_py() or ""), end_id], np.uint32))
                if packer.held >= chunk_tokens:
                    packer.plan()
                    # with less than a window left, the last one would be split before the task's end
                    packer.fill(max(chunk_tokens // 2, window * unit))
                    yield rows()
                elif len(packer.rows) >= 50_000:
                    yield rows()
        if kind is not None:
            if packer.pieces:
                packer.plan()
            packer.fill(0)
            yield rows()

    return docs.select(doc_id, text).mapInArrow(task, schema)
