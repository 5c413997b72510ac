"""Hierarchical packing of documents into windows of several lengths.

Documents are cut into whole long windows as far as they reach.  What remains is routed
to the shortest tier that holds it.  Each shorter tier packs a share of its tokens into
windows of its own: the longest piece opens one, the best fitting pieces of this and the
shorter tiers follow, and the head of a cut piece fills it up.  Then pieces of the longest
tier open a long window each; their gaps are filled from the shorter tiers in the same
way, so no window has a gap while any piece waits.  The end of a partition is packed into
full windows of the shorter tiers and one padded rest.  Windows are dealt into step groups
that hold near equal numbers of windows of each tier, and near equal attention cost.

A task tokenises and packs what it reads, with a bounded pool of waiting pieces.  There
is no shuffle, no token leaves the task that made it, and the loss is one padded window a
task.  Cuts and numbers follow from the order of rows in a partition alone, so a task
that is repeated gives the same windows.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, ship_package
from .tokens import token_array

END_ID = 0
TIERS = (1024, 512, 256, 128)
POOL_PIECES, POOL_WINDOWS = 4096, 2048
OWN_SHARE = 0.5  # of a shorter tier's waiting tokens, for windows of that tier
STEP_WINDOWS = 64

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, window int, step long"
)
PIECE_TYPES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
    ("offset", pa.int64()), ("window", pa.int32()), ("step", pa.int64()),
])


@dataclass(slots=True)
class Piece:
    doc_id: int | None
    start: int
    total: int
    ids: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.total, self.ids[:length]),
            Piece(self.doc_id, self.start + length, self.total, self.ids[length:]),
        )


class Waiting:
    """Pieces that wait for a window, taken by best fit."""

    def __init__(self):
        self.lengths: list[int] = []
        self.pieces: list[Piece] = []

    def add(self, piece: Piece) -> None:
        at = bisect.bisect_right(self.lengths, len(piece))
        self.lengths.insert(at, len(piece))
        self.pieces.insert(at, piece)

    def take_fitting(self, gap: int) -> Piece | None:
        """The longest piece of at most ``gap`` ids."""
        return self._pop(bisect.bisect_right(self.lengths, gap) - 1)

    def take_longest(self) -> Piece | None:
        return self._pop(len(self.lengths) - 1)

    def _pop(self, at: int) -> Piece | None:
        if at < 0:
            return None
        self.lengths.pop(at)
        return self.pieces.pop(at)

    def __len__(self) -> int:
        return len(self.pieces)


@dataclass
class Packer:
    """The windows of one partition."""

    tiers: Sequence[int] = TIERS
    first_id: int = 0
    pool: int = POOL_PIECES
    step_windows: int = STEP_WINDOWS
    own_share: float = OWN_SHARE
    windows: list[tuple[int, list[Piece]]] = field(default_factory=list)
    sequence: int = 0
    step: int = 0

    def __post_init__(self):
        self.tiers = sorted(self.tiers, reverse=True)
        self.long = self.tiers[0]
        self.waiting = {tier: Waiting() for tier in self.tiers}

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        rest = Piece(doc_id, 0, len(ids), ids)
        while len(rest) >= self.long:
            head, rest = rest.cut(self.long)
            self.windows.append((self.long, [head]))
        if len(rest):
            self._route(rest)

    def _route(self, piece: Piece) -> None:
        self.waiting[min(t for t in self.tiers if t >= len(piece))].add(piece)

    def full(self) -> bool:
        return (
            sum(map(len, self.waiting.values())) >= self.pool or len(self.windows) >= POOL_WINDOWS
        )

    def _next(self, gap: int, longest: int | None = None) -> Piece | None:
        """A waiting piece for a gap: the best fit of any tier up to ``longest``, else the head of one."""
        tiers = [t for t in self.tiers if longest is None or t <= longest]
        for tier in tiers:
            if tier // 2 < gap or tier == self.tiers[-1]:
                if piece := self.waiting[tier].take_fitting(gap):
                    return piece
        for tier in reversed(tiers):
            if piece := self.waiting[tier].take_longest():
                head, rest = piece.cut(gap)
                self._route(rest)
                return head
        return None

    def pack(self, last: bool = False) -> Iterator[tuple]:
        """Rows of all windows that can be filled; with ``last`` of everything."""
        self._pack_tiers()
        while True:
            tokens = sum(sum(w.lengths) for w in self.waiting.values())
            if tokens < self.long:
                break
            window, gap = [], self.long
            for tier in self.tiers:  # a window opens with the longest piece there is
                if piece := self.waiting[tier].take_longest():
                    window, gap = [piece], gap - len(piece)
                    break
            while gap:
                window.append(piece := self._next(gap))
                gap -= len(piece)
            self.windows.append((self.long, window))
        if last:
            self._pack_rest()
        yield from self._dealt()

    def _pack_tiers(self) -> None:
        """Full windows of each shorter tier, the shortest first, opened by its own pieces."""
        for tier in reversed(self.tiers[1:]):
            own = self.waiting[tier]
            for _ in range(int(sum(own.lengths) * self.own_share) // tier):
                window, gap = [], tier
                if piece := own.take_longest():
                    window, gap = [piece], gap - len(piece)
                while gap and (piece := self._next(gap, tier)):
                    window.append(piece)
                    gap -= len(piece)
                if gap:  # the tier and those below it are used up
                    for piece in window:
                        self._route(piece)
                    break
                self.windows.append((tier, window))

    def _pack_rest(self) -> None:
        """Less than a long window is left: full windows of shorter tiers, then a padded one."""
        for tier in self.tiers[1:]:
            while sum(sum(w.lengths) for w in self.waiting.values()) >= tier:
                window, gap = [], tier
                while gap:
                    window.append(piece := self._next(gap))
                    gap -= len(piece)
                self.windows.append((tier, window))
        rest = [p for tier in self.tiers for p in self.waiting[tier].pieces]
        if rest:
            self.windows.append((self.long, rest))
        self.waiting = {tier: Waiting() for tier in self.tiers}

    def _dealt(self) -> Iterator[tuple]:
        """Number the windows and deal them to steps, tier by tier, the costly ones in turn there and back."""
        cost = [sum(len(p) ** 2 for p in pieces) for _, pieces in self.windows]
        steps = max(1, -(-len(cost) // self.step_windows))
        order = sorted(range(len(cost)), key=lambda k: (-self.windows[k][0], -cost[k], k))
        dealt = {}
        for turn, k in enumerate(order):
            lap, at = divmod(turn, steps)
            dealt[k] = self.step + (at if lap % 2 == 0 else steps - 1 - at)
        for k, (window, pieces) in enumerate(self.windows):
            offset = 0
            for piece in pieces:
                crc = zlib.crc32(piece.ids.astype("<u4").tobytes())
                yield (
                    piece.doc_id, piece.start, len(piece), crc, piece.total,
                    self.first_id + self.sequence, offset, window, self.first_id + dealt[k],
                )
                offset += len(piece)
            self.sequence += 1
        self.step += steps if cost else 0
        self.windows = []


def pack_documents(
    docs: DataFrame,
    tiers: Sequence[int] = TIERS,
    vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of a document, with the window (sequence) that holds it.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window, step``.
    A document's ids are those of its whole text and an end id, so an empty or null text
    is one id.  ``window`` is the length to pad to: a full window of its tier, or the
    longest tier for the last one of a partition.  Repeated rows are documents of their
    own; a null id stays null.  An empty table gives no rows; other columns are not read.
    Tiers must be powers of two, so a full shorter window needs no padding.
    """
    if any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")

    ship_package(docs.sparkSession)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(tiers, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = token_array(text.as_py() or "", vocabulary)
                packer.add(doc_id.as_py(), np.append(ids, np.uint32(END_ID)))
                if packer.full():
                    yield from _batches(packer.pack())
        yield from _batches(packer.pack(last=True))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, packed, PIECES)


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    columns = list(zip(*rows))
    if columns:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, PIECE_TYPES)], schema=PIECE_TYPES
        )
