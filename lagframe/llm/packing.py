"""Sum-of-squares online packing of documents into fixed-length sequences.

A task takes its documents as they come. A document longer than a sequence
gives whole sequences first; what remains is one item for the packer. The
packer keeps, for every fill level, how many windows stand open at it, and
puts the item where the sum of the squared counts grows least. Open windows
are few by construction; beyond ``max_open`` of them, and at the end of the
task, they are emptied into each other by cutting pieces, so a task leaves
one partly filled sequence at most.

No shuffle takes place, each task holds one batch of texts and its open
windows, and a lost task is simply run again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lagframe.llm.common import map_columns, pick
from lagframe.llm.tokens import encoder

SEQUENCE_TOKENS = 2048
MAX_OPEN_WINDOWS = 4096
# Sequence numbers of one task; the task's partition stands above them.
SEQUENCE_BITS = 40
PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long")


class LevelArray:
    """Open windows by fill level, with the cost of leaving or entering one.

    With N(h) windows at level h, moving one from h to h + s changes the
    sum of squares by ``leave[h] + enter[h + s]``. Empty windows (level 0)
    and full ones (level ``capacity``) don't count.
    """

    NEVER = np.int64(1) << 60

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.windows: list[list] = [[] for _ in range(capacity + 1)]
        self.leave = np.full(capacity + 1, self.NEVER)
        self.leave[0] = 0
        self.enter = np.ones(capacity + 1, dtype=np.int64)
        self.enter[capacity] = 0
        self.open = 0

    def _count(self, level: int) -> None:
        n = len(self.windows[level])
        self.leave[level] = 1 - 2 * n if n else self.NEVER
        self.enter[level] = 1 + 2 * n

    def best(self, size: int) -> int:
        """The level whose window should take an item; the fullest of equals."""
        top = self.capacity - size
        grown = self.leave[:top + 1] + self.enter[size:]
        return top - int(np.argmin(grown[::-1]))

    def take(self, level: int) -> list:
        if not level:
            return []
        window = self.windows[level].pop()
        self.open -= 1
        self._count(level)
        return window

    def put(self, level: int, window: list) -> None:
        self.windows[level].append(window)
        self.open += 1
        self._count(level)

    def drain(self) -> list[tuple[int, list]]:
        """All open windows, the fullest first."""
        out = [(h, w) for h in range(self.capacity - 1, 0, -1) for w in self.windows[h]]
        self.__init__(self.capacity)
        return out


def fill_up(windows: list[tuple[int, list]], capacity: int) -> tuple[list[list], tuple[int, list] | None]:
    """Empty the least filled windows into the gaps of the fullest.

    A piece is (document, start, ids). Returns the windows filled to the
    brim and the one left over, if any.
    """
    full, rest = [], sorted(windows, key=lambda x: -x[0])
    while len(rest) > 1:
        level, window = rest.pop(0) if rest[0][0] == capacity else rest[0]
        if level == capacity:
            full.append(window)
            continue
        low, source = rest[-1]
        doc, start, ids = source.pop()
        n = min(len(ids), capacity - level)
        if n < len(ids):
            source.append((doc, start, ids[:len(ids) - n]))
        window.append((doc, start + len(ids) - n, ids[len(ids) - n:]))
        rest[0] = (level + n, window)
        if low == n:
            rest.pop()
        else:
            rest[-1] = (low - n, source)
    if rest and rest[0][0] == capacity:
        full.append(rest.pop()[1])
    return full, rest[0] if rest else None


class Packer:
    """The windows of one task; rows of closed windows gather in ``rows``."""

    def __init__(self, capacity: int, max_open: int, first_sequence: int):
        self.capacity, self.max_open, self.next_sequence = capacity, max_open, first_sequence
        self.levels = LevelArray(capacity)
        self.rows: list[tuple] = []

    def _close(self, window: list) -> None:
        offset = 0
        for (doc_id, doc_tokens), start, ids in window:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), doc_tokens,
                              self.next_sequence, offset))
            offset += len(ids)
        self.next_sequence += 1

    def add(self, doc_id, ids: np.ndarray) -> None:
        doc, whole = (doc_id, len(ids)), len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            self._close([(doc, start, ids[start:start + self.capacity])])
        size = len(ids) - whole
        if not size:
            return
        level = self.levels.best(size)
        window = self.levels.take(level)
        window.append((doc, whole, ids[whole:].copy()))
        if level + size == self.capacity:
            self._close(window)
            return
        self.levels.put(level + size, window)
        if self.levels.open > self.max_open:
            self.flush(last=False)

    def flush(self, last: bool = True) -> None:
        full, left = fill_up(self.levels.drain(), self.capacity)
        for window in full:
            self._close(window)
        if left and last:
            self._close(left[1])
        elif left:
            self.levels.put(*left)

    def taken(self) -> dict[str, list]:
        rows, self.rows = self.rows, []
        names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
        return {n: [r[i] for r in rows] for i, n in enumerate(names)}


def pack_documents(docs: DataFrame, tokenizer: str, sequence_tokens: int = SEQUENCE_TOKENS,
                   end_id: int = 1, max_open: int = MAX_OPEN_WINDOWS, lean: bool = False) -> DataFrame:
    """Pieces of all documents, each with its place in a sequence.

    ``docs`` has doc_id and text; other columns are ignored. ``tokenizer``
    is the path of a tokenizer file that every executor has. Null and empty
    texts are documents of ``end_id`` alone; a null doc_id stays null and
    repeated rows are packed each on its own. An empty table gives none.
    Texts of any length are encoded whole; ``lean`` takes less memory and more time for
    the same ids. One row per piece: doc_id, start
    (ids of the document before it), length, ids_crc32, doc_tokens,
    sequence_id, offset (gapless within the sequence).
    """
    def pack(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        packer = Packer(sequence_tokens, max_open, TaskContext.get().partitionId() << SEQUENCE_BITS)
        with encoder(tokenizer, lean) as code:
            for batch in batches:
                for doc_id, ids in zip(batch["doc_id"], code.encode(batch["text"], end_id), strict=True):
                    packer.add(doc_id, ids)
                yield packer.taken()
        packer.flush()
        yield packer.taken()

    return map_columns(pick(docs, "doc_id", "text"), pack, PIECE_SCHEMA)
