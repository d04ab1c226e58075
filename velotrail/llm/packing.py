"""Hierarchical packing of token ids into sequences of several context sizes.

A document is cut into whole windows of the largest size; its tail is routed to the smallest tier that holds it.  Tiers
are packed from long to short: the longest tail opens a window, the gap takes the longest shorter tails that fit, and
what is still open is cut from the next tail.  So every window is full but the last of a task, which is cut at powers of
two.  Windows of a tier are dealt to step groups in turns by their attention cost.

Each task packs the rows that it reads, GROUP_TOKENS ids at a time, and carries what it could not place to the next
group: there is no shuffle, memory is bounded by a group and one document, and at most one sequence of a task is padded.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrail.llm.tables import give_back, map_batches
from velotrail.llm.tokens import default_tokenizer, encoder

WINDOW, TIERS, GROUP_TOKENS, STEP_WINDOWS = 2048, (2048, 1024, 512, 256), 1 << 20, 16
#: The last window of a task is cut down to this size.
LEAST = 64
PIECE = ("doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
         "tier int, step_id long")


class _Packer:
    """Windows are lists of (document, start, length); a tail is (length, document, start)."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers, self.tails, self.windows = tiers, [], []

    def add(self, doc: int, length: int) -> None:
        most = self.tiers[0]
        whole = length // most * most
        self.windows += [[(doc, s, most)] for s in range(0, whole, most)]
        if length > whole:
            insort(self.tails, (length - whole, doc, whole))

    def _fill(self, size: int) -> list[tuple[int, int, int]]:
        """One window of that size: the longest tail, then the longest that fit, then a part of the next."""
        window, gap = [], size
        while gap and self.tails:
            k = bisect_right(self.tails, (gap, 1 << 62, 0))
            if k:
                length, doc, start = self.tails.pop(k - 1)
            else:
                n, doc, start = self.tails.pop(0)
                length = gap
                insort(self.tails, (n - gap, doc, start + gap))
            window.append((doc, start, length))
            gap -= length
        return window

    def pack(self, last: bool) -> None:
        """Place all tails; without ``last``, what can't fill a window stays for the next group."""
        open_ = sum(t[0] for t in self.tails)
        for size, shorter in zip(self.tiers, [*self.tiers[1:], 0], strict=True):
            while self.tails and self.tails[-1][0] > shorter and open_ >= size:
                self.windows.append(self._fill(size))
                open_ -= size
        while last and self.tails:
            size = self.tiers[0]
            while size > open_:
                size //= 2
            size = size if size >= LEAST else self.tiers[0]
            self.windows.append(self._fill(size))
            open_ = max(0, open_ - size)


def _steps(windows: list[list[tuple[int, int, int]]], size: int) -> list[tuple[int, list]]:
    """(step, window) in order of steps; windows of one length are dealt by cost, to and fro."""
    out, done = [], 0
    by: dict[int, list] = {}
    for w in windows:
        by.setdefault(sum(p[2] for p in w), []).append(w)
    for length in sorted(by, reverse=True):
        own = sorted(by[length], key=lambda w: (-sum(p[2] ** 2 for p in w), w))
        n = -(-len(own) // size)
        dealt: list[list] = [[] for _ in range(n)]
        for k, w in enumerate(own):
            turn, at = divmod(k, n)
            dealt[n - 1 - at if turn % 2 else at].append(w)
        out += [(done + k, w) for k, step in enumerate(dealt) for w in step]
        done += n
    return out


def _pack(path: str, end_id: int, tiers: tuple[int, ...], group_tokens: int, step_windows: int):
    def run(batches):
        encode, part = encoder(path).encode_all, TaskContext.get().partitionId()
        held: dict[int, tuple[int | None, bytes]] = {}
        packer, waiting, serial, steps = _Packer(tiers), 0, part << 40, part << 40

        def flush(last: bool):
            nonlocal serial, steps, held
            packer.pack(last)
            rows = []
            for step, window in _steps(packer.windows, step_windows):
                offset, tier = 0, sum(p[2] for p in window)
                for doc, start, length in window:
                    doc_id, ids = held[doc]
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, length, own, zlib.crc32(own), len(ids) // 4, serial, offset, tier, steps + step))
                    offset += length
                serial += 1
            steps = rows[-1][-1] + 1 if rows else steps
            packer.windows = []
            held = {t[1]: held[t[1]] for t in packer.tails}
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4 + [pa.int32(), pa.int64()]
            names = [c.split()[0] for c in PIECE.split(", ")]
            for k in range(0, len(rows), 1000):
                columns = zip(*rows[k : k + 1000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        number = 0
        for batch in batches:
            ids, at = encode(batch.column(1), end_id)
            for doc_id, s, e in zip(batch.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                held[number] = doc_id, ids[s:e].tobytes()
                packer.add(number, e - s)
                number += 1
                waiting += e - s
                if waiting >= group_tokens:
                    yield from flush(False)
                    waiting = 0
            give_back()  # else a task holds what its largest batches took
        yield from flush(True)

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, tiers: tuple[int, ...] = TIERS,
         group_tokens: int = GROUP_TOKENS, step_windows: int = STEP_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document: its place in the document and in its sequence, and its ids.

    Ids are those of the whole text (null: empty) and ``end_id``, as little-endian unsigned 32-bit integers in ``ids``.
    ``tiers`` are descending powers of two.  Sequences are as long as a tier, but for at most one of each task, which
    the reader pads to the largest.  Ids of documents are copied to the pieces: absent ids stay absent, and rows that
    repeat an id are documents of their own.  Other columns are not read; an empty table gives no pieces.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, _pack(tokenizer or default_tokenizer(), end_id, tiers, group_tokens, step_windows), PIECE)
