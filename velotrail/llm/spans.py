"""Words and lines of many texts at once, as numpy arrays over their UTF-8 bytes.

Texts come as one Arrow column.  Spans are byte positions in the column's data; nothing is copied per word.  A span's
hash is a polynomial over random values of its bytes, taken from prefix sums, so one pass serves all spans.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes hashed at a time; spans beyond this length are hashed one by one.
SEGMENT = 1 << 17
#: Bytes of text that are taken apart at a time.
PART = 1 << 20
#: A-Z count as a-z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: Every byte as it is.
SAME = np.arange(256, dtype=np.uint8)
#: Space and \x09 to \x0D.
BLANK = np.zeros(256, dtype=bool)
BLANK[[32, *range(9, 14)]] = True
#: 0-9, A-Z, a-z and every byte of a character beyond ASCII.
WORDY = np.zeros(256, dtype=bool)
WORDY[48:58] = WORDY[65:91] = WORDY[97:123] = WORDY[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + mix(np.array([seed], dtype=U64)))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: empty) and where each begins, with the end."""
    column = pc.fill_null(column, "") if column.null_count else column
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    at = np.frombuffer(where, width, n + 1, column.offset * np.dtype(width).itemsize).astype(np.int64)
    size = int(at[-1] - at[0])
    return (np.frombuffer(data, np.uint8, size, int(at[0])) if size else np.zeros(0, np.uint8)), at - at[0]


def parts(column: pa.Array, most: int = PART):
    """Slices (begin, end) of the column with at most so many bytes, or one text."""
    _, at = utf8(column)
    begin = 0
    while begin < len(column):
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + most, "right")) - 1)
        yield begin, end
        begin = end


def runs(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes with ``inside[byte]`` that stay in one text: starts, ends, and each text's first run."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    own = inside[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    begin, end = own.copy(), own.copy()
    begin[1:] &= ~own[:-1] | edge[1:-1]
    end[:-1] &= ~own[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, at)


def kept(name: str) -> dict:
    """A dict that lives as long as the worker process; the code of this package is sent anew with every task."""
    return sys.__dict__.setdefault("velotrail_llm", {}).setdefault(name, {})


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, for two segments."""
    known = kept("powers")
    if not known:
        base = int(stream(1, 1)[0]) | 1
        for name, factor in (("up", base), ("down", pow(base, -1, 1 << 64))):
            steps = np.full(2 * SEGMENT + 1, factor, dtype=U64)
            steps[0] = 1
            known[name] = np.multiply.accumulate(steps)
    return known["up"], known["down"]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 11, fold: np.ndarray = FOLD) -> np.ndarray:
    """64-bit hash of each span with A-Z folded (with SAME nothing is); starts ascend, spans don't overlap."""
    out = np.zeros(len(starts), dtype=U64)
    long = ends - starts > SEGMENT
    for k in np.flatnonzero(long):
        folded = fold[data[starts[k] : ends[k]]].tobytes()
        out[k] = int.from_bytes(hashlib.blake2b(folded, digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
    which = np.flatnonzero(~long)
    if len(which) < len(starts):
        starts, ends = starts[which], ends[which]
    k, value, (up, down) = 0, stream(seed, 256), _powers()
    while k < len(starts):
        first = int(starts[k])
        e = int(np.searchsorted(starts, first + SEGMENT))
        last = int(ends[e - 1])
        bytes_ = fold[data[first:last]]
        sums = np.zeros(last - first + 1, dtype=U64)
        np.cumsum(value[bytes_] * up[: last - first], out=sums[1:])
        s, t = starts[k:e] - first, ends[k:e] - first
        out[which[k:e]] = mix((sums[t] - sums[s]) * down[s] + (t - s).astype(U64) * U64(0x9E3779B97F4A7C15))
        k = e
    return out


def words(column: pa.Array, inside: np.ndarray, seed: int = 11):
    """Word hashes of all texts, and the place of each text's first word, with the end."""
    data, at = utf8(column)
    starts, ends, first = runs(data, at, inside)
    return hashes(data, starts, ends, seed), first


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles of ``width`` blank-separated words as sorted hashes, end to end, and where each begins.

    A text of fewer words is one shingle; a text without words has none.
    """
    word, first = words(column, ~BLANK)
    count = np.diff(first)
    n = len(count)
    windows = np.maximum(count - width + 1, 0)
    if len(word) >= width:
        value = np.full(len(word) - width + 1, width, dtype=U64)
        for t in range(width):
            value = mix(value + word[t : len(word) - width + 1 + t])
        text = np.repeat(np.arange(n), count)
        value = value[text[: len(value)] == text[width - 1 :]]
    else:
        value = np.zeros(0, dtype=U64)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        at = np.concatenate([[0], np.cumsum(windows)])
        whole = np.zeros(len(short), dtype=U64)
        for k, d in enumerate(short):
            x = np.array([count[d]], dtype=U64)
            for w in word[first[d] : first[d + 1]]:
                x = mix(x + w)
            whole[k] = x[0]
        value = np.insert(value, at[short], whole)
        windows[short] = 1
    at = np.concatenate([[0], np.cumsum(windows)])
    for s, e in zip(at[:-1], at[1:], strict=True):
        value[s:e].sort()
    if not len(value):
        return value, at
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = value[1:] != value[:-1]
    fresh[at[:-1][windows > 0]] = True
    return value[fresh], np.concatenate([[0], np.cumsum(fresh)])[at]


def per_text(reduce: np.ufunc, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``reduce`` over each text's values; texts without values get 0."""
    out = np.zeros(len(at) - 1, dtype=values.dtype)
    full = np.diff(at) > 0
    if full.any():
        out[full] = reduce.reduceat(values, at[:-1][full])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
