"""Token ids of whole texts by the tokenizers library, with a bounded table of pieces.

A byte-level BPE with the usual word pattern takes a text apart from left to right, and some places are always borders
whatever stands around them: before a space that a visible character follows, behind a run of letters that an ASCII character
other than a letter follows, and before a letter behind a newline that stands alone.  A text is the sequence of pieces between
these places, and a piece's ids do not depend on its neighbours.  Pieces are told apart by 64-bit hashes (against a full
table a new piece is taken for a known one once in 10**13 times), and the ids of all pieces of a batch are gathered at once.
New pieces of letters go to the library's BPE model; every other one, and any text with another blank behind a space or with
one of the tokenizer's special strings, goes through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa

from velotrail.llm.spans import SAME, U64, hashes, kept, parts, utf8

#: Pieces of the table and ids in it, together about 35 MB; a full table starts anew.
PIECES, POOL = 1_000_000, 3_500_000
#: Bits of a hash by which the table is entered.
ENTRY = 20
#: Bytes of text that are encoded at a time; longer texts are cut.
PART = 1 << 20
#: Characters that go through the whole tokenizer at once.
PIECE = 1 << 16
_CUT = re.compile(r"(?= \S)")
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
#: Second bytes of the letters from U+00C0 to U+00FF, whose first byte is 0xC3.
_LATIN = np.zeros(256, dtype=bool)
_LATIN[128:192] = True
_LATIN[[0x97, 0xB7]] = False
#: Blanks below U+0080.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True


def _visible_bytes() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def _cuts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin (every byte belongs to one), and which bytes are known letters."""
    before = np.empty_like(data)
    before[:1], before[1:] = 0, data[:-1]
    second = (before == 0xC3) & _LATIN[data]
    letter = _ASCII_LETTER[data] | second
    letter[:-1] |= second[1:]
    cut = data == 32
    after = letter[:-1] & ~letter[1:] & (data[1:] < 128)
    cut[1:] |= after
    line = letter & (before == 10)
    if len(data) > 2:
        line[2:] &= (data[:-2] > 32) & (data[:-2] < 127)
    line[:2] = False
    cut |= line
    cut[at[:-1][at[:-1] < len(data)]] = True
    return np.flatnonzero(cut), letter


def _blank_texts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Texts with a space at the end or with another blank behind a space."""
    space = np.flatnonzero(data == 32)
    text = np.searchsorted(at, space, "right") - 1
    last = space + 1 == at[text + 1]
    room = np.concatenate([data, np.zeros(3, np.uint8)])
    one = room[space + 1]
    blank = last | _BLANK[one]
    wide = np.flatnonzero((one == 0xC2) | (one == 0xE1) | (one == 0xE2) | (one == 0xE3))
    for k in wide[~blank[wide]]:
        s = int(space[k]) + 1
        blank[k] = data[s : s + (2 if one[k] == 0xC2 else 3)].tobytes().decode(errors="replace")[0].isspace()
    return np.unique(text[blank])


class _Pieces:
    """Sorted hashes of pieces, and where each one's ids lie in a pool."""

    def __init__(self):
        self.hash, self.at, self.n = np.zeros(0, U64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)
        self._enter()

    def _enter(self) -> None:
        self.end = np.append(self.hash, U64(0))
        self.entry = np.concatenate([[0], np.cumsum(np.bincount((self.hash >> U64(64 - ENTRY)).view(np.int64), minlength=1 << ENTRY))]).astype(np.int32)

    def full(self) -> bool:
        return len(self.hash) > PIECES or len(self.pool) > POOL

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each hash; -1 where it is unknown."""
        top = (wanted >> U64(64 - ENTRY)).view(np.int64)
        place = self.entry[top]
        left = np.flatnonzero((self.end[place] != wanted) | (place == len(self.hash)))
        while len(left):
            place[left] += 1
            past = place[left] >= self.entry[top[left] + 1]
            place[left[past]] = -1
            left = left[~past]
            left = left[self.end[place[left]] != wanted[left]]
        return place

    def add(self, hash_: np.ndarray, ids: list[bytes]) -> None:
        """New pieces, hashes ascending."""
        n = np.array([len(x) // 4 for x in ids], np.int32)
        at = (len(self.pool) + np.cumsum(n) - n).astype(np.int32)
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), np.uint32)])
        where = np.searchsorted(self.hash, hash_)
        self.hash, self.at, self.n = np.insert(self.hash, where, hash_), np.insert(self.at, where, at), np.insert(self.n, where, n)
        self._enter()


class Encoder:
    """Ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.plain = isinstance(self.model, BPE) and type(self.whole.pre_tokenizer).__name__ == "ByteLevel" and self.whole.normalizer is None
        self.table = dict(enumerate(_visible_bytes()))
        self.special = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.known = _Pieces()

    def _whole(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, raw: list[bytes]) -> list[bytes]:
        """Ids of words of letters, each maybe with a space before it."""
        tokenize = self.model.tokenize
        words = b"\n".join(raw).decode("latin-1").translate(self.table).split(self.table[10]) if raw else []
        return [array("I", [t.id for t in tokenize(w)]).tobytes() for w in words]

    def _pieces(self, text: str) -> bytes:
        """Any text, in pieces of bounded size where it can be cut."""
        out, begin = [], 0
        while begin < len(text):
            cut = _CUT.search(text, begin + PIECE) if len(text) - begin > PIECE else None
            end = cut.start() if cut else len(text)
            out.append(self._whole(text[begin:end]))
            begin = end
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()

    def encode_all(self, column: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty), each followed by the id ``end``, and where each text's ids begin, with the end."""
        out, sizes, (_, at) = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], utf8(column)
        for begin, stop in parts(column, PART):
            own = column.slice(begin, stop - begin)
            if not self.plain:
                ids, size = self._join([self._whole(t or "") for t in own.to_pylist()], end)
            elif at[stop] - at[begin] > PART:
                ids, size = self._join([self._long(own[0].as_py())], end)
            else:
                ids, size = self._part(own, end)
            out.append(ids), sizes.append(size)
        return np.concatenate(out), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

    @staticmethod
    def _join(texts: list[bytes], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        last = b"" if end is None else np.array([end], np.uint32).tobytes()
        return np.frombuffer(b"".join(t + last for t in texts), np.uint32), np.array([len(t + last) // 4 for t in texts], np.int64)

    def _long(self, text: str) -> bytes:
        """A long text in parts that begin at a space that a visible character follows."""
        out, begin = [], 0
        while begin < len(text):
            cut = _CUT.search(text, begin + PART // 8) if len(text) - begin > PART // 8 else None
            stop = cut.start() if cut else len(text)
            own = text[begin:stop]
            out.append(self._part(pa.array([own], pa.string()), None)[0].tobytes() if len(own) <= PART // 4 else self._pieces(own))
            begin = stop
        return b"".join(out)

    def _part(self, column: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some texts, gathered piece by piece, and how many each text has."""
        data, at = utf8(column)
        n = len(at) - 1
        starts, letter = _cuts(data, at)
        ends = np.append(starts[1:], len(data))[: len(starts)]
        piece = hashes(data, starts, ends, 17, SAME)
        first = np.searchsorted(starts, at)
        place = self._places(data, starts, ends, letter, piece)
        pool, begin, size = self.known.pool, self.known.at[place].astype(np.int64), self.known.n[place].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(size)])
        counts = total[first[1:]] - total[first[:-1]]
        slow = np.union1d(_blank_texts(data, at), self._with_special(data, at))
        if len(slow):  # the whole text stands in the place of its first piece
            texts = [self._pieces(column[int(t)].as_py()) for t in slow]
            for t in slow:
                size[first[t] : first[t + 1]] = 0
            counts[slow] = size[first[slow]] = [len(x) // 4 for x in texts]
            begin[first[slow]] = len(pool) + np.cumsum(counts[slow]) - counts[slow]
            pool = np.concatenate([pool, np.frombuffer(b"".join(texts), np.uint32)])
        to = np.cumsum(size) - size
        ids = pool[np.repeat(begin - to, size) + np.arange(int(size.sum()))]
        if end is not None:
            ids = np.insert(ids, np.cumsum(counts), end)
            counts = counts + 1
        return ids, counts

    def _with_special(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Texts that hold one of the tokenizer's special strings."""
        raw, found = data.tobytes(), []
        for special in self.special:
            place = raw.find(special)
            while place >= 0:
                found.append(place)
                place = raw.find(special, place + 1)
        return np.searchsorted(at, np.array(found, np.int64), "right") - 1

    def _places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, letter: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Place in the table of each piece; unknown ones are added."""
        if self.known.full():
            self.known = _Pieces()
        place = self.known.find(piece)
        unknown = np.flatnonzero(place < 0)
        if not len(unknown):
            return place
        fresh, at_first = np.unique(piece[unknown], return_index=True)
        where = unknown[at_first]
        s, e = starts[where], ends[where]
        letters = np.concatenate([[0], np.cumsum(letter)])
        words = (letters[e] - letters[s] == e - s - (data[s] == 32)) & (e - s > (data[s] == 32)) & (e - s < PIECE)
        raw = [data[a:b].tobytes() for a, b in zip(s.tolist(), e.tolist(), strict=True)]
        ids = iter(self._letters([r for r, w in zip(raw, words.tolist(), strict=True) if w]))
        self.known.add(fresh, [next(ids) if w else self._pieces(r.decode()) for r, w in zip(raw, words.tolist(), strict=True)])
        return self.known.find(piece)


def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    known = kept("encoders")
    if path not in known:
        known[path] = Encoder(path)
    return known[path]


def default_tokenizer() -> str:
    """Where the box keeps the byte-level BPE with 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
