"""Quality rules, line first: lines that fail a rule go, then documents that lost too much of their text.

Every line with a word is judged by itself: does it end like a sentence or is as long as a paragraph, is it a row of menu
entries, full of signs, shouted, one word over and over, a stock phrase of web pages, or a copy of an earlier line.  What fails is taken out, and a document of
which more than a given share of its characters failed is rejected.  Before that, documents that are too short or consist of
repeated phrases fail as a whole.

All measures of a batch of texts are sums over its bytes, words and lines, taken from running sums; rows are independent, so
nothing is shuffled.  Words and lines of one text are told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrail.llm.spans import BLANK, SAME, U64, hashes, mix, parts, runs, utf8
from velotrail.llm.tables import map_batches

#: A document fails with fewer words, or with more than so many hundredths of its words in repeated windows of three.
LEAST_WORDS, MOST_REPEATED, SPAN = 50, 50, 3
#: A document is rejected that loses more than so many hundredths of the characters in its words.
MOST_LOST = 50
#: A line of so many words is a paragraph, whatever its end.
PARAGRAPH = 40
#: The rules, in the order of the columns.
RULES = ("punctuation", "navigation", "symbols", "shouting", "stutter", "boilerplate", "repeated")

# What the rules look for.
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|>/»·•"
SENTENCE_ENDS = ".!?:;\"')]}…”’»。！？"
PHRASES = (
    "all rights reserved", "back to top", "by using this site", "click here", "cookie policy", "enable javascript", "leave a comment",
    "log in to", "lorem ipsum", "powered by", "privacy policy", "read more", "share this", "sign up", "skip to content",
    "subscribe to our", "terms of service", "terms of use", "use of cookies",
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines", "lost_chars")
JUDGED = ("doc_id long, " + ", ".join(f"{m} long" for m in MEASURES) + ", " + ", ".join(f"failed_{r} long" for r in RULES)
          + ", base_failed boolean, kept boolean, clean_text string")


def _flags(characters: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in characters if ord(c) < 128]] = True
    return out


_SYMBOL, _SEPARATOR, _END = _flags(SYMBOLS), _flags(SEPARATORS), _flags(SENTENCE_ENDS)
_UPPER, _LOWER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags("abcdefghijklmnopqrstuvwxyz")
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _sums(flags: np.ndarray) -> np.ndarray:
    """Sum of the flags before each place."""
    out = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _ending(data: np.ndarray, ends: np.ndarray, lengths: np.ndarray, characters: str) -> np.ndarray:
    """Spans that end with one of the characters beyond ASCII."""
    out = np.zeros(len(ends), dtype=bool)
    for c in characters:
        raw = c.encode()
        if len(raw) == 1:
            continue
        own = lengths >= len(raw)
        for k, byte in enumerate(raw):
            own = own & (data[np.maximum(ends - len(raw) + k, 0)] == byte)
        out |= own
    return out


class _Part:
    """Words and lines of some texts."""

    def __init__(self, column: pa.Array):
        self.data, self.at = data, at = utf8(column)
        self.n = len(at) - 1
        line = np.flatnonzero(data == 10)
        self.line_first = np.concatenate([[0], np.cumsum(np.diff(np.searchsorted(line, at)) + 1)])
        total = int(self.line_first[-1])
        opens, closes = np.zeros(total, bool), np.zeros(total, bool)
        opens[self.line_first[:-1]] = closes[self.line_first[1:] - 1] = True
        self.ls, self.le = np.empty(total, np.int64), np.empty(total, np.int64)
        self.ls[opens], self.ls[~opens], self.le[closes], self.le[~closes] = at[:-1], line + 1, at[1:], line
        self.text_of_line = np.repeat(np.arange(self.n), np.diff(self.line_first))
        self.ws, self.we, self.word_first = runs(data, at, ~BLANK)
        self.word = hashes(data, self.ws, self.we, 23, SAME)
        self.lw, self.lw_end = np.searchsorted(self.ws, self.ls), np.searchsorted(self.ws, self.le)
        self.words = self.lw_end - self.lw
        self.filled = self.words > 0

    def lines(self, flags: np.ndarray) -> np.ndarray:
        """Number of flagged bytes in each line."""
        s = _sums(flags)
        return s[self.le] - s[self.ls]

    def words_of_lines(self, flags: np.ndarray) -> np.ndarray:
        s = _sums(flags)
        return s[self.lw_end] - s[self.lw]

    def texts(self, of_line: np.ndarray) -> np.ndarray:
        """Sums over the lines of each text."""
        s = _sums(of_line)
        return s[self.line_first[1:]] - s[self.line_first[:-1]]

    def repeated_words(self) -> np.ndarray:
        """Of each text, the words that lie in a window of SPAN words found twice or more in it."""
        count = np.diff(self.word_first)
        out = np.zeros(self.n, np.int64)
        if len(self.word) < SPAN:
            return out
        text = np.repeat(np.arange(self.n), count)
        last = len(self.word) - SPAN + 1
        window = mix(text[:last].astype(U64) + U64(1))
        for k in range(SPAN):
            window = mix(window + self.word[k : k + last])
        own = np.flatnonzero(text[:last] == text[SPAN - 1 :])
        _, number, times = np.unique(window[own], return_inverse=True, return_counts=True)
        begin = own[times[number] > 1]
        hit = np.zeros(len(self.word), dtype=bool)
        for k in range(SPAN):
            hit[begin + k] = True
        s = _sums(hit)
        return s[self.word_first[1:]] - s[self.word_first[:-1]]

    def copies(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of their text."""
        own = np.flatnonzero(self.filled)
        key = mix(hashes(self.data, self.ls[own], self.le[own], 29, SAME) ^ mix(self.text_of_line[own].astype(U64)))
        _, first = np.unique(key, return_index=True)
        out = np.zeros(len(self.ls), dtype=bool)
        out[own] = True
        out[own[first]] = False
        return out

    def phrases(self) -> np.ndarray:
        """Lines that hold one of PHRASES."""
        folded, found = self.data.tobytes().translate(_FOLD), []
        for phrase in PHRASES:
            raw = phrase.encode()
            place = folded.find(raw)
            while place >= 0:
                found.append(place)
                place = folded.find(raw, place + 1)
        out = np.zeros(len(self.ls), dtype=bool)
        out[np.searchsorted(self.ls, np.array(found, np.int64), "right") - 1] = True
        return out

    def failures(self, symbols: np.ndarray, copies: np.ndarray) -> dict[str, np.ndarray]:
        """Which lines fail each rule."""
        data, ws, we, words = self.data, self.ws, self.we, self.words
        before = np.zeros_like(data)
        before[1:] = data[:-1]
        latin = before == 0xC3  # the second byte of a letter from U+00C0 to U+00FF
        upper = self.lines(_UPPER[data] | (latin & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)))
        lower = self.lines(_LOWER[data] | (latin & (data >= 0x9F) & (data <= 0xBF) & (data != 0xB7)))
        length, last = we - ws, data[we - 1] if len(we) else np.zeros(0, np.uint8)
        single = (length == 1) & _SEPARATOR[last]
        single |= _ending(data, we, length, SEPARATORS) & (length == np.where(last == 0xA2, 3, 2))
        doubled = (length > 1) & ((last == 33) | (last == 63)) & (data[np.maximum(we - 2, 0)] == last)
        ended = _END[last] | _ending(data, we, length, SENTENCE_ENDS)
        ended = np.append(ended, False)[np.where(self.filled, self.lw_end - 1, len(we))]
        same = np.zeros(len(ws), dtype=bool)
        same[1:] = self.word[1:] == self.word[:-1]
        same = np.append(same, False)
        same[self.lw[self.filled]] = False  # the first word of a line has none before it
        separators, stutters = self.words_of_lines(single), self.words_of_lines(same[:-1])
        fails = {
            "punctuation": ~ended & (words < PARAGRAPH),
            "navigation": (separators >= 2) & (10 * separators >= words),
            "symbols": 10 * symbols > words,
            "shouting": ((upper + lower >= 10) & (10 * upper > 6 * (upper + lower))) | (4 * self.words_of_lines(doubled) > words),
            "stutter": (words >= 4) & (2 * stutters >= words),
            "boilerplate": self.phrases(),
            "repeated": copies,
        }
        return {rule: fail & self.filled for rule, fail in fails.items()}


def _judge(most_lost: int, least_words: int, most_repeated: int, texts: bool):
    def run(batches):
        for batch in batches:
            for begin, end in parts(batch.column(1)):
                part = _Part(batch.column(1).slice(begin, end - begin))
                data = part.data
                symbols, copies = part.lines(_SYMBOL[data]), part.copies()
                chars = part.lines(~BLANK[data] & ((data & 0xC0) != 0x80))
                fails = part.failures(symbols, copies)
                gone = np.logical_or.reduce(list(fails.values()))
                n_words, word_chars, repeated = np.diff(part.word_first), part.texts(chars), part.repeated_words()
                lost = part.texts(np.where(gone, chars, 0))
                failed = (n_words < least_words) | (100 * repeated > most_repeated * n_words)
                clean = _clean(part, gone) if texts else [None] * part.n
                measures = [n_words, word_chars, part.texts(symbols), part.texts(copies), repeated, np.diff(part.line_first), part.texts(gone), lost]
                columns = [*measures, *[part.texts(fails[r]) for r in RULES]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), *[pa.array(c.astype(np.int64)) for c in columns], pa.array(failed),
                     pa.array(~failed & (100 * lost <= most_lost * word_chars)), pa.array(clean, pa.string())],
                    [c.split()[0] for c in JUDGED.split(", ")])

    return run


def _clean(part: _Part, gone: np.ndarray) -> list[str]:
    """The texts without the lines that failed."""
    raw, out = part.data.tobytes(), []
    some = part.texts(gone)
    for t in range(part.n):
        if not some[t]:
            out.append(raw[part.at[t] : part.at[t + 1]].decode())
            continue
        own = range(part.line_first[t], part.line_first[t + 1])
        out.append(b"\n".join([raw[part.ls[k] : part.le[k]] for k in own if not gone[k]]).decode())
    return out


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_lost: int = MOST_LOST,
                 least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED, texts: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measures, failed lines by rule, base_failed, kept, clean_text.

    Words are runs of characters other than space and \\x09 to \\x0D, lines are parted by \\n; ``n_lines`` counts all, the rules
    judge those with a word.  ``word_chars`` are the code points in words, ``lost_chars`` those in failed lines; a line that
    fails several rules counts for each.  ``n_dup_lines`` equal an earlier line; ``n_repeat_words`` lie in a window of three
    words that occurs twice or more in the text.  ``base_failed``: fewer than ``least_words`` words or more than
    ``most_repeated`` hundredths of them repeated.  ``kept``: not base_failed, and at most ``most_lost`` hundredths of the
    characters lost.  ``clean_text`` is the text without failed lines (null if not ``texts``).  Null and empty texts have one
    line, no words, and fail.  Repeated rows and absent ids are judged like any row.  Other columns are not read; an empty
    table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, _judge(most_lost, least_words, most_repeated, texts), JUDGED)
