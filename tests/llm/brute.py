"""Small inputs, and plain versions of the operators to compare with."""

import hashlib
import re
from itertools import combinations

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # Columns named like those that the operators make.
          "keep_id long, row long, class long, bitmap binary, shard int, slot long, hits string, spans string, kept boolean")
FOLD = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
BLANKS = " \t\n\x0b\x0c\r"

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))
BASE = " ".join(f"w{i}" for i in range(60))
LINE = "This line is in many of the documents"
TEXTS = [
    None, "", "   ", "\n\n", "One", "ONE", "one ", "Été été", "été été",
    BASE, BASE.upper(), BASE.replace("w7 ", "x7 "), BASE.replace("w7 ", "y7 ").replace("w30 ", "y30 "), BASE + " tail", "other " * 5,
    f"{LINE}\nand a line of its own here, {1}", f"first words of text\n  {LINE.upper()} \t", f"{LINE}\n{LINE}\nlast one", f"x\n{LINE}", f"{LINE}",
    "short\nshort", "short\nlines", "short\n", LONG, LONG + " end", "\U0001f600 中文 <|endoftext|> \x85 a  b\t\tc",
    "mail me at a.b@c.org, card 4111 1111 1111 1111, from 10.0.0.255 or 300.1.1.1; call +49 (30) 1234-5678",
]


def rows(texts=TEXTS, start=0):
    """(doc_id, text, ...) with an absent id, a repeated row, and an id with two texts."""
    out = [(start + k, t, ("en", "de", None, "fr")[k % 4], "src", len(t or "")) for k, t in enumerate(texts)]
    return out + [out[4], (start + 9, "a text under an id that is there", "en", None, None), (None, BASE, "en", None, 3), (None, None, None, None, None)]


def frame(spark, data):
    return spark.createDataFrame([(*r, 7, 7, 7, b"7", 7, 7, "7", "7", False) for r in data], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def near(data, width, percent):
    """{row number: component} of rows with an id."""
    sets = [shingles(r[1], width) for r in data]
    parent = list(range(len(data)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    ids = [k for k, r in enumerate(data) if r[0] is not None and sets[k]]
    for a, b in combinations(ids, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[root(a)] = root(b)
    least = {}
    for k in ids:
        least[root(k)] = min(least.get(root(k), data[k][0]), data[k][0])
    return {k: least[root(k)] if sets[k] else data[k][0] for k in range(len(data)) if data[k][0] is not None}


def keep_lines(data, min_chars, min_docs):
    """Kept text and number of dropped lines of each row."""
    def key(line):
        return line.strip(BLANKS).translate(FOLD)

    holders = {}
    for doc, text, *_ in data:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(doc)
    last = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for doc, text, *_ in data:
        lines = (text or "").split("\n")
        stay = [x for x in lines if doc is None or last.get(key(x), doc) == doc]
        out.append(("\n".join(stay), len(lines) - len(stay)))
    return out


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def contamination(text, items, width=10):
    """(words, hit words, items found)."""
    own, hit, found = words(text), set(), set()
    for item, benchmark in items:
        w = words(benchmark)
        m = min(width, len(w))
        windows = {tuple(w[k : k + m]) for k in range(len(w) - m + 1)} if m else set()
        for k in range(len(own) - m + 1 if m else 0):
            if tuple(own[k : k + m]) in windows:
                hit |= set(range(k, k + m))
                found |= {str(item)} if item is not None else set()
    return len(own), len(hit), sorted(found)
