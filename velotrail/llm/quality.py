"""Quality classifier from weak labels.

Overlapping heuristic labellers look at every document and vote good, bad or not at all.  Expectation-maximisation over the
counts of vote patterns (at most 3 ** 9, whatever the table's size) estimates how often each labeller is right and gives
each pattern a posterior.  The posteriors of a sample train a hashed linear scorer on the shapes of the text, which judges
all documents.  Where human labels say which documents are toxic, a second hashed linear scorer on words and their
beginnings learns that from a sample of them.

Both samples are bounded: about MAX_TRAIN rows, taken by hash.  Everything else covers all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrail.llm.language import held_out
from velotrail.llm.spans import BLANK, U64, WORDY, hashes, parts, per_text, runs, utf8
from velotrail.llm.tables import map_batches

MAX_TRAIN = 20_000
SHAPE_BITS, WORD_BITS, PREFIX = 16, 20, 4
#: Documents of fewer words get no vote from labellers that count words.
FEW = 30
# Frequent small words of the languages served, as the stop-word labeller reads them.
STOP_WORDS = ("the of and to in is that it for was on are as with his they at be this from have or by one had not but what all were "
              "der die das und ist nicht ein eine zu den mit von im auf sich le la les de des et un une est que pour dans en du qui sur "
              "el los las y del se por con una para su al lo como").split()
LABELLERS = ("upper", "symbols", "marks", "repeats", "runs", "bare", "stops", "ends", "length")

UPPER, LOWER, SYMBOL, MARK = (np.zeros(256, dtype=bool) for _ in range(4))
UPPER[65:91] = True
LOWER[97:123] = LOWER[128:] = True
SYMBOL[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True
MARK[[ord(c) for c in "!?"]] = True
#: Letters, digits and blanks stand for their kind in shapes.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[LOWER], SHAPE[UPPER], SHAPE[48:58], SHAPE[BLANK] = ord("a"), ord("A"), ord("0"), ord(" ")


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


class Texts:
    """What the labellers and scorers read of some texts."""

    def __init__(self, column: pa.Array):
        self.data, self.at = utf8(column)
        self.n = len(column)
        self.starts, self.ends, self.first = runs(self.data, self.at, ~BLANK)
        self.words = np.diff(self.first)
        self.hash = hashes(self.data, self.starts, self.ends)

    def count(self, kind: np.ndarray) -> np.ndarray:
        return per_text(np.add, kind[self.data].astype(np.int64), self.at)

    def of_words(self, flag: np.ndarray) -> np.ndarray:
        return _share(per_text(np.add, flag.astype(np.int64), self.first), self.words)

    def same(self) -> np.ndarray:
        """Whether each word is the one before it."""
        same = np.zeros(len(self.hash), bool)
        same[1:] = self.hash[1:] == self.hash[:-1]
        same[self.first[:-1][self.words > 0]] = False
        return same

    def repeats(self) -> np.ndarray:
        return self.of_words(self.same())

    def runs(self) -> np.ndarray:
        """Whether a word stands four times in a row."""
        same = self.same()
        four = same.copy()
        for back in (1, 2):
            four[back:] &= same[:-back]
            four[:back] = False
        return per_text(np.maximum, four, self.first)

    def votes(self) -> np.ndarray:
        """1, -1 or 0 of each labeller for each text."""
        stops = np.sort(hashes(*_laid_out(STOP_WORDS)))
        wordy = np.concatenate([[0], np.cumsum(WORDY[self.data])])
        place = np.minimum(np.searchsorted(stops, self.hash), len(stops) - 1)
        seen = per_text(np.add, (~BLANK[self.data]).astype(np.int64), self.at)
        upper, lower = self.count(UPPER), self.count(LOWER)
        some, many = self.words > 0, self.words >= FEW
        last = self.data[self.ends - 1] if len(self.ends) else self.data[:0]
        ends = self.of_words(np.isin(last, [ord(c) for c in ".?!"]))
        length = _share(per_text(np.add, self.ends - self.starts, self.first), self.words)
        stop = self.of_words(stops[place] == self.hash)
        bare = self.of_words(wordy[self.ends] == wordy[self.starts])
        upper, symbols, marks, repeats = _share(upper, upper + lower), _share(self.count(SYMBOL), seen), _share(self.count(MARK), self.words), self.repeats()
        run = self.runs()
        rules = {
            "upper": (some & (upper < 0.25), some & (upper > 0.45)),
            "symbols": (some & (symbols < 0.01), some & (symbols > 0.04)),
            "marks": (some & (marks < 0.2), some & (marks > 0.6)),
            "repeats": (some & (repeats < 0.03), some & (repeats > 0.1)),
            "runs": (many & ~run, some & run),
            "bare": (some & (bare < 0.05), some & (bare > 0.2)),
            "stops": (many & (stop > 0.05), many & (stop < 0.01)),
            "ends": (many & (ends > 0.01) & (ends < 0.3), many & ((ends == 0) | (ends > 0.6))),
            "length": (some & (length > 3) & (length < 9), some & ((length < 2) | (length > 15))),
        }
        return np.column_stack([rules[name][0].astype(np.int8) - rules[name][1].astype(np.int8) for name in LABELLERS])

    def shapes(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashed shape of every four bytes that lie in one text, and where each text's begin."""
        if len(self.data) < 4:
            return np.zeros(0, np.int64), np.zeros(self.n + 1, np.int64)
        m = SHAPE[self.data].astype(np.uint32)
        code = (m[:-3] << 24) | (m[1:-2] << 16) | (m[2:-1] << 8) | m[3:]
        slot = ((code * np.uint32(2654435761)) >> np.uint32(32 - SHAPE_BITS)).astype(np.int64)
        size = np.diff(self.at)
        inside = np.ones(len(slot), bool)
        for back in (1, 2, 3):
            edge = self.at[1:-1] - back
            inside[edge[(edge >= 0) & (edge < len(slot))]] = False
        return slot[inside], np.concatenate([[0], np.cumsum(np.maximum(size - 3, 0))])

    def terms(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashed words and beginnings of words, two in turn, and where each text's begin."""
        starts, ends, first = runs(self.data, self.at, WORDY)
        whole = hashes(self.data, starts, ends, 31)
        begin = hashes(self.data, starts, np.minimum(ends, starts + PREFIX), 32)
        return (np.column_stack([whole, begin]).ravel() >> U64(64 - WORD_BITS)).astype(np.int64), 2 * first


def _laid_out(words: list[str]):
    raw = [w.encode() for w in words]
    end = np.cumsum([len(w) for w in raw])
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], end[:-1]]), end


def _pattern(votes: np.ndarray) -> np.ndarray:
    return ((votes.astype(np.int64) + 1) * 3 ** np.arange(len(LABELLERS))).sum(axis=1)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """EM over vote patterns: share of good documents, accuracy of each labeller, posterior of each pattern.

    Labellers are independent given the truth; how often each votes bad or good, when it votes, is estimated for good and for
    bad documents, and not voting says nothing.  At the start any bad vote makes a document bad, since each kind of junk is
    seen by few labellers.  A labeller's accuracy is the expected share of its votes that are right.
    """
    votes = patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    cast = np.stack([votes == 0, votes == 2], axis=2).astype(float)
    posterior = np.where((votes == 0).any(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        classes = counts * (1 - posterior), counts * posterior
        prior = (classes[1].sum() + 1) / (counts.sum() + 2)
        # A tenth of a vote each way keeps all probabilities above 0.
        times = [np.einsum("p,pjv->jv", w, cast) + 0.1 for w in classes]
        bad, good = (np.log(t) - np.log(t.sum(axis=1, keepdims=True)) for t in times)
        odds = np.log(prior) - np.log(1 - prior) + np.einsum("pjv,jv->p", cast, good - bad)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    told = np.einsum("p,pjv->jv", counts * posterior, cast)[:, 1] + np.einsum("p,pjv->jv", counts * (1 - posterior), cast)[:, 0]
    return float(prior), told / np.maximum(np.einsum("p,pjv->j", counts, cast), 1e-9), posterior


def fit_linear(at: np.ndarray, slot: np.ndarray, value: np.ndarray, target: np.ndarray, size: int, decay: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Sparse logistic regression (accelerated proximal gradient, L1); rows are slot[at[k]:at[k + 1]]."""
    rows = len(target)
    row = np.repeat(np.arange(rows), np.diff(at))
    weight = np.where(target > 0.5, 0.5 / max(target.sum(), 1), 0.5 / max((1 - target).sum(), 1))
    # A slot whose rows cannot push harder than the decay stays 0 for good.
    alive = (np.bincount(slot, weights=value * weight[row], minlength=size) > decay)[slot]
    slot, value, row = slot[alive], value[alive], row[alive]
    step = 4.0 / max(float(np.bincount(row, weights=value**2, minlength=rows).max(initial=0)) + 1, 1)
    w, bias, past, past_bias = np.zeros(size), 0.0, np.zeros(size), 0.0
    for k in range(rounds):
        push = k / (k + 3)
        ahead, ahead_bias = w + push * (w - past), bias + push * (bias - past_bias)
        z = np.bincount(row, weights=ahead[slot] * value, minlength=rows) + ahead_bias
        wrong = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        past, past_bias = w, bias
        w = ahead - step * np.bincount(slot, weights=value * wrong[row], minlength=size)
        w, bias = np.sign(w) * np.maximum(np.abs(w) - step * decay, 0), ahead_bias - step * wrong.sum()
    return w.astype(np.float32), float(bias)


#: L1 strength of the word scorer: about six toxic documents must share a word for it to count.
DECAY = 2e-3
#: Scale of shape frequencies, which are small numbers.
SCALE = 20.0
EXTRA = 1 << SHAPE_BITS


def _shape_features(t: Texts):
    """CSR rows of shape frequencies, and the share of repeated words as one more feature."""
    slot, at = t.shapes()
    out, values, edges = [], [], [0]
    repeats = t.repeats()
    for k in range(t.n):
        own, n = np.unique(slot[at[k] : at[k + 1]], return_counts=True)
        out.append(np.append(own, EXTRA))
        values.append(np.append(SCALE * n / max(n.sum(), 1), SCALE * repeats[k]))
        edges.append(edges[-1] + len(own) + 1)
    return np.array(edges), np.concatenate(out) if out else np.zeros(0, np.int64), np.concatenate(values) if values else np.zeros(0)


def _term_features(t: Texts):
    slot, at = t.terms()
    out = [np.unique(slot[s:e]) for s, e in zip(at[:-1], at[1:], strict=True)]
    return np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64), np.concatenate(out) if out else np.zeros(0, np.int64), None


def _sample(kind: str):
    """Feature rows: target column, slots, values."""

    def run(batches):
        for batch in batches:
            for begin, end in parts(batch.column(1)):
                t = Texts(batch.column(1).slice(begin, end - begin))
                at, slot, value = _shape_features(t) if kind == "shape" else _term_features(t)
                value = np.ones(len(slot)) if value is None else value
                lists = [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(x)) for x in (slot.astype(np.int32), value.astype(np.float32))]
                target = batch.column(0).slice(begin, end - begin) if kind == "term" else pa.array(_pattern(t.votes()).astype(np.float64))
                yield pa.RecordBatch.from_arrays([target, *lists], ["target", "slots", "vals"])

    return run


def _votes(batches):
    for batch in batches:
        for begin, end in parts(batch.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(_pattern(Texts(batch.column(0).slice(begin, end - begin)).votes()))], ["pattern"])


def _scores(column: pa.Array, model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior, score and toxicity of each text."""
    posterior, (shape_w, shape_bias), toxic = model
    out = []
    for begin, end in parts(column):
        t = Texts(column.slice(begin, end - begin))
        slot, at = t.shapes()
        z = SCALE * _share(per_text(np.add, shape_w[slot].astype(np.float64), at), np.diff(at)) + SCALE * shape_w[EXTRA] * t.repeats() + shape_bias
        score = np.where(t.words > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0)
        bad = np.zeros(t.n)
        if toxic is not None:
            w, bias = toxic
            term, first = t.terms()
            hit = np.flatnonzero(w[term])
            text = np.searchsorted(first, hit, "right") - 1
            pair = np.unique(np.column_stack([text, term[hit]]), axis=0) if len(hit) else np.zeros((0, 2), np.int64)
            sums = np.bincount(pair[:, 0], weights=w[pair[:, 1]], minlength=t.n) + bias
            bad = np.where(t.words > 0, 1 / (1 + np.exp(-np.clip(sums, -30, 30))), 0.0)
        known = np.array([posterior.get(p, 0.5) for p in _pattern(t.votes()).tolist()])
        out.append((np.where(t.words > 0, known, 0.0), score, bad))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0),) * 3


def _judged(model):
    def run(batches):
        for batch in batches:
            posterior, score, toxic = _scores(batch.column(1), model.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (posterior, score, toxic))], ["doc_id", "posterior", "score", "toxic"])

    return run


def _chosen(rows: int, most: int, *columns: str) -> Column:
    """About ``most`` of so many rows, by hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 20)) < int((1 << 20) * min(1.0, most / max(rows, 1)))


def _table(df: DataFrame):
    """Target, edges, slots and values of a bounded sample."""
    t = df.toArrow().combine_chunks()
    if not t.num_rows:
        return None
    slots, values = (t[c].combine_chunks() for c in ("slots", "vals"))
    at = slots.offsets.to_numpy().astype(np.int64)
    return t["target"].to_numpy(), at - at[0], slots.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy().astype(np.float64)


def train(docs: DataFrame, labels: DataFrame | None = None, max_train: int = MAX_TRAIN):
    """docs: doc_id, text; labels: doc_id, toxic.  (labeller report, model)."""
    counts = map_batches(docs.select("text"), _votes, "pattern long").groupBy("pattern").count().orderBy("pattern").collect()
    patterns, times = (np.array([r[k] for r in counts], dtype=np.int64) for k in (0, 1))
    prior, right, posterior = estimate(patterns, times.astype(np.float64)) if len(patterns) else (0.5, np.full(len(LABELLERS), 0.5), np.zeros(0))
    known = dict(zip(patterns.tolist(), posterior.tolist(), strict=True))
    learn = docs.filter(~held_out(F.col("doc_id")))
    shapes = _table(map_batches(learn.filter(_chosen(int(times.sum()), max_train, "doc_id", "text")).select(F.lit(0.0).alias("target"), "text"),
                                _sample("shape"), "target double, slots array<int>, vals array<float>"))
    shape = np.zeros(EXTRA + 1, np.float32), 0.0
    if shapes:
        target, at, slot, value = shapes
        shape = fit_linear(at, slot, value, np.array([known[int(p)] for p in target]), EXTRA + 1, 1e-4)
    toxic = None
    if labels is not None:
        told = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("double")).alias("target"))
        told = told.filter(_chosen(told.count(), max_train, "doc_id"))
        terms = _table(map_batches(learn.join(F.broadcast(told), "doc_id").select("target", "text"), _sample("term"),
                                   "target double, slots array<int>, vals array<float>"))
        if terms and 0 < terms[0].mean() < 1:
            target, at, slot, value = terms
            toxic = fit_linear(at, slot, value, target, 1 << WORD_BITS, DECAY)
    report = dict(zip(LABELLERS, right.tolist(), strict=True))
    return (prior, report), (known, shape, toxic)


def judge_quality(docs: DataFrame, labels: DataFrame | None = None, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, posterior (of the labellers), score (of the scorer), toxic, kept.

    ``kept``: score at least 0.5 and toxic below 0.5.  Texts without words (null, empty, blank) get 0 in all and are not kept.
    Nothing is learned from rows whose id is held out.  Without labels of both kinds toxic is 0 for all.  Repeated rows count as
    often as they occur; a repeated label's larger value counts.  Other columns are not read; an empty table gives an
    empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    _, model = train(rows, labels, max_train)
    judged = map_batches(rows, _judged(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, posterior double, score double, toxic double")
    return judged.withColumn("kept", (F.col("score") >= 0.5) & (F.col("toxic") < 0.5))
