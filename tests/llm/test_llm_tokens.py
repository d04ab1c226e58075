import random
import zlib
from array import array
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from brute import LONG, empty, frame, rows

from velotrail.llm import packing as packing_module
from velotrail.llm.packing import pack
from velotrail.llm.token_files import read_token_files, token_checksums, write_token_files
from velotrail.llm.tokens import Encoder, default_tokenizer
from velotrail.plans.scratch import scratch_path


@pytest.fixture(scope="module")
def encoder():
    return Encoder(default_tokenizer())


def ids_of(encoder, text):
    return encoder.whole.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(array("I", ids).tobytes())


def test_units_give_the_ids_of_whole_texts(encoder):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "Word", "don't", "'s", "'ll", "é", "ñandú", "12", "3.5", "!", "...", "\x1c", "\x85", "\xa0", " ", "日本",
             "<|endoftext|>", "ß", " '", "’", "\U0001f600", "́", "​", "_", "\r\n", "²", "ǅ", "\x00", "end.\nNext"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert encoder.encode(text) == array("I", ids_of(encoder, text)).tobytes(), text


def test_long_texts_in_pieces(encoder, monkeypatch):
    from velotrail.llm import tokens

    monkeypatch.setattr(tokens, "PIECE", 50)
    for text in ("x" * 500, LONG[:5000] + "  " + LONG[:3000], "\n" * 300, " " * 300 + "a" * 100 + " b" * 100):
        assert encoder.encode(text) == array("I", ids_of(encoder, text)).tobytes()


def test_token_files_round_trip(spark, encoder):
    data = rows()
    path = scratch_path(spark, "test-files")
    write_token_files(frame(spark, data).repartition(5), path)
    files = read_token_files(spark, path)
    got = sorted(((r.start, r.doc_id, r.n_tokens, list(r.ids)) for r in files.collect()), key=lambda r: r[0])
    assert [r[1] for r in got] == sorted((r[0] for r in data), key=lambda d: -1 if d is None else d)
    assert sorted((repr(r[1]), r[3]) for r in got) == sorted((repr(r[0]), [*ids_of(encoder, r[1]), 0]) for r in data)
    at = 0
    for start, _, n, ids in got:
        assert start == at and n == len(ids)
        at += n
    sums = {r.start: (r.doc_id, r.n_tokens, r.ids_crc32) for r in token_checksums(files).collect()}
    assert sums == {s: (d, n, crc(ids)) for s, d, n, ids in got}


def test_token_files_find_documents_by_id(spark):
    path = scratch_path(spark, "test-files")
    write_token_files(frame(spark, rows()), path)
    found = spark.read.orc(path).filter("doc_id = 9")
    assert "EqualTo(doc_id,9)" in found._jdf.queryExecution().toString()
    assert found.count() == 2


def test_token_files_of_an_empty_table(spark):
    path = scratch_path(spark, "test-files")
    write_token_files(empty(spark), path)
    assert read_token_files(spark, path).count() == 0


def check_pieces(pieces, documents, tiers, padded):
    """documents: lists of ids; every id lies in one piece, sequences have no gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[(p.doc_id, p.doc_tokens)].append(p)
        by_sequence[p.sequence_id].append(p)
        assert p.length == len(p.ids) // 4 and p.ids_crc32 == zlib.crc32(bytes(p.ids))
    want = Counter((d, tuple(ids)) for d, ids in documents)
    got = Counter()
    for (doc, n), own in by_doc.items():
        copies = sum(p.start == 0 for p in own)
        own.sort(key=lambda p: p.start)
        if copies == 1:
            at, ids = 0, []
            for p in own:
                assert p.start == at
                at += p.length
                ids += array("I", bytes(p.ids)).tolist()
            assert at == n
            got[(doc, tuple(ids))] += 1
        else:
            assert sum(p.length for p in own) == copies * n
            got[(doc, next(i for d, i in want if d == doc and len(i) == n))] += copies
    assert got == want
    odd = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= tiers[0] and {p.tier for p in own} == {at}
        odd += bool(at & (at - 1))
    assert odd <= padded


@pytest.mark.parametrize(("tiers", "group"), [((2048, 1024, 512, 256), 1 << 21), ((64, 16, 8), 300), ((8,), 1)])
def test_packing_places_every_id_once(spark, encoder, tiers, group):
    data = [r for r in rows() if r[1] is None or len(r[1]) < 10_000 or tiers[0] > 1000]
    df = frame(spark, data).repartition(3)
    pieces = pack(df, tiers=tiers, group_tokens=group).collect()
    check_pieces(pieces, [(r[0], [*ids_of(encoder, r[1]), 1]) for r in data], tiers, 3)


def test_steps_have_like_costs(spark):
    rng = random.Random(5)
    data = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 400))), None, None, 0) for k in range(300)]
    pieces = pack(frame(spark, data).coalesce(1), step_windows=4).filter("tier = 2048").collect()
    cost, windows = Counter(), defaultdict(set)
    for p in pieces:
        cost[p.step_id] += p.length**2
        windows[p.step_id].add(p.sequence_id)
    full = [cost[s] for s, w in windows.items() if len(w) == 4]
    assert max(full) < 1.6 * min(full)


def test_packing_gives_memory_back_with_each_batch(monkeypatch):
    """A task's memory does not stay at what its largest batch took."""
    class Task:
        get, partitionId = staticmethod(lambda: Task), staticmethod(lambda: 0)

    given = []
    monkeypatch.setattr(packing_module, "TaskContext", Task)
    monkeypatch.setattr(packing_module, "give_back", lambda: given.append(1))
    batches = [pa.RecordBatch.from_arrays([pa.array([k]), pa.array(["some words here"])], ["doc_id", "text"]) for k in range(5)]
    packed = list(packing_module._pack(default_tokenizer(), 1, packing_module.TIERS, 4, 16)(batches))
    assert len(given) == 5 and {x for out in packed for x in out.column(0).to_pylist()} == set(range(5))


def test_packing_of_an_empty_table(spark):
    assert pack(empty(spark)).count() == 0
