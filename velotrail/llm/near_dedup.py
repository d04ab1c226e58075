"""MinHash near-dedup with tensored banding, verified on full shingle sets.

Two small collections of sub-signatures (``BANDS`` each, of ``ROWS`` minhashes) give a table key for every pair of one from
each: BANDS * BANDS tables of 2 * ROWS minhashes from 2 * BANDS * ROWS of them.  Two texts with similarity J meet in some
table unless one collection fails, with probability about 2 * (1 - J**ROWS) ** BANDS.

Texts with equal sets form a class, and only classes take part.  Classes that share a key form a bucket; its members are not
paired with one another.  First come the tables whose two sub-signatures have the same number, BANDS of them: there all meet the
first and the last class of their bucket, by one of some orders, and each is compared with those that it meets most often, which
joins groups of near copies.  Members of one component need no further test, so of all tables only buckets with several
components are left.  All tables of one left sub-signature are made where the classes that share it meet: a class is sent there once,
with its right sub-signatures, and not once for each table.  A bucket of up to BLOCK members streams through one task twice.  First
with a sketch of each set, the parity of the number of its shingles in each of some slots: two sketches differ in no more bits than
the sets differ in shingles, so members whose sketches differ too much from all of other components go, and no link with them.  What
is left falls into groups that sketches connect; a group that several buckets have is compared once.  Then the task compares the full
sets of members of different components and lets out only links that join two of them.

The members of larger buckets meet by shared shingles.  All shingles are ordered, rare ones first (by a table of counts of fixed
size: any fixed order gives the same links).  Two similar sets have their first common shingle so early that what lies behind it
is still long enough, in both, for the sets' sizes.  A set is filed under the shingles up to there, for each band of sizes that a
partner may have, and looked up likewise; so texts made from one template, which share much but not enough, have few keys
in common.  Small sketches of the sets lie in the rows that meet and rule out most of what is not similar.  These pairs are
confirmed on the full sets, too.  No pair in a bucket is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrail.llm.spans import U64, mix, parts, per_text, shingle_sets, signed, stream
from velotrail.llm.tables import components, join_groups, map_batches, small, write_out

WIDTH, PERCENT, BANDS, ROWS = 2, 80, 14, 3
#: Orders by which buckets have a first and a last class.
ORDERS = 4
#: Ends of buckets that a class is compared with at most, before all tables are looked at.
NEAREST = 2
CLASS = "doc_id long, row long, class long, n_shingles long, left array<int>, right array<int>, sketch binary"


def class_of(value: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hash of each text's set, whatever its order."""
    size = np.diff(at).astype(U64)
    one, two = per_text(np.add, mix(value), at), per_text(np.add, mix(value ^ U64(0x5851F42D4C957F2D)), at)
    return mix(mix(one + size) ^ (two * U64(0x9E3779B97F4A7C15)))


def _bands(value: np.ndarray, at: np.ndarray, bands: int, rows: int, collection: int) -> np.ndarray:
    """32-bit hashes of the sub-signatures of one collection, two of which make a key: a line for each text."""
    out = np.zeros((len(at) - 1, bands), dtype=np.uint32)
    salts, factors = stream(100 + collection, bands * rows), stream(200 + collection, bands * rows) | U64(1)
    for band in range(bands):
        h = np.full(len(at) - 1, band, dtype=U64)
        for k in range(band * rows, (band + 1) * rows):
            h = mix(h + per_text(np.minimum, mix_light(value, salts[k], factors[k]), at))
        out[:, band] = h >> U64(32)
    return out


def mix_light(x: np.ndarray, salt, factor) -> np.ndarray:
    x = (x ^ salt) * factor
    return x ^ (x >> U64(32))


def _sketch_words(n: np.ndarray) -> np.ndarray:
    """64-bit words of the sketch of a set of n shingles: bits are a power of two from 2 * n on."""
    return 1 << np.ceil(np.log2(np.maximum(n, 32) / 32)).astype(np.int64)


def _sketches(value: np.ndarray, at: np.ndarray) -> pa.Array:
    """Parity of the number of shingles in each slot; half of the slots is the sketch of half the size, if its halves are xored."""
    n = np.diff(at)
    words = _sketch_words(n)
    begin = np.concatenate([[0], np.cumsum(words)])
    slot = np.repeat(64 * begin[:-1], n) + (value & np.repeat(64 * words - 1, n).astype(U64)).view(np.int64)
    bits = np.zeros(64 * int(begin[-1]), np.uint8)
    np.add.at(bits, slot, np.uint8(1))
    bits &= 1
    edges = pa.py_buffer((8 * begin).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(n), [None, edges, pa.py_buffer(np.packbits(bits, bitorder="little"))])


def _folded(sketch: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_xor.reduce(sketch.reshape(-1, words), axis=0)


def _classes(width: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            for begin, end in parts(batch.column(2)):
                value, at = shingle_sets(batch.column(2).slice(begin, end - begin), width)
                n = np.diff(at)
                sides = [_bands(value, at, bands, rows, collection) for collection in (0, 1)]
                edges = pa.array(np.arange(end - begin + 1, dtype=np.int32) * bands)
                sides = [pa.ListArray.from_arrays(edges, pa.array(side.ravel().view(np.int32))) for side in sides]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(begin, end - begin) for c in batch.columns[:2]), pa.array(signed(class_of(value, at)), mask=(n == 0)),
                     pa.array(n.astype(np.int64)), *sides, _sketches(value, at)], ["doc_id", "row", "class", "n_shingles", "left", "right", "sketch"])

    return run


#: Rows of one left sub-signature that are kept to find out which of them share a right one.
KEPT = 100_000


def _set_code(total: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Number of a bucket with ``size`` members, the mixed classes of which add up to ``total``."""
    return signed(mix(total + size.astype(U64)))


def _shared(key, member, root, shingles, right):
    """(bucket, class, root, n, large) of whole groups of a key: those that share a right sub-signature with one of another root."""
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    several = np.minimum.reduceat(root, begin) != np.maximum.reduceat(root, begin)
    size = np.diff(np.append(begin, len(key)))
    which, bands = np.flatnonzero(np.repeat(several, size)), right.shape[1]
    if not len(which):
        return None
    table = np.repeat(np.arange(len(size)), size)[which, None] * bands + np.arange(bands)
    place = ((table.astype(U64) << U64(32)) | right[which]).ravel()
    order = np.argsort(place)
    place, who = place[order], which[order // bands]
    member, root, shingles = member[who], root[who], shingles[who]
    begin = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    size = np.diff(np.append(begin, len(place)))
    code = _set_code(np.add.reduceat(mix(member.view(U64)), begin), size)
    large = (size > BLOCK) | (np.add.reduceat(shingles, begin) > BLOCK_SHINGLES)
    many = np.repeat(np.minimum.reduceat(root, begin) != np.maximum.reduceat(root, begin), size)
    return [c[many] for c in (np.repeat(code, size), member, root, shingles, np.repeat(large, size))]


def _repeated(batches):
    """Rows (key, class, root, n, right) sorted by key: buckets with several roots, and whether they are large.

    A key stands for a left sub-signature; with each of the right ones it gives a bucket.  Buckets with the same members get
    the same number.  The first and last key of a partition may go on in another one, and very long ones are not kept: these go
    under a number made from key and right sub-signature, and how large they are is left open.
    """

    def emit(columns):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "class", "root", "n", "large"])

    def cut(key, member, root, shingles, right):
        for j in range(right.shape[1]):
            bucket = signed(mix(key.view(U64) ^ mix((right[:, j].astype(U64) << U64(8)) + U64(j))))
            yield emit([bucket, member, root, shingles, pa.nulls(len(key), pa.bool_())])

    held = passing = None
    for batch in batches:
        if not batch.num_rows:
            continue
        fresh = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]]
        fresh.append(batch.column(4).flatten().to_numpy(zero_copy_only=False).view(np.uint32).reshape(batch.num_rows, -1))
        held = [np.concatenate(pair) for pair in zip(held, fresh, strict=True)] if held else fresh
        key = held[0]
        passing = key[0] if passing is None else passing
        if key[0] == passing:
            n = int(np.argmax(key != passing)) if key[-1] != passing else len(key)
            yield from cut(*(c[:n] for c in held))
            held = [c[n:] for c in held]
            key = held[0]
        if not len(key):
            continue
        last = int(np.searchsorted(key, key[-1]))
        if last:
            if (found := _shared(*(c[:last] for c in held))) is not None:
                yield emit(found)
            held = [c[last:] for c in held]
        if len(held[0]) > KEPT:
            yield from cut(*held)
            passing, held = held[0][0], [c[:0] for c in held]
    if held is not None and len(held[0]):
        yield from cut(*held)


def _sets(width: int):
    def run(batches):
        for batch in batches:
            for begin, end in parts(batch.column(0)):
                value, at = shingle_sets(batch.column(0).slice(begin, end - begin), width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(class_of(value, at))), pa.array([value[s:e].tobytes() for s, e in zip(at[:-1], at[1:], strict=True)], pa.binary())],
                    ["class", "set"])

    return run


def _similar(percent: int):
    def run(batches):
        for batch in batches:
            sides = [[np.frombuffer(x, U64) for x in batch.column(k).to_pylist()] for k in (2, 3)]
            ok = []
            for a, b in zip(*sides, strict=True):
                both = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _pivot_pairs(classes: DataFrame, percent: int) -> DataFrame:
    """(a, b) of classes and first or last classes of their buckets in the tables of like-numbered sub-signatures: the NEAREST most often met."""
    keys = classes.select("class", "n", F.posexplode(F.arrays_zip("left", "right")).alias("i", "s"))
    # In some orders, so that a class meets several others of a large group, and not the same in all tables.
    keys = keys.select(F.xxhash64("i", "s.left", "s.right").alias("key"), F.xxhash64("class", F.col("i") % ORDERS).alias("place"), "class", "n")
    own = F.struct("place", "class", "n")
    ends = keys.groupBy("key").agg(F.array_distinct(F.array(F.min(own), F.max(own))).alias("ends")).filter(F.size("ends") > 1)
    met = keys.join(ends.select("key", F.explode("ends").alias("end")), "key")
    near = (F.col("class") != F.col("end.class")) & (100 * F.least("n", "end.n") >= percent * F.greatest("n", "end.n"))
    often = met.filter(near).groupBy("class", F.col("end.class").alias("end")).agg((-F.count("*")).alias("rank"))
    # Of ends met as often as others all take the same, so that groups hang together.
    ends = F.sort_array(F.collect_list(F.struct("rank", F.xxhash64("end").alias("place"), "end")))
    met = often.groupBy("class").agg(F.slice(ends, 1, NEAREST).alias("ends")).select("class", F.explode("ends.end").alias("end"))
    return met.select(F.least("class", "end").alias("a"), F.greatest("class", "end").alias("b")).distinct()


def _buckets(classes: DataFrame) -> DataFrame:
    """(bucket, class, root, large) of classes (class, root, n, left, right) that share a table key with one of another root."""
    own = ("class", "root", "n", "right")
    keys = classes.select(*own, F.posexplode("left").alias("i", "l")).select(F.xxhash64("i", "l").alias("key"), *own)
    # Sorting by key and class lets a key with very many classes spread over partitions.
    ordered = keys.repartitionByRange("key", "class").sortWithinPartitions("key", "class")
    met = write_out(map_batches(ordered, _repeated, "bucket long, class long, root long, n long, large boolean").distinct(), "buckets")
    # The few that a partition's border cuts are put together.
    cut = met.filter("large IS NULL")
    kinds = cut.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("size"), F.sum("n").alias("shingles"))
    large = (F.col("size") > BLOCK) | (F.col("shingles") > BLOCK_SHINGLES)
    kinds = kinds.filter("least <> most").select("bucket", large.alias("much"))
    whole = cut.join(kinds, "bucket").select("bucket", "class", "root", F.col("much").alias("large"))
    return met.filter("large IS NOT NULL").select("bucket", "class", "root", "large").union(whole)


def _of_pair(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """``pairs`` (a, b) with a column of both classes."""
    for side in ("a", "b"):
        pairs = pairs.join(table.select(F.col("class").alias(side), F.col(column).alias(f"{column}_{side}")), side)
    return pairs.select("a", "b", f"{column}_a", f"{column}_b")


def _merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(class, root) after further links between classes."""
    if roots is None:
        return components(links).withColumnRenamed("node", "class")
    # Components are joined as nodes; classes that had no link so far stand for themselves.
    known, ends = small(roots, 32), links
    for side in ("a", "b"):
        ends = ends.join(known.withColumnsRenamed({"class": side, "root": f"root_{side}"}), side, "left")
    ends = ends.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    joined = components(ends)
    before = roots.join(small(joined, 32).withColumnRenamed("node", "old").withColumnRenamed("root", "new"), F.col("root") == F.col("old"), "left")
    fresh = joined.join(known.select(F.col("class").alias("node")), "node", "left_anti").withColumnRenamed("node", "class")
    return write_out(before.select("class", F.coalesce("new", "root").alias("root")).union(fresh), "roots")


#: Members of a bucket that one task compares, and their shingles in all; larger ones meet by shared shingles.
BLOCK, BLOCK_SHINGLES = 256, 4 << 20


class _Block:
    """Members of one bucket with their full sets, and which component each is in."""

    def __init__(self, percent: int, members: list[int], roots: list[int], sets: list[np.ndarray]):
        self.percent, self.members, self.root = percent, members, np.array(roots)
        self.size = np.array([len(x) for x in sets])
        vocabulary, self.place = np.unique(np.concatenate(sets), return_inverse=True)
        self.begin = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        self.mark = np.zeros(len(vocabulary), dtype=bool)

    def links(self, places: np.ndarray, size: int, root: int, may: np.ndarray):
        """Members that join another component to that of a set; the components are one from then on."""
        ok = may & (self.root != root) & (100 * np.minimum(self.size, size) >= self.percent * np.maximum(self.size, size))
        if not ok.any():
            return
        self.mark[places] = True
        both = np.add.reduceat(self.mark[self.place], self.begin, dtype=np.int64)
        self.mark[places] = False
        for k in np.flatnonzero(ok & (100 * both >= self.percent * (self.size + size - both))):
            if self.root[k] != root:
                self.root[self.root == self.root[k]] = root
                yield self.members[k]

    def among(self):
        """Links between the members."""
        kinds, count = np.unique(self.root, return_counts=True)
        large = self.root == kinds[count.argmax()]
        may = large.copy()
        for k in np.flatnonzero(~large):
            own = self.place[self.begin[k] : self.begin[k] + self.size[k]]
            for other in self.links(own, int(self.size[k]), int(self.root[k]), may):
                yield self.members[k], other
            may[k] = True


def _linkable(percent: int, members: list[int], roots: list[int], sizes: list[int], sketches: list[bytes]) -> np.ndarray:
    """The group of each member of a bucket; similar members of different roots are in one. -1: similar to none of another root."""
    root, size, group = np.array(roots), np.array(sizes, np.int64), np.arange(len(members))
    out = np.zeros(len(members), dtype=bool)
    own = [np.frombuffer(x, U64) for x in sketches]
    words = np.array([len(x) for x in own])
    for n in np.unique(words):
        there = np.flatnonzero(words >= n)  # the smaller sketch decides
        folded = np.stack([_folded(own[k], n) for k in there])
        for k in np.flatnonzero(words == n):
            need = overlap(percent, size[there], size[k])
            apart = size[there] + size[k] - 2 * need
            ok = (root[there] != root[k]) & (need <= np.minimum(size[there], size[k]))
            ok[ok] = np.bitwise_count(folded[ok] ^ _folded(own[k], n)).sum(axis=1) <= apart[ok]
            if ok.any():
                out[k] = out[there[ok]] = True
                one = np.zeros(len(members), dtype=bool)
                one[group[k]] = one[group[there[ok]]] = True
                group[one[group]] = np.argmax(one)
    return np.where(out, group, -1)


def _may_link(percent: int, members: list[int], roots: list[int], sizes: list[int], sketches: list[bytes]) -> np.ndarray:
    """Which members of a bucket may be similar to one of another root; all that are, are among them."""
    return _linkable(percent, members, roots, sizes, sketches) >= 0


def _sketched(percent: int):
    """Rows (bucket, class, root, n, sketch) sorted by bucket: (bucket, class, root) of those that may be similar to one of another root.

    Each group that sketches connect is a bucket of its own, with the same number wherever it has the same members.
    """

    def left(held):
        group = _linkable(percent, *held)
        ok = np.flatnonzero(group >= 0)
        total, size = np.zeros(len(group), U64), np.zeros(len(group), np.int64)
        np.add.at(total, group[ok], mix(np.array(held[0], np.int64)[ok].view(U64)))
        np.add.at(size, group[ok], 1)
        code = _set_code(total, size).tolist()
        return [(code[group[k]], held[0][k], held[1][k]) for k in ok]

    def run(batches):
        now, held = None, ([], [], [], [])
        for batch in batches:
            out = []
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now:
                    out += left(held)
                    now, held = bucket, ([], [], [], [])
                for column, value in zip(held, row, strict=True):
                    column.append(value)
            yield _rows_of(out)
        yield _rows_of(left(held))

    return run


def _rows_of(out: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[k] for row in out], pa.int64()) for k in range(3)], ["bucket", "class", "root"])


def _may_differ(open_: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``open_`` without members of small buckets whose sketches rule out a link with a member of another root."""
    rest = open_.filter("not large").join(classes.select("class", "n", "sketch"), "class").select("bucket", "class", "root", "n", "sketch")
    left = map_batches(rest.repartition("bucket").sortWithinPartitions("bucket", "class"), _sketched(percent), "bucket long, class long, root long")
    return left.distinct().withColumn("large", F.lit(False)).union(open_.filter("large"))


def _meet(percent: int):
    """Rows (bucket, class, root, set) sorted by bucket: links that join components."""

    def links(held):
        return pa.RecordBatch.from_arrays([pa.array([f(x) for x in found], pa.int64()) for f in (min, max)], ["a", "b"]) if (
            found := list(_Block(percent, *held).among())) else None

    def run(batches):
        now, held = None, ([], [], [])
        for batch in batches:
            for bucket, member, root, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now:
                    if now is not None and (out := links(held)) is not None:
                        yield out
                    now, held = bucket, ([], [], [])
                for column, value in zip(held, (member, root, np.frombuffer(own, U64)), strict=True):
                    column.append(value)
        if now is not None and (out := links(held)) is not None:
            yield out

    return run


#: Slots of the table of counts that orders shingles, and how much larger the next band of sizes is.
SLOTS, STEP = 1 << 20, 1.05
#: 64-bit words of the sketch that is filed under each key.
FILED = 8


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles) & U64(SLOTS - 1)).astype(np.int64)


def _slot_counts(batches):
    count = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for own in batch.column(0).to_pylist():
            np.add.at(count, _slot(np.frombuffer(own, U64)), 1)
    there = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(count[there])], ["slot", "n"])


def _bands_of_sizes() -> np.ndarray:
    """The least size of each band."""
    edges = [1]
    while edges[-1] < 1 << 31:
        edges.append(max(edges[-1] + 1, int(edges[-1] * STEP)))
    return np.array(edges, np.int64)


def overlap(percent: int, a, b):
    """Common shingles that sets of sizes a and b need to be similar."""
    return -(-percent * (a + b) // (100 + percent))


def _filed(percent: int, counts, short: bool):
    """Rows (class, root, set): a key for each early shingle and band of partner sizes; ``rest`` is what lies from the shingle on, s0 and so on a sketch.

    ``short``: the partner is as large or larger, else as large or smaller.
    """

    def run(batches):
        count, edges = counts.value, _bands_of_sizes()
        for batch in batches:
            for member, root, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(own, U64)
                n = len(own)
                own = own[np.lexsort((own, count[_slot(own)]))]
                band = int(np.searchsorted(edges, n, "right")) - 1
                most = 100 * n // percent if short else n
                least = n if short else -(-percent * n // 100)
                keys, rests = [], []
                for other in range(int(np.searchsorted(edges, least, "right")) - 1, int(np.searchsorted(edges, most, "right"))):
                    need = int(overlap(percent, n, max(least, int(edges[other]))))
                    if need > n:
                        continue
                    both = (band, other) if short else (other, band)
                    keys.append(mix(own[: n - need + 1] + U64((both[0] << 32) + both[1]) * U64(0x9E3779B97F4A7C15)))
                    rests.append(n - np.arange(n - need + 1))
                key = signed(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
                k = len(key)
                bits = (np.bincount((own & U64(64 * FILED - 1)).view(np.int64), minlength=64 * FILED) & 1).astype(np.uint8)
                sketch = np.packbits(bits, bitorder="little").view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(np.full(k, member, np.int64)), pa.array(np.full(k, root, np.int64)), pa.array(np.full(k, n, np.int32)),
                     pa.array((np.concatenate(rests) if rests else np.zeros(0, np.int64)).astype(np.int32)),
                     *[pa.array(np.full(k, word)) for word in sketch]], ["key", "class", "root", "n", "rest", *[f"s{w}" for w in range(FILED)]])

    return run


def _by_shingles(members: DataFrame, percent: int) -> DataFrame:
    """(a, b) of members (class, root, set) of different roots that may be similar: all that are, and few others."""
    spark = members.sparkSession
    counts = map_batches(members.select("set"), _slot_counts, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(SLOTS, np.int64)
    table[counts["slot"].to_numpy()] = counts["n"].to_numpy()
    shared = spark.sparkContext.broadcast(table)  # 8 MB, whatever the data
    made = ", ".join(["key long, class long, root long, n int, rest int", *[f"s{w} long" for w in range(FILED)]])
    short, long_ = (map_batches(members.select("class", "root", "set"), _filed(percent, shared, side), made) for side in (True, False))
    short = short.toDF("key", "a", "a_root", "a_n", "a_rest", *[f"a_s{w}" for w in range(FILED)])
    long_ = long_.toDF("key", "b", "b_root", "b_n", "b_rest", *[f"b_s{w}" for w in range(FILED)])
    need = F.ceil(percent * (F.col("a_n") + F.col("b_n")) / (100 + percent))
    apart = (F.col("a_root") != F.col("b_root")) & (F.struct("a_n", "a") < F.struct(F.col("b_n").alias("a_n"), F.col("b").alias("a")))
    differ = sum((F.bit_count(F.col(f"a_s{w}").bitwiseXOR(F.col(f"b_s{w}"))) for w in range(1, FILED)), F.bit_count(F.col("a_s0").bitwiseXOR(F.col("b_s0"))))
    met = short.join(long_, "key").filter(apart & (F.least("a_rest", "b_rest") >= need) & (differ <= F.col("a_n") + F.col("b_n") - 2 * need))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    return write_out(map_batches(_of_pair(pairs, sets, "set"), _similar(percent), "a long, b long"), "links")


def _sets_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(class, set) of the ``wanted`` classes, from the texts of their first ids."""
    known = write_out(classes.join(small(wanted, 16), "class", "left_semi").select("class", "first_id"), "known")
    texts = docs.join(small(known.select(F.col("first_id").alias("doc_id")).distinct(), 32), "doc_id", "left_semi").select("text")
    sets = map_batches(texts, _sets(width), "class long, set binary").join(small(known.select("class"), 16), "class", "left_semi")
    sets = write_out(sets, "sets")
    if sets.count() == known.count():
        return sets
    # Rows that repeat an id: only sets that came more than once are put together.
    twice = small(write_out(sets.groupBy("class").count().filter("count > 1").select("class"), "twice"), 16)
    once = write_out(sets.join(twice, "class", "left_semi").dropDuplicates(["class"]), "sets")
    return sets.join(twice, "class", "left_anti").union(once)


def _links(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) that join the components of the members of each bucket."""
    rest = small(open_.filter("not large").select("bucket", "class", "root"), 24).join(sets, "class").select("bucket", "class", "root", "set")
    links = write_out(map_batches(rest.repartition("bucket").sortWithinPartitions("bucket", "class"), _meet(percent), "a long, b long"), "links")
    if not open_.filter("large").limit(1).count():
        return links
    members = write_out(open_.filter("large").select("class", "root").distinct(), "large")
    large = write_out(small(members, 24).join(sets, "class"), "large")
    pairs = write_out(_by_shingles(large, percent), "pairs")
    ends = write_out(pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct(), "ends")
    return links.union(_verified(pairs, sets.join(small(ends, 16), "class", "left_semi"), percent))


def near_classes(docs: DataFrame, width: int, percent: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """docs (doc_id not null, row, text) -> (doc_id, row, class, n_shingles) of each row, and (class, component_id, root, size) of each class."""
    members = write_out(map_batches(docs, _classes(width, bands, rows), CLASS), "near-classes")
    classes = write_out(members.filter("class IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("size"), F.first("n_shingles").alias("n"),
        F.first("left").alias("left"), F.first("right").alias("right"), F.first("sketch").alias("sketch")), "classes")
    # Groups of near copies, by the ends of buckets.
    pairs = write_out(_pivot_pairs(classes, percent), "pairs")
    seen = write_out(pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct(), "seen")
    sets = _sets_of(docs, classes, seen, width)
    found = _verified(pairs, sets, percent)
    roots = _merged(None, found) if found.limit(1).count() else None
    # What is left in the buckets of all tables.
    rooted = classes.join(small(roots, 32), "class", "left") if roots is not None else classes.withColumn("root", F.lit(None).cast("long"))
    open_ = write_out(_buckets(rooted.withColumn("root", F.coalesce("root", "class"))), "open")
    open_ = write_out(_may_differ(open_, classes, percent), "open")
    more = write_out(open_.select("class").distinct().join(small(seen, 16), "class", "left_anti"), "more")
    links = _links(open_, sets.union(_sets_of(docs, classes, more, width)), percent)
    if links.limit(1).count():
        roots = _merged(roots, links)
    if roots is None:
        groups = classes.select("class", F.col("first_id").alias("component_id"), F.col("class").alias("root"), "size")
    else:
        linked = classes.select("class", "first_id", "size").join(small(roots, 32), "class", "left")
        lowest = linked.filter("root IS NOT NULL").groupBy("root").agg(F.min("first_id").alias("least"))
        lowest = small(write_out(lowest, "lowest"), 32)
        groups = linked.join(lowest, "root", "left").select("class", F.coalesce("least", "first_id").alias("component_id"), F.coalesce("root", "class").alias("root"), "size")
    return members.select("doc_id", "row", "class", "n_shingles"), write_out(groups, "components")


def near_dedup(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest linked id), kept (the smallest itself).

    Words are runs of characters other than space and \\x09 to \\x0D, A-Z folded; a text's set is its distinct shingles of
    ``width`` words, or all its words as one shingle when they are fewer.  Two texts are linked when the sets' common part is
    at least ``percent`` hundredths of their union.  Texts without words (null, empty, blank) are linked with nothing.  Rows
    that repeat an id are kept or dropped together; rows without id stand alone and stay, with no component.  Other columns
    are not read; an empty table gives an empty result.  Classes are told apart by 64 bits.
    """
    judged = _judged(docs, width, percent, bands, rows, id_col, text_col)
    return judged.select("doc_id", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, width: int, percent: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """What ``near_dedup`` returns, with a hash of the text as ``row`` and the component's number as ``root`` (null: linked with nothing)."""
    text = F.col(text_col).cast("string")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    members, groups = near_classes(own.filter("doc_id IS NOT NULL"), width, percent, bands, rows)
    total = max(members.count(), 1)
    linked = join_groups(members.filter("class IS NOT NULL"), groups, "class", "size", total).select("doc_id", "row", "root", "n_shingles", "component_id")
    none = F.lit(None).cast("long")
    empty = members.filter("class IS NULL").select("doc_id", "row", none.alias("root"), "n_shingles", F.col("doc_id").alias("component_id"))
    strays = map_batches(own.filter("doc_id IS NULL"), _classes(width, 1, 1), CLASS).select(
        "doc_id", "row", none.alias("root"), "n_shingles", none.alias("component_id"))
    every = linked.unionByName(empty).unionByName(strays)
    return every.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_near_copies(docs: DataFrame, width: int = 5, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, with all its columns, and all rows that have none.

    Of a group the smallest id stays; where several of its rows have that id, the one whose text has the smallest hash, and
    any one of rows alike in id and text.  Another text under the id of a near copy is judged for itself.  Rows without id and
    texts without words (null, empty, blank) stay, repeated or not.  An empty table gives an empty result.
    """
    judged = write_out(_judged(docs, width, percent, bands, rows, id_col, text_col), "judged")
    stays = judged.filter("kept AND root IS NOT NULL")
    repeated = stays.groupBy("root").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "row")).alias("best")).filter("n > 1")
    repeated = write_out(repeated.select("root", F.col("best.doc_id").alias("doc_id"), F.col("best.row").alias("best")), "repeated")
    others = stays.join(small(repeated.select("root", "best"), 32), "root").filter("row <> best")
    gone = write_out(judged.filter("not kept").select("doc_id", "row").union(others.select("doc_id", "row")).distinct(), "near-copies")
    names = docs.columns
    mark = "_" * (1 + max(len(c) for c in names))  # no column has this name or one that begins with it
    doc, row = f"{mark}doc", f"{mark}row"
    keys = docs.select("*", F.col(id_col).cast("long").alias(doc), F.xxhash64(F.col(text_col).cast("string")).alias(row))
    keys = keys.join(small(gone.toDF(doc, row), 48), [doc, row], "left_anti")
    if repeated.limit(1).count():
        again = small(repeated.select(F.col("doc_id").alias(doc), F.col("best").alias(row)), 48)
        keys = keys.join(again, [doc, row], "left_anti").unionByName(keys.join(again, [doc, row], "left_semi").dropDuplicates([doc, row]))
    return keys.select(*names)
