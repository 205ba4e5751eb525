"""N-gram Jaccard self-join by partitioning the shingle universe.

A document is its set of distinct word shingles. Two sets link when
``100 * intersection >= percent * union``, so a linked pair of sizes up to u
differs in at most H = floor(2u (100 - percent) / (100 + percent)) shingles.
Shingles are hashed into m segments (m from the size band's H):

* exact allocation: m = H + 1 + x. At most H segments differ, so a linked pair
  agrees on at least x + 1 segments; each set indexes its segments of at least c
  shingles (smaller ones select little), and a set with more than x smaller ones
  (which could agree with another on such segments only) indexes the deletion
  allocation as well;
* deletion allocation: m = ceil((H + 1) / 2). One segment differs by one shingle
  at most; each set indexes every segment and its one-deletion neighbourhood,
  and a pair matches when at least one side matches undeleted.

A set indexes itself under its own size band and under the next ones that a
linked larger set can fall into. Which allocation, x and c a band takes is
the cheapest by a cost model fed by counts over all documents; the choice
changes cost only, both are complete. Candidates are verified on the words.

Equal word sequences are one class before anything is indexed. Buckets are not
expanded into pairs: each class first checks one partner (its sketch, then the text
if that is near), and links found so far settle most buckets. Classes of buckets that still span several labels are
clustered by shared buckets. Each cluster is compared as a whole, or bucket by bucket
(equal ones once) where that takes fewer rows: weak candidates chain most documents
into one cluster, whose blocks would meet in a number that grows with its square.
What has more than a block of classes is compared in tasks of two blocks by size and
hash. A task gets parity sketches, a few bits a shingle, which differ in no more bits
than the sets do in shingles. What near ones of other labels connect is a cluster again,
of documents much alike, whose texts are compared, and spanning links come back. So
every candidate pair is connected already, refuted by its sketches or compared, and
none is listed.

Defined results: null and empty texts and texts without words have no shingles,
link with nothing and are their own component; rows with a null id have a null
component and take no part; rows that share an id are one document with several
texts; repeated rows give repeated rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haze.llm.common import fresh, words, written
from haze.llm.components import components

_BAND_RATIO = 1.4
_SAMPLED = 1 << 10  # one shingle hash in so many is counted over all documents, for the cost model
_PART_KEYS = 2_000_000  # signatures that one reduce partition gets
_SLICE_KEYS = 300_000  # signatures that a map task holds at a time
_SORTED_KEYS = 500_000  # signatures of a part that are unpacked and sorted at a time, about
_HOT = 16  # a signature that so many sets of one slice share skips the shuffle
_CHUNKS = 256  # chunks over which the partners of one class are dealt
_BLOCK = 1024  # classes of a block, and
_BLOCK_SHINGLES = 500_000  # their shingles; two blocks meet in a task
_BUCKET_ROWS = 4  # rows of buckets that cost as much as one of a cluster's tasks, which meets whole blocks
_U = np.uint64
_C1, _C2, _C3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


# -- shingles ----------------------------------------------------------------

def word_hashes(ws: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), _U, len(ws))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _C2
    x = (x ^ (x >> _U(27))) * _C3
    return x ^ (x >> _U(31))


def shingle_hashes(ws: list[bytes], n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles (fewer words: one
    shingle, the whole sequence; no words: none)."""
    if not ws:
        return np.empty(0, _U)
    h = word_hashes(ws)
    k = min(n, len(ws))
    acc = np.full(len(ws) - k + 1, k, _U)
    for j in range(k):
        acc = acc * _C1 + h[j:len(ws) - k + 1 + j]
    return np.unique(mix(acc))


def shingle_set(ws: list[bytes], n: int) -> set:
    if len(ws) < n:
        return {tuple(ws)} if ws else set()
    return set(zip(*(ws[i:] for i in range(n))))


# -- size bands and allocations ----------------------------------------------

def max_difference(u: int, percent: int) -> int:
    return 2 * u * (100 - percent) // (100 + percent)


def band_edges(largest: int, percent: int) -> list[int]:
    """Lower ends of the size bands that cover 1..largest (and one more)."""
    edges = [1]
    while edges[-1] <= largest:
        lo = edges[-1]
        h = max_difference(lo, percent)
        same = ((h + 1) * (100 + percent) - 1) // (2 * (100 - percent)) if percent < 100 else lo
        edges.append(max(int(lo * _BAND_RATIO), same, lo) + 1)
    return edges


class Allocation:
    """Segments of one size band. deletions: one-deletion neighbourhoods are the
    main index; else ``segments`` exact segments, of which ``spare`` (x) are
    beyond H + 1, indexed if they have ``least`` (c) shingles. coarse: segments of
    the deletion allocation."""

    def __init__(self, h: int, deletions: bool, spare: int, least: int = 1):
        self.deletions, self.spare, self.least = deletions, spare, least
        self.segments, self.coarse = h + 1 + spare, (h + 2) // 2


def allocate(u: int, percent: int, sets: float, mean_size: float, overlap: float) -> Allocation:
    """The cheapest allocation for a band of ``sets`` sets of mean_size shingles,
    if a shingle of one set is in another with probability ``overlap``. Costs are
    in signature rows; comparing two sets costs about as much as 50 rows."""
    h = max_difference(u, percent)
    size = max(mean_size, 1.0)

    def poisson(mean: float, upto: int) -> list[float]:
        terms = [math.exp(-mean)]
        for i in range(1, upto + 1):
            terms.append(terms[-1] * mean / i)
        return terms

    q, compared = min(1.0, overlap), 50 * sets
    coarse = (h + 2) // 2
    best = (size + coarse + coarse * compared * q ** max(size / coarse - 1, 0), True, 0, 1)
    for least in (1, 2, 3):
        for spare in [0, 1, 2, 3, 4, 6, 8] + [int(10 * 1.3 ** k) for k in range(20)]:
            m = h + 1 + spare
            if spare > 4 * h + 8:
                break
            sizes = poisson(size / m, 60)  # shingles of a segment
            small = m * sum(sizes[:least])
            deep = 1.0 if small > spare + 1 else max(0.0, 1 - sum(poisson(small, spare)))  # more than `spare` small segments
            agree = sum(p * q ** k for k, p in enumerate(sizes) if k >= least)
            rows = m - small + deep * (size + coarse) + m * compared * agree
            best = min(best, (rows, False, spare, least))
    return Allocation(h, *best[1:])


def set_signatures(shingles: np.ndarray, edges: list[int], plan: list[Allocation], percent: int) -> np.ndarray:
    """Signatures (int64) of one set; the lowest bit marks a deletion."""
    size = len(shingles)
    first = int(np.searchsorted(edges, size, "right")) - 1
    last = int(np.searchsorted(edges, size * 100 // percent, "right")) - 1
    out = []
    for band in range(first, min(last, len(plan) - 1) + 1):
        a = plan[band]
        deep = a.deletions
        if not deep:
            sums, counts = _segment_sums(shingles, a.segments)
            full = np.flatnonzero(counts >= a.least)
            out.append(_keys(sums[full], full, band, 0))
            deep = a.segments - len(full) > a.spare
        if deep:
            sums, _ = _segment_sums(shingles, a.coarse)
            every = np.arange(a.coarse)
            out.append(_keys(sums, every, band, 1))
            at = (shingles % _U(a.coarse)).astype(np.int64)
            out.append(_keys(sums[at] - mix(shingles + _C1), at, band, 1) | _U(1))
    return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)


def _segment_sums(shingles: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Per segment the sum of its shingles' hashes (the same for the same set) and their count."""
    at = (shingles % _U(m)).astype(np.int64)
    counts = np.bincount(at, minlength=m)
    order = np.argsort(at, kind="stable")
    ends = np.concatenate(([np.uint64(0)], np.cumsum(mix(shingles + _C1)[order])))
    stops = np.cumsum(counts)
    return ends[stops] - ends[stops - counts], counts


def _keys(sums: np.ndarray, segment: np.ndarray, band: int, kind: int) -> np.ndarray:
    salt = mix(segment.astype(_U) * _C1 + _U(band * 2 + kind + 1) * _C2)
    return mix(sums * _C3 + salt) & ~_U(1)


# -- passes over the documents -----------------------------------------------

_SETS = "id long, class binary, node long, n_shingles long, sampled array<long>, sketch binary"


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of a set's shingles, dealt over two to four times as many bits as it has
    shingles (a power of two). Sketches of two sets differ in at most as many bits as the
    sets do in shingles, also after ``folded``."""
    bits = max(64, 1 << (2 * len(shingles) - 1).bit_length()) if len(shingles) else 64
    return np.packbits(np.bincount((shingles % _U(bits)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Rows of bits, folded to a smaller power of two by exclusive or."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _classes(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ws = words(text)
                digest = hashlib.blake2b(b" ".join(ws), digest_size=16).digest()
                with np.errstate(over="ignore"):
                    sh = shingle_hashes(ws, n)
                rows.append((i, digest, int.from_bytes(digest[:8], "little", signed=True), len(sh),
                             sh[(sh >> _U(40)) % _U(_SAMPLED) == 0].view(np.int64).tolist(), sketch(sh)))
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int64(), pa.int64(),
                                                       pa.list_(pa.int64()), pa.binary()))],
                names=["id", "class", "node", "n_shingles", "sampled", "sketch"])
    return run


_PACKED = "deal int, part int, keys binary, nodes binary, runs binary, hot boolean"
_KEY_BYTES = 5  # of a signature travel; with the partition's number they tell a partition's keys apart


def _packed(keys: np.ndarray) -> bytes:
    return keys.view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES].tobytes()


def _unpacked(data: bytes | pa.Buffer) -> np.ndarray:
    out = np.zeros((len(data) // _KEY_BYTES, 8), np.uint8)
    out[:, :_KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, _KEY_BYTES)
    return out.reshape(-1).view(np.int64)


def _signatures(n: int, percent: int, edges: list[int], plan: list[Allocation], parts: int):
    """Packed signatures of each slice, one row per reduce partition: 5 bytes a key,
    sorted by class, and the classes with their numbers of keys. A class is indexed
    once per batch. Signatures that many sets of the slice share go past the reduce
    partition (a row of their own, dealt at random) but for a few."""

    def pack(keys, nodes, hot):
        part = (keys.view(_U) >> _U(1)) % _U(parts)
        order = np.lexsort((nodes, part))
        part, keys, nodes = part[order], keys[order], nodes[order]
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        for a, b in zip(cuts[:-1], cuts[1:]):
            starts = np.flatnonzero(np.concatenate(([True], nodes[a + 1:b] != nodes[a:b - 1])))
            runs = np.diff(np.concatenate((starts, [b - a]))).astype(np.uint16 if b - a < 1 << 16 else np.uint32)
            own = int(part[a])
            yield zlib.crc32(nodes[a:b].tobytes()) % parts if hot else own, own, _packed(keys[a:b]), nodes[a:b][starts].tobytes(), runs.tobytes(), hot

    def sliced(keys, nodes) -> pa.RecordBatch:
        keys, nodes = np.concatenate(keys), np.concatenate(nodes)
        order = np.argsort(keys, kind="stable")  # the deletion mark is the lowest bit: undeleted rows come first
        keys, nodes = keys[order], nodes[order]
        bare = keys >> 1
        starts = np.flatnonzero(np.concatenate(([True], bare[1:] != bare[:-1])))
        counts = np.diff(np.concatenate((starts, [len(keys)])))
        extra = np.arange(len(keys)) - np.repeat(starts, counts) >= _HOT
        rows = list(pack(keys[~extra], nodes[~extra], False))
        if extra.any():
            rows += list(pack(keys[extra], nodes[extra], True))
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()))],
            names=["deal", "part", "keys", "nodes", "runs", "hot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, keys, nodes, held = set(), [], [], 0
            for i, text in zip(*(batch.column(k) for k in range(2))):
                ws = words(text.as_py())
                i = i.as_py()
                if i is None or not ws:
                    continue
                node = int.from_bytes(hashlib.blake2b(b" ".join(ws), digest_size=16).digest()[:8], "little", signed=True)
                if node in seen:
                    continue
                seen.add(node)
                with np.errstate(over="ignore"):
                    keys.append(set_signatures(shingle_hashes(ws, n), edges, plan, percent))
                nodes.append(np.full(len(keys[-1]), node, np.int64))
                held += len(keys[-1])
                if held >= _SLICE_KEYS:
                    yield sliced(keys, nodes)
                    keys, nodes, held = [], [], 0
            if keys:
                yield sliced(keys, nodes)
    return run


_LIVE = "key long, deleted boolean, node long"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signature rows whose bucket has two classes and an undeleted row at least. A task
    holds its rows packed; of a part's keys, one range after another is unpacked."""

    def out(part, keys, nodes):
        with np.errstate(over="ignore"):
            bucket = (mix((keys >> 1).view(_U) + np.full(1, part, _U) * _C1) >> _U(1)).view(np.int64)
        for i in range(0, len(keys), 100_000):
            k = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[k]), pa.array((keys[k] & 1) == 1), pa.array(nodes[k])], names=["key", "deleted", "node"])

    def unpacked(k, v, runs):
        nodes = np.frombuffer(v, np.int64)
        return _unpacked(k), np.repeat(nodes, np.frombuffer(runs, np.uint16 if len(runs) == 2 * len(nodes) else np.uint32))

    def within(pieces, bits, at):
        """The keys with these leading bits, and their classes."""
        for piece in pieces:
            keys, nodes = unpacked(*piece)
            here = keys >> (8 * _KEY_BYTES - bits) == at
            yield keys[here], nodes[here]

    found: dict[int, list] = {}
    for batch in batches:
        for part, *data, hot in zip(*(batch.column(c) for c in range(1, 6))):
            part, data = part.as_py(), [x.as_buffer() for x in data]
            if hot.as_py():
                yield from out(part, *unpacked(*data))
            else:
                found.setdefault(part, []).append(data)
    for own in sorted(found):  # a task may have several parts: one at a time
        pieces = found.pop(own)
        bits = (sum(len(k) for k, _, _ in pieces) // (_KEY_BYTES * _SORTED_KEYS)).bit_length()
        for at in range(1 << bits):
            keys, nodes = (np.concatenate(c) for c in zip(*within(pieces, bits, at)))
            if not len(keys):
                continue
            order = np.argsort(keys >> 1)
            keys, nodes = keys[order], nodes[order]
            bare = keys >> 1
            starts = np.flatnonzero(np.concatenate(([True], bare[1:] != bare[:-1])))
            live = ((np.minimum.reduceat(nodes, starts) != np.maximum.reduceat(nodes, starts))
                    & (np.add.reduceat((keys & 1) == 0, starts, dtype=np.int64) > 0))
            m = np.repeat(live, np.diff(np.concatenate((starts, [len(keys)]))))
            yield from out(own, keys[m], nodes[m])


# -- verification ------------------------------------------------------------

def _linked(a: set, b: set, percent: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = len(a & b)
    return 100 * both >= percent * (small + large - both)


def _compare(n: int, percent: int):
    """Streams rows sorted by (centre, chunk), the centre's texts first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, sets = None, []
        for batch in batches:
            got = []
            for c, chunk, member, i, text in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if (c, chunk) != centre:
                    centre, sets = (c, chunk), []
                mine = shingle_set(words(text), n)
                if not member:
                    sets.append(mine)
                elif any(_linked(mine, other, percent) for other in sets):
                    got.append((i, c))
            yield _pairs(got)
    return run


def _pairs(got: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in got], pa.int64()), pa.array([b for _, b in got], pa.int64())],
                                      names=["a", "b"])


def _near_sketch(a: tuple[int, bytes], b: tuple[int, bytes], percent: int) -> bool:
    """Whether two sets (n_shingles, sketch) may be linked, as in ``near_groups``."""
    (one, x), (two, y) = sorted((a, b), key=lambda s: len(s[1]))
    if 100 * min(one, two) < percent * max(one, two):
        return False
    bits = np.frombuffer(y, np.uint8)
    while len(bits) > len(x):
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return int(np.bitwise_count(bits ^ np.frombuffer(x, np.uint8)).sum()) <= max_difference(one + two, percent) // 2


def _compare_sketches(percent: int):
    """Streams rows sorted by (centre, chunk), the centre's sketches first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, sets = None, []
        for batch in batches:
            got = []
            for c, chunk, member, i, *mine in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if (c, chunk) != centre:
                    centre, sets = (c, chunk), []
                if not member:
                    sets.append(mine)
                elif any(_near_sketch(mine, other, percent) for other in sets):
                    got.append((i, c))
            yield _pairs(got)
    return run


def _met(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """What ``sets`` (id, ...) has of ``pairs`` (a, b), sorted: the partners of a centre b are
    dealt over ``_CHUNKS`` chunks, each of which gets b's rows once, before them."""
    dealt = pairs.select("a", "b", F.pmod(F.xxhash64("a"), F.lit(_CHUNKS)).alias("chunk"))
    columns = [F.col("b").alias("centre"), "chunk", "member", *sets.columns]
    members = dealt.join(sets, F.col("a") == F.col("id")).withColumn("member", F.lit(1)).select(columns)
    centres = dealt.select("b", "chunk").distinct().join(sets, F.col("b") == F.col("id")).withColumn("member", F.lit(0)).select(columns)
    return members.union(centres).repartition("centre", "chunk").sortWithinPartitions("centre", "chunk", "member")


def _verified(pairs: DataFrame, texts: DataFrame, sketches: DataFrame, n: int, percent: int) -> DataFrame:
    """The linked ones of ``pairs`` (a, b): first their sketches meet, then the texts of near ones."""
    near = written(_met(pairs, sketches).mapInArrow(_compare_sketches(percent), "a long, b long").distinct(), "join-first")
    return _met(near, _texts_of(near.select(F.explode(F.array("a", "b")).alias("id")), texts)).mapInArrow(_compare(n, percent), "a long, b long")


def _texts_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, text) of some ids only. These are written first, so that Spark knows how many they are:
    where they are few, the other documents' texts are read but not shuffled."""
    return written(texts.join(written(ids.distinct(), "join-ids"), "id").select("id", "text").distinct(), "join-texts")


def block_links(members: list[tuple[int, str]], n: int, percent: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among (id, text) members: intersections by
    products of 0/1 matrices over slices of the shingles, links verified on the words."""
    with np.errstate(over="ignore"):
        hashes = [shingle_hashes(words(t), n) for _, t in members]
    sizes = np.array([len(h) for h in hashes], np.float64)
    _, column, seen = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(members)), sizes.astype(np.int64))
    shared = seen[column] > 1  # other shingles add to no intersection
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(members), len(members)), np.float32)
    width = 8192
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (lo, lo + width))
        m = np.zeros((len(members), width), np.float32)
        m[row[a:b], column[a:b] - lo] = 1
        both += m @ m.T
    near = np.triu(100.0 * both >= percent * (sizes[:, None] + sizes[None, :] - both), 1)
    parent = list(range(len(members)))

    def find(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i
    out, sets = [], {}
    for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
        x, y = find(i), find(j)
        if x != y:
            for k in (i, j):
                if k not in sets:
                    sets[k] = shingle_set(words(members[k][1]), n)
            if _linked(sets[i], sets[j], percent):
                parent[max(x, y)] = min(x, y)
                out.append((max(members[i][0], members[j][0]), min(members[i][0], members[j][0])))
    return out


def _blocks(n: int, percent: int):
    """Streams rows sorted by task; a task has about two blocks of members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, members = None, []
        for batch in batches:
            for key, i, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if key != task:
                    if len(members) > 1:
                        yield _pairs(block_links(members, n, percent))
                    task, members = key, []
                members.append((i, text))
        if len(members) > 1:
            yield _pairs(block_links(members, n, percent))
    return run


def near_sketches(members: list[tuple[int, int, int, bytes]], percent: int) -> set[int]:
    """Ids of the members that are in one of the ``near_groups``."""
    return {i for group in near_groups(members, percent) for i in group}


def near_groups(members: list[tuple[int, int, int, bytes]], percent: int) -> list[list[int]]:
    """Groups (sorted ids) of the (id, n_shingles, label, sketch) members, connected by those that
    may be linked to one of another label: sizes allow it, and the sketches differ in no more bits
    than linked sets do in shingles. No linked pair of two labels is missed."""
    by_width: dict[int, list] = {}
    for m in members:
        by_width.setdefault(8 * len(m[3]), []).append(m)
    parts = {}
    for width, group in by_width.items():
        bits = np.unpackbits(np.frombuffer(b"".join(m[3] for m in group), np.uint8).reshape(len(group), -1), axis=1)
        ids, sizes, labels = (np.array([m[k] for m in group], np.int64) for k in range(3))
        parts[width] = bits, ids, sizes, labels
    ones, others = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for low in sorted(parts):
        for high in sorted(w for w in parts if low <= w and percent * w <= 200 * low):
            a, b = parts[low], parts[high]
            x, y = a[0], folded(b[0], low)
            for top in range(0, len(x), 256):  # so many members against all of the other group
                rows = slice(top, top + 256)
                apart = np.zeros((len(x[rows]), len(y)), np.float32)
                for lo in range(0, low, 1024):
                    p, q = x[rows, lo:lo + 1024].astype(np.float32), y[:, lo:lo + 1024].astype(np.float32)
                    apart += p.sum(1)[:, None] + q.sum(1)[None, :] - 2 * (p @ q.T)
                one, two = a[2][rows, None], b[2][None, :]
                fits = 100 * np.minimum(one, two) >= percent * np.maximum(one, two)
                i, j = np.nonzero(fits & (apart <= (100 - percent) * (one + two) // (100 + percent)) & (a[3][rows, None] != b[3][None, :]))
                ones.append(a[1][rows][i])
                others.append(b[1][j])
    pairs = np.concatenate((*ones, *others))
    ids, at = np.unique(pairs, return_inverse=True)
    one, two = at[:len(at) // 2], at[len(at) // 2:]
    least, before = np.arange(len(ids)), None
    while before is None or (least != before).any():
        before, low = least.copy(), np.minimum(least[one], least[two])
        np.minimum.at(least, one, low)
        np.minimum.at(least, two, low)
        least = least[least]
    order = np.argsort(least, kind="stable")
    cuts = np.flatnonzero(np.diff(least[order])) + 1
    return [group.tolist() for group in np.split(ids[order], cuts) if len(group)]


def _near(percent: int):
    """Streams rows sorted by task, gives the ids of its ``near_groups``; a group is named by
    its ids, so that one of several tasks is the same."""

    def kept(members: list) -> pa.RecordBatch:
        names, ids = [], []
        for group in near_groups(members, percent):
            names += [hashlib.blake2b(np.array(group, np.int64).tobytes(), digest_size=16).hexdigest()] * len(group)
            ids += group
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(ids, pa.int64())], names=["task", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, members = None, []
        for batch in batches:
            for key, *member in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if key != task:
                    if len(members) > 1:
                        yield kept(members)
                    task, members = key, []
                members.append(tuple(member))
        if len(members) > 1:
            yield kept(members)
    return run


def _near_rows(clusters: DataFrame, sketches: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """(task, id): groups of members of a cluster (node, component: of any type) that may be linked
    to one of another label (known: node, label) by their sketches.

    A cluster of more than a block is cut by size class (linked sets are in
    the same or adjacent classes) and hash into blocks; every two blocks that can hold
    a linked pair meet in one task."""
    member = (clusters.join(sketches, F.col("node") == F.col("id"))
              .select(F.col("component").alias("cluster"), "id", "n_shingles", F.floor(F.log(F.col("n_shingles")) / math.log(100 / percent) + 1e-9
                                                                         if percent < 100 else F.col("n_shingles")).alias("k")).distinct())
    fill = F.count(F.lit(1)) / _BLOCK + F.sum("n_shingles") / _BLOCK_SHINGLES
    per_class = member.groupBy("cluster", "k").agg(fill.alias("fill"))
    shape = per_class.groupBy("cluster").agg(  # a set's size has few classes
        F.sum("fill").alias("total"), F.map_from_entries(F.collect_list(F.struct("k", F.ceil("fill")))).alias("blocks"))
    count = lambda k: F.coalesce(F.element_at("blocks", k), F.lit(0).cast("long"))
    place = lambda k: F.pmod(F.xxhash64("id"), F.greatest(count(k), F.lit(1)))
    others = lambda k: F.when(count(k) > 0, F.sequence(F.lit(0).cast("long"), count(k) - 1)).otherwise(F.array().cast("array<bigint>"))
    k = F.col("k")
    name = lambda *parts: F.concat_ws("/", F.col("cluster").cast("string"), *(p.cast("string") for p in parts))
    tasks = F.when(F.col("total") <= 1, F.array(name())).otherwise(F.concat(
        F.transform(others(k), lambda o: name(k, F.least(o, place(k)), k, F.greatest(o, place(k)))),
        F.transform(others(k - 1), lambda o: name(k - 1, o, k, place(k))),
        F.transform(others(k + 1), lambda o: name(k, place(k), k + 1, o))))
    dealt = member.join(shape, "cluster").select("id", "n_shingles", F.explode(tasks).alias("task"))
    labelled = dealt.join(known, dealt.id == known.node, "left").select("task", "id", "n_shingles", F.coalesce("label", "id").alias("label"))
    return (labelled.join(sketches, ["id", "n_shingles"]).select("task", "id", "n_shingles", "label", "sketch")
            .repartition("task").sortWithinPartitions("task", "id").mapInArrow(_near(percent), "task string, id long").distinct())


def _cluster_links(clusters: DataFrame, texts: DataFrame, sketches: DataFrame, known: DataFrame, n: int, percent: int) -> DataFrame:
    """Links that connect what is connected within each cluster: first sketches, then the texts of what
    these leave. Tasks return spanning links, not pairs."""
    near = written(_near_rows(clusters, sketches, known, percent), "join-near")
    stars = near.join(near.groupBy("task").agg(F.min("id").alias("least")), "task").select(F.col("id").alias("a"), F.col("least").alias("b"))
    alike = written(_near_rows(components(stars.filter("a <> b").distinct()), sketches, known, percent), "join-alike")
    rows = (alike.join(_texts_of(alike.select("id"), texts), "id").select("task", "id", "text")
            .repartition("task").sortWithinPartitions("task", "id"))
    return rows.mapInArrow(_blocks(n, percent), "a long, b long")


def _labels(links: DataFrame) -> DataFrame:
    """(node, label): each node's smallest partner, followed four steps. Equal labels are connected."""
    step = links.filter("a <> b").groupBy(F.greatest("a", "b").alias("node")).agg(F.min(F.least("a", "b")).alias("label"))
    for _ in range(2):
        on = step.select(F.col("node").alias("next"), F.col("label").alias("further"))
        step = step.join(on, F.col("label") == F.col("next"), "left").select("node", F.coalesce("further", "label").alias("label"))
    return written(step, "join-labels")


def _links(live: DataFrame, texts: DataFrame, sketches: DataFrame, given: DataFrame, n: int, percent: int) -> DataFrame:
    """Verified links (a, b) that connect all that is connected. given: links known beforehand."""
    first = (live.groupBy("key").agg(F.min(F.when(~F.col("deleted"), F.col("rep"))).alias("c"))
             .join(live, "key").filter("rep <> c").groupBy("rep").agg(F.min("c").alias("c"))
             .select(F.greatest("rep", "c").alias("a"), F.least("rep", "c").alias("b")).distinct())
    links = written(_verified(first, texts, sketches, n, percent).union(given), "join-links")
    known = _labels(links)
    state = (live.join(known, live.rep == known.node, "left")
             .select("key", "deleted", "rep", F.coalesce("label", "rep").alias("label")))
    spread = (state.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("rep").alias("least"))
              .filter("lo <> hi").select("key", "least"))
    rest = written(state.join(spread, "key").select("key", "rep", "least").distinct(), "join-rest")
    return links.union(written(_cluster_links(_candidates(rest), texts, sketches, known, n, percent), "join-links"))


def _candidates(rest: DataFrame) -> DataFrame:
    """What is compared: (node, component), the clusters of the buckets ``rest`` (key, rep, least), or
    the distinct buckets of a cluster where these have fewer rows than its tasks would get."""
    clusters = written(components(rest.filter("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b")).distinct()), "join-clusters")
    members = F.count(F.lit(1))
    hashed = [F.sum(F.xxhash64(F.lit(salt), "rep").cast("decimal(38,0)")).alias(f"h{salt}") for salt in (0, 1)]
    buckets = rest.groupBy("key", "least").agg(members.alias("n"), *hashed).groupBy("least", "n", "h0", "h1").agg(F.min("key").alias("key"))
    buckets = buckets.join(clusters, F.col("least") == F.col("node")).select("key", "n", "component")
    blocks = lambda n: F.ceil(n / _BLOCK)
    by_bucket = buckets.groupBy("component").agg(F.sum(F.col("n") * blocks(F.col("n"))).alias("rows"))
    whole = clusters.groupBy("component").agg(members.alias("n"))
    split = (whole.filter(F.col("n") > _BLOCK).join(by_bucket, "component")
             .filter(F.col("rows") < _BUCKET_ROWS * F.col("n") * blocks(F.col("n"))).select("component"))
    split = written(split, "join-split")
    name = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string")).alias("component")
    return (clusters.join(split, "component", "left_anti").select("node", name("c", "component"))
            .union(rest.join(buckets.join(split, "component", "left_semi").select("key"), "key").select(F.col("rep").alias("node"), name("b", "key"))))


# -- the operator ------------------------------------------------------------

def jaccard_components(docs: DataFrame, shingle: int = 5, percent: int = 80,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component) for every row of ``docs``."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = written(plain.mapInArrow(_classes(shingle), _SETS), "join-sets")
    whole = sets.filter("n_shingles > 0 and id is not null")
    classes = whole.groupBy("class", "node").agg(F.min("id").alias("rep"), F.max("n_shingles").alias("n_shingles"))

    largest = whole.agg(F.max("n_shingles")).first()[0]
    if largest is None:
        return sets.select("id", "n_shingles", F.col("id").alias("component"))
    edges = band_edges(largest * 100 // percent, percent)
    plan, expected = _plan(whole, edges, percent)
    parts = max(1, math.ceil(expected / _PART_KEYS))
    packed = plain.mapInArrow(_signatures(shingle, percent, edges, plan, parts), _PACKED)
    live = packed.repartition(max(parts, 2), "deal").mapInArrow(_shared, _LIVE)
    live = written(live.join(classes.select("node", "rep"), "node").select("key", "deleted", "rep").distinct(), "join-live")
    involved = live.select("rep").distinct().join(classes, "rep").select(F.col("rep").alias("id"), "n_shingles").distinct()

    ids = whole.join(classes.select("class", "rep"), "class").select("id", "rep")
    same = ids.groupBy("id").agg(F.min("rep").alias("b"), F.max("rep").alias("a")).filter("a <> b")  # ids with several texts
    same = ids.join(same.select("id", "b"), "id").filter("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    sketches = written(whole.join(involved, ["id", "n_shingles"]).select("id", "n_shingles", "sketch").distinct(), "join-sketches")
    found = components(_links(live, plain, sketches, same, shingle, percent))
    named = classes.join(found, classes.rep == found.node, "left").select("class", F.coalesce("component", "rep").alias("component"))
    return (sets.join(named, "class", "left")
            .select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component")))


def _plan(sets: DataFrame, edges: list[int], percent: int) -> tuple[list[Allocation], float]:
    """Allocations by band, and the expected number of signatures, from counts over all documents."""
    band = F.array_size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= F.col("n_shingles"))) - 1
    counted = {r.band: (r.n, r.size) for r in sets.groupBy(band.alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("n_shingles").alias("size")).collect()}  # a row per band
    df = sets.select(F.explode("sampled").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    total, twice = df.agg(F.sum("df"), F.sum(F.col("df") * (F.col("df") - 1))).first()
    everything = sum(n for n, _ in counted.values())
    overlap = (twice or 0) / ((total or 1) * max(everything, 1))
    plan, expected = [], 0.0
    for k in range(len(edges) - 1):
        near = [counted[j] for j in (k - 1, k) if j in counted]
        n, size = sum(x for x, _ in near), (counted.get(k) or (near or [(0, float(edges[k]))])[0])[1]
        plan.append(allocate(edges[k + 1] - 1, percent, n, size, overlap))
        expected += n * ((size + plan[-1].coarse) if plan[-1].deletions else plan[-1].segments)
    return plan, expected


def join_report(docs: DataFrame, shingle: int = 3, percent: int = 90) -> DataFrame:
    return jaccard_components(docs, shingle, percent).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def drop_near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, the smallest doc_id; same columns.
    Rows without a doc_id or without words stay; rows that share a doc_id stay together."""
    found = jaccard_components(docs, shingle, percent)
    lost = fresh("lost_id", docs.columns)
    gone = written(found.filter("id <> component").select(F.col("id").alias(lost)).distinct(), "join-gone")
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(lost), "left_anti").select(docs.columns)
