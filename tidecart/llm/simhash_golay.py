"""SimHash near-duplicates found through Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits (the last padded to 23). The perfect Golay
code puts every 23-bit word within 3 bits of one of 4,096 codewords. A segment's keys are the indices of all
codewords within 4 bits (one or six of them): two segments that differ in at most 2 bits always share a key,
because the codeword of a word between them is within 4 bits of both.

At most 4 differing bits fall on three segments in one of two ways:
* every segment has at most 2 of them: the fingerprints share a (key, key, key) triple;
* one segment has 3 or 4: of the other two, one is equal and one differs by at most 1 bit, so the
  fingerprints share an (equal segment, key) pair.
So equal keys find every link, and each candidate is verified on the whole fingerprint.

Keys are made for distinct fingerprints only. Within a key's run, links are searched breadth-first: each
fingerprint is compared with those not reached yet, so a dense group costs about one pass and gives a star
instead of all its pairs, and no connection is lost. Components are joined by alternating large-star and
small-star rounds, each cut by a checkpoint.

Defined cases: null or blank texts have fingerprint 0, which links like any other; texts of fewer words than
a shingle are one shingle; repeated shingles count each time. A component's id is its smallest doc_id; null
ids are ignored in the minimum. Repeated rows, empty tables and extra columns need no care.
"""

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from .exact_dedup import sha256
from .texts import cut, record, slices, spare, text_or_empty, texts_of

SEED, RADIUS = 42, 4
WIDTHS = (23, 23, 18)
#: Generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
_KEYS_IN_SLICE = 20_000
_BUCKET_BYTES = 4 << 20
#: Mean number of 16-byte entries for a fingerprint, measured on random fingerprints.
_ENTRIES = 181


def fingerprint(data, shingle_words=4):
    """SimHash of UTF-8 bytes: A-Z lower-cased, ASCII white space separates words."""
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle_words, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0] + ends[:-1]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[size - 1:])], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(shingle_words, digest):
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())] + [("digest", pa.binary())] * digest)

    def run(batches):
        for batch in slices(batches):
            texts = [t.as_buffer().to_pybytes() for t in texts_of(batch).cast(pa.binary())]
            found = [fingerprint(t, shingle_words) for t in texts]
            yield record(schema, batch.column(0), np.array(found, dtype=np.uint64).view(np.int64),
                         *[[sha256(t) for t in texts]] * digest)
    return run


def fingerprints(docs, shingle_words=4, id_column="doc_id", text_column="text", digest=False):
    """doc_id and fp (the 64 bits as a signed long) of every row, and on request the SHA-256 of its text."""
    return (docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
            .mapInArrow(_fingerprints(shingle_words, digest), "doc_id long, fp long" + ", digest binary" * digest))


class Golay:
    """Index of the codeword within 3 bits, for every 23-bit word."""

    def __init__(self):
        messages = np.arange(4096, dtype=np.int64)
        words = np.zeros(4096, dtype=np.int64)
        for i in range(12):
            words ^= np.where(messages >> i & 1, GENERATOR << i, 0)
        self.codewords = words
        self.index = np.full(1 << 23, -1, dtype=np.int16)
        for weight in range(4):
            for places in combinations(range(23), weight):
                self.index[words ^ sum(1 << p for p in places)] = messages
        assert self.index.min() >= 0

    def keys(self, segment, width):
        """Indices of the codewords within 4 bits: rows of six, missing ones -1."""
        near = np.stack([self.index[segment]] + [self.index[segment ^ (1 << i)] for i in range(width)], axis=1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near.sort(axis=1)
        return near[:, -6:].astype(np.int64)


def keys_of(code, fps):
    """(key, position of its fingerprint) for all keys of all fingerprints (uint64 array)."""
    cuts = np.cumsum((0,) + WIDTHS)
    parts = [((fps >> np.uint64(a)) & np.uint64((1 << w) - 1)).astype(np.int64) for a, w in zip(cuts, WIDTHS)]
    near = [code.keys(p, w) for p, w in zip(parts, WIDTHS)]
    a, b, c = near[0][:, :, None, None], near[1][:, None, :, None], near[2][:, None, None, :]
    triple = ((a << 24) | (b << 12) | c).reshape(len(fps), -1)
    real = ((a >= 0) & (b >= 0) & (c >= 0)).reshape(len(fps), -1)
    keys, owners = [triple[real]], [np.nonzero(real)[0]]
    for family, (exact, fuzzy) in enumerate(((0, 1), (1, 0), (0, 2), (2, 0), (1, 2), (2, 1)), start=1):
        pair = (family << 36) | (parts[exact][:, None] << 12) | near[fuzzy]
        real = near[fuzzy] >= 0
        keys.append(pair[real])
        owners.append(np.nonzero(real)[0])
    return np.concatenate(keys), np.concatenate(owners)


def _mixed(keys):
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)


def _dealt_keys(buckets):
    schema = pa.schema([("bucket", pa.int32()), ("entries", pa.binary())])

    def run(batches):
        code = Golay()
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            for begin in range(0, len(every), _KEYS_IN_SLICE):
                fps = every[begin:begin + _KEYS_IN_SLICE]
                keys, owners = keys_of(code, fps)
                bucket = (_mixed(keys) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                entries = np.stack([keys[order].view(np.uint64), fps[owners[order]]], axis=1)
                bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
                filled = np.flatnonzero(np.diff(bounds))
                yield record(schema, filled.astype(np.int32), [entries[bounds[k]:bounds[k + 1]].tobytes() for k in filled])
    return run


def reach(fps, radius):
    """Star links (centre, member) that connect what links within ``radius`` connect among ``fps``."""
    rest, links = np.unique(fps), []
    while len(rest):
        centre, rest = rest[0], rest[1:]
        frontier = [centre]
        while frontier and len(rest):
            near = np.bitwise_count(rest ^ frontier.pop()) <= radius
            if near.any():
                found = rest[near]
                links.append(np.stack([np.full(len(found), centre), found], axis=1))
                frontier.extend(found)
                rest = rest[~near]
    return links


def links_of(keys, fps, radius=RADIUS):
    """Verified links among fingerprints with equal keys: array of (smaller, larger) rows."""
    order = np.lexsort((fps, keys))
    keys, fps = keys[order], fps[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(starts, len(keys)))
    two = starts[sizes == 2]
    pairs = np.stack([fps[two], fps[two + 1]], axis=1)
    links = [pairs[np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= radius]]
    seen = set()
    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        run = fps[start:start + size]
        mark = run.tobytes() if size < 64 else xxhash.xxh128_digest(run.tobytes())
        if mark not in seen:  # the same members under another key give the same links
            seen.add(mark)
            links += reach(run, radius)
    return np.unique(np.concatenate(links), axis=0)


def _linked(radius):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(group):
        entries = np.frombuffer(b"".join(group.column("entries").to_pylist()), dtype=np.uint64).reshape(-1, 2)
        links = links_of(entries[:, 0], entries[:, 1], radius).view(np.int64)
        return pa.Table.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], schema=schema)
    return run


def links(distinct, radius=RADIUS):
    """Links (a, b) between distinct fingerprints (column fp) that connect all that differ by ``radius`` bits or less."""
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"the keys guarantee up to {RADIUS} differing bits")
    number = distinct.count()
    buckets = max(1, -(-number * _ENTRIES * 16 // _BUCKET_BYTES))
    dealt = (distinct.repartition(max(1, -(-number // _KEYS_IN_SLICE)), "fp")
             .mapInArrow(_dealt_keys(buckets), "bucket int, entries binary"))
    return (dealt.repartition(max(1, -(-buckets // 5)), "bucket").groupBy("bucket").applyInArrow(_linked(radius), "a long, b long")
            .distinct())


def components(edges):
    """node and root (smallest node reachable) of all nodes in ``edges`` (a, b)."""
    edges, before = cut(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
                        .filter("u < v").distinct()), None
    while True:
        # Large star: larger neighbours of a node move to the smallest node it knows.
        both = edges.union(edges.select("u", "v"))
        least = both.groupBy("v").agg(F.min("u").alias("low")).select(
            F.col("v").alias("n"), F.least("v", "low").alias("low"))
        large = both.join(least, F.col("v") == F.col("n")).filter("u > v").select(
            F.col("u").alias("v"), F.col("low").alias("u")).distinct()
        # Small star: smaller neighbours and the node itself move to the smallest of them.
        least = large.groupBy("v").agg(F.min("u").alias("low")).select(F.col("v").alias("n"), "low")
        moved = large.join(least, F.col("v") == F.col("n")).select(F.col("u").alias("v"), F.col("low").alias("u"))
        edges = cut(moved.union(least.select("n", "low")).filter("u < v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
                edges.select("u", "u").distinct())
        before = now


def rooted(distinct, radius=RADIUS):
    """``distinct`` (fp, low) with root, one fingerprint for each component."""
    roots = components(links(distinct.select("fp"), radius))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs, radius=RADIUS, shingle_words=4, id_column="doc_id", text_column="text"):
    """One row per row of ``docs``: doc_id, fp, component_id (smallest doc_id reachable over links)."""
    marked = cut(fingerprints(docs, shingle_words, id_column, text_column))
    named = rooted(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), radius)
    smallest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs, radius=RADIUS, shingle_words=4, id_column="doc_id", text_column="text"):
    """The row with the smallest id of each group of near-duplicates, with all columns.

    Null ids lose against any id; of different texts under the smallest id the one with the smallest SHA-256
    stays, and of a repeated row (same id, equal text) one. Other groups do not matter to a row, whatever its id.
    """
    no_id = F.lit(-(2 ** 63))
    id_, digest, own_id, own_digest, place = spare(docs.columns, "id", "digest", "own_id", "own_digest", "place")
    marked = cut(fingerprints(docs, shingle_words, id_column, text_column, digest=True))
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "digest")
    named = rooted(marked.groupBy("fp").agg(F.min(order).alias("low")), radius)
    found = named.groupBy("root").agg(F.min("low").alias("low")).select(
        F.coalesce("low.doc_id", no_id).alias(id_), F.col("low.digest").alias(digest))
    own = docs.withColumn(own_id, F.coalesce(F.col(id_column).cast("long"), no_id)).withColumn(
        own_digest, F.unhex(F.sha2(text_or_empty(text_column).cast("binary"), 256)))
    first = F.row_number().over(Window.partitionBy(own_id, own_digest).orderBy(text_column))
    return own.join(found, (F.col(own_id) == F.col(id_)) & (F.col(own_digest) == F.col(digest)), "left_semi").withColumn(
        place, first).filter(F.col(place) == 1).select(*[f"`{c}`" for c in docs.columns])
