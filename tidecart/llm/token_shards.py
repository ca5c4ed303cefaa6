"""Token ids in binary shards with a minimal perfect hash index for keyed access.

Documents are range-partitioned and sorted by id, encoded, ended with an end id, and packed into shards. A shard is
one row of a Parquet folder, written by Spark, so that lost executors and retried tasks leave no half files:

    part, shard        range partition, and place of the shard in it
    start_in_part      ids before the shard in its partition
    earlier            rows before the shard that have the id of its first document
    doc_ids            its documents' ids in ascending order (null ids first)
    payload            their ids in that order, little-endian, 2 or 4 bytes each as ``width`` says
    seeds              one number for each bucket of keys
    slots              for each slot of the hash: fingerprint, offset and length, as three 4-byte numbers

The index is hash-and-displace. A key (document id and number of earlier rows with that id) falls into a bucket;
the bucket's seed sends its keys to slots of their own, n keys to exactly n slots, and a bucket of one key
names its slot directly. A lookup is two hashes and a check of the stored fingerprint, whatever the shard's size.
Global offsets need one number for each partition, the sum of those before it.

Words between single spaces repeat, so their ids are kept in a bounded cache and words not in it are encoded
together. Where the library cuts as GPT-2 does, marks and single line ends are first cut off the words, which leaves fewer
different ones. Texts with other white space at a space, or with a special token, are encoded whole.

Defined cases: null and empty texts are the end id alone; rows with the same id are kept in the order of their
texts, each under its own key; an empty table gives no shard and an empty result. Extra columns are ignored.
"""

import json
import os
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from ..session import shared_folder
from .byte_bpe import Recent
from .texts import joined_ids, record, slices, texts_of

_SLICE = 12 << 20
_KEYS_IN_BUCKET = 2
_SHARDS = ("part int, shard int, start_in_part long, n_ids long, width int, earlier long, doc_ids array<long>, payload binary, "
           "seeds binary, slots binary")
_SHARDS_ARROW = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("start_in_part", pa.int64()), ("n_ids", pa.int64()),
                           ("width", pa.int32()), ("earlier", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("payload", pa.binary()),
                           ("seeds", pa.binary()), ("slots", pa.binary())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


class Encoder:
    """The tokenizers library behind a cache of the ids of words after a space."""

    def __init__(self, model_file, cached=400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(model_file)
        self.size = self.library.get_vocab_size()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.begins = np.zeros(self.size, dtype=bool)
        for token, number in self.library.get_vocab().items():
            self.begins[number] = token.startswith("Ġ")
        self.young, self.old, self.cached = {}, {}, cached  # two generations: what is not used falls out
        self.first = Recent(self.whole, 50_000)
        self.later = Recent(None, cached // 4)  # pieces without a space before them
        self.line_end = self.library.token_to_id("Ċ")
        rules = json.loads(self.library.to_str())
        pattern = rules["pre_tokenizer"] or {}
        self.cuts = (self.line_end is not None and rules["normalizer"] is None and pattern.get("type") == "ByteLevel"
                     and pattern["use_regex"] and not pattern["add_prefix_space"])

    def whole(self, text):
        """Ids as the bytes of 4-byte numbers, which join and store compactly."""
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.int32).tobytes()

    def together(self, words, separator, begins, apart=0):
        """Ids of each word, encoded in texts of many: each starts with a separator, where ``begins`` holds for an id.

        The first ``apart`` ids from there are the separator's alone and none of the word's.
        """
        found = []
        for begin in range(0, len(words), 2000):
            part = words[begin:begin + 2000]
            ids = self.library.encode_batch_fast([separator + separator.join(part)], add_special_tokens=False)[0].ids
            ids = np.array(ids, dtype=np.int32)
            places = (4 * np.flatnonzero(begins(ids))).tolist() + [4 * len(ids)]
            if len(places) != len(part) + 1:
                raise ValueError("words could not be told apart")
            data = ids.tobytes()
            found += [data[a + 4 * apart:b] for a, b in zip(places[:-1], places[1:])]
        return found

    def after_space(self, words):
        """Ids of each word with a space before it; None for words that a neighbour can change."""
        if len(self.young) > self.cached:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found = list(map(young.get, words))
        new = []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            word = words[i]
            ids = old.get(word)
            if ids is not None:
                found[i] = young[word] = ids
            elif word and not word[0].isspace() and not word[-1].isspace():
                new.append(i)
        for i, ids in zip(new, self.together([words[i] for i in new], " ", self.begins.__getitem__)):
            found[i] = young[words[i]] = ids
        return found

    def inside(self, words):
        """Ids of each later piece of a word; None for pieces that a neighbour can change. A line end comes by itself."""
        found = list(map(self.later.known, words))
        new = []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            if "\n" not in words[i]:
                if not words[i][-1].isspace():
                    new.append(i)
            elif words[i] == "\n" or not words[i][-1].isspace():
                found[i] = self.whole(words[i])
        for i, ids in zip(new, self.together([words[i] for i in new], "\n", lambda ids: ids == self.line_end, 1)):
            found[i] = ids
        for word, ids in zip(words, found):
            if ids is not None:
                self.later.put(word, ids)
        return found

    def encode(self, texts, end):
        """(ids of all texts, each ended with ``end``; offsets by text)."""
        return joined_ids(texts, self.after_space, lambda parts: [self.first(t) if len(t) < 64 else self.whole(t) for t in parts],
                          end, self.special, self.inside if self.cuts else None)


@lru_cache(maxsize=2)
def encoder(model_file):
    """One encoder for each worker, kept over its tasks."""
    return Encoder(model_file)


def _mixed(value):
    value = (value ^ (value >> 33)) * 0xFF51AFD7ED558CCD & 0xFFFFFFFFFFFFFFFF
    value = (value ^ (value >> 33)) * 0xC4CEB9FE1A85EC53 & 0xFFFFFFFFFFFFFFFF
    return value ^ (value >> 33)


def key_of(doc_id, earlier=0):
    """The 64-bit key of a document id (None allowed) after ``earlier`` rows with the same id."""
    number = 0x9D3F5A1C77E1B24D if doc_id is None else doc_id & 0xFFFFFFFFFFFFFFFF
    return _mixed(_mixed(number ^ 0x2545F4914F6CDD1D) + earlier & 0xFFFFFFFFFFFFFFFF)


def numbered(doc_ids, last, earlier):
    """Numbers of earlier rows with the same id, for ascending ids that go on from ``last``."""
    numbers = []
    for doc_id in doc_ids:
        earlier = earlier + 1 if doc_id == last else 0
        last = doc_id
        numbers.append(earlier)
    return numbers


def build_index(keys):
    """(seeds, slot of each key) of a minimal perfect hash of distinct keys."""
    n = len(keys)
    buckets = [[] for _ in range(max(1, -(-n // _KEYS_IN_BUCKET)))]
    for place, key in enumerate(keys):
        buckets[key % len(buckets)].append(place)
    seeds, slots, free = np.zeros(len(buckets), dtype="<i4"), np.zeros(n, dtype=np.int64), [True] * n
    for bucket in sorted(range(len(buckets)), key=lambda b: -len(buckets[b])):
        places = buckets[bucket]
        if len(places) < 2:
            break
        seed = 1
        while True:
            wanted = [_mixed(keys[p] + seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) % n for p in places]
            if len(set(wanted)) == len(wanted) and all(free[w] for w in wanted):
                break
            seed += 1
        seeds[bucket] = seed
        for p, w in zip(places, wanted):
            slots[p], free[w] = w, False
    left = iter([i for i, f in enumerate(free) if f])
    for bucket, places in enumerate(buckets):
        if len(places) == 1:
            slots[places[0]] = next(left)
            seeds[bucket] = -1 - slots[places[0]]
    return seeds, slots


class Shard:
    """Keyed access to one shard row."""

    def __init__(self, row):
        self.row = row
        self.ids = np.frombuffer(row["payload"], dtype=f"<u{row['width']}")
        self.seeds = np.frombuffer(row["seeds"], dtype="<i4").tolist()
        self.slots = np.frombuffer(row["slots"], dtype="<u4").reshape(-1, 3).tolist()

    def find(self, key):
        """(offset, length) of a key's ids within the shard, or None."""
        if not self.slots:
            return None
        seed = self.seeds[key % len(self.seeds)]
        slot = -1 - seed if seed < 0 else _mixed(key + seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) % len(self.slots)
        fingerprint, offset, length = self.slots[slot]
        return (offset, length) if fingerprint == key >> 32 else None

    def get(self, doc_id, earlier=0):
        found = self.find(key_of(doc_id, earlier))
        return None if found is None else self.ids[found[0]:found[0] + found[1]]


def _packed(model_file, end):
    def run(batches):
        known, part, shard, before = encoder(model_file), TaskContext.get().partitionId(), 0, 0
        last, earlier = object(), 0
        for batch in slices(batches, _SLICE):
            ids, bounds = known.encode(texts_of(batch), end)
            width = 2 if max(known.size, end + 1) <= 1 << 16 else 4
            doc_ids = batch.column(0).to_pylist()
            numbers = numbered(doc_ids, last, earlier)
            last, earlier = doc_ids[-1], numbers[-1]
            keys = [key_of(doc_id, n) for doc_id, n in zip(doc_ids, numbers)]
            seeds, places = build_index(keys)
            slots = np.zeros((len(keys), 3), dtype="<u4")
            slots[places, 0] = [k >> 32 for k in keys]
            slots[places, 1] = bounds[:-1]
            slots[places, 2] = np.diff(bounds)
            yield record(_SHARDS_ARROW, [part], [shard], [before], [len(ids)], [width], [numbers[0]], [doc_ids],
                         [ids.astype(f"<u{width}").tobytes()], [seeds.tobytes()], [slots.tobytes()])
            shard += 1
            before += len(ids)
    return run


def write(docs, folder, model_file, end=0, id_column="doc_id", text_column="text"):
    """Writes the shards of all rows of ``docs`` to a new folder that all executors share."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered.mapInArrow(_packed(model_file, end), _SHARDS).write.option("compression", "zstd").parquet(folder)


def starts_by_part(spark, folder):
    """Ids before each partition; one number for each partition reaches the driver."""
    sums = spark.read.schema(_SHARDS).parquet(folder).groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    starts, before = {}, 0
    for row in sums:
        starts[row.part] = before
        before += row.n
    return starts


def _read(starts):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard, out = Shard(row), []
                base = starts.value[row["part"]] + row["start_in_part"]
                first = row["doc_ids"][0]
                for doc_id, number in zip(row["doc_ids"], numbered(row["doc_ids"], first, row["earlier"] - 1)):
                    found = shard.find(key_of(doc_id, number))
                    ids = shard.ids[found[0]:found[0] + found[1]].astype("<u4")
                    out.append((doc_id, base + found[0], len(ids), zlib.crc32(ids.tobytes())))
                yield record(_FOUND, *zip(*out))
    return run


def read(spark, folder):
    """doc_id, start, n_tokens, ids_crc32 of every document, each looked up by key in the written files."""
    starts = spark.sparkContext.broadcast(starts_by_part(spark, folder))
    return spark.read.schema(_SHARDS).parquet(folder).mapInArrow(
        _read(starts), "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs, model_file, end=0, **columns):
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/token-shards-{uuid.uuid4().hex}"
    write(docs, folder, model_file, end, **columns)
    return read(spark, folder)
