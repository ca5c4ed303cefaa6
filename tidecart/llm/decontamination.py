"""Benchmark decontamination by SimHash over windows of an item's size.

Texts and items are sequences of words (lower-cased, without outer punctuation), and weighted sets of their
five-word shingles. A document window for an item has as many shingles as the item. Windows start only at
shingles of the item: moving a window on to its first such shingle keeps all it shares with the item and its
size, so its similarity can only grow and nothing is lost.

Each window gets a 128-bit SimHash. Items of each length are indexed by twelve blocks of their fingerprint, each under
all values within two bits: fingerprints within 35 bits differ by at most two in some block, so the lookup returns
every item within the radius. Those are verified by the exact weighted Jaccard similarity of shingles, and
pairs of ``similarity`` or more are results. From window to window the sums of bits and the shared shingles are
carried on, so that neither time nor memory grows with windows times the length of an item.

The index of a benchmark is broadcast in parts of at most ``part_items`` items and ``part_bytes`` bytes of
text on average; a larger benchmark takes more passes over the documents.

Defined cases: items of fewer than five words are one shingle of all their words; null items or items without
words match nothing; null documents have no words. Repeated rows give their result once for each pair of
ids. Of equally similar windows the first is reported. Extra columns are ignored.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .exact_dedup import sha256
from .texts import record, slices, spare, text_or_empty, texts_of, words_of

SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 35, 12
#: Shingles by which windows that share a table of sums may lie apart: 4,096 take 2 MB, and an item as much by its length.
_SPAN = 4096
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BOUNDS = np.linspace(0, 128, BLOCKS + 1).astype(int)
_RESULT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()),
                     ("start_word", pa.int64()), ("n_words", pa.int64())])


def word_hashes(words):
    """Hashes of words without outer punctuation and case; 0 where nothing is left."""
    found = np.zeros(len(words), dtype=np.uint64)
    for i, word in enumerate(words):
        if not word.isalnum():
            begin, end = 0, len(word)
            while begin < end and not word[begin].isalnum():
                begin += 1
            while end > begin and not word[end - 1].isalnum():
                end -= 1
            word = word[begin:end]
        if word:
            found[i] = xxhash.xxh64_intdigest(word.lower(), 5) | 1
    return found


def hashed_texts(texts):
    """Word hashes of all texts in order, and their offsets by text."""
    words, codes, offsets = words_of(texts)
    every = word_hashes(words)[codes]
    real = every != 0
    return every[real], np.append(0, np.cumsum(real))[offsets]


def mixed(values):
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(words, size):
    """Hashes of runs of ``size`` words."""
    if len(words) < size:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        total = total * _STEP + words[i:len(words) - size + 1 + i]
    return mixed(total)


def hash_bits(hashes):
    """128 bits of each shingle."""
    return np.unpackbits(np.stack([hashes, mixed(hashes ^ _STEP)], axis=1).view(np.uint8).reshape(-1, 16), axis=1, bitorder="little")


def majority(ones, sizes):
    """Fingerprints (two 64-bit halves) from the number of ones by bit and the number of shingles."""
    return np.packbits(2 * ones > np.asarray(sizes)[:, None], axis=1, bitorder="little").view(np.uint64)


def simhash(hashes):
    """The fingerprint of one sequence of shingles."""
    ones = np.zeros(128, dtype=np.int64)
    for begin in range(0, len(hashes), _SPAN):
        ones += hash_bits(hashes[begin:begin + _SPAN]).sum(axis=0, dtype=np.int64)
    return majority(ones[None, :], [len(hashes)])


def window_prints(every, starts, sizes):
    """Yields (first window, fingerprints) of runs of windows of ``every``, by ascending start.

    A run shares one table of running sums, which ends where the next window begins after the last one's end, and
    holds few more shingles than a window or ``_SPAN`` have.
    """
    stops, begin = np.maximum.accumulate(starts + sizes), 0
    breaks = np.flatnonzero(starts[1:] >= stops[:-1]) + 1
    edges = np.append(breaks, len(starts)).tolist()
    for edge in edges:
        while begin < edge:
            end = min(edge, max(begin + 1, int(np.searchsorted(starts, starts[begin] + _SPAN))))
            low, high = int(starts[begin]), int(stops[end - 1])
            sums = np.zeros((high - low + 1, 128), dtype=np.int32)
            np.cumsum(hash_bits(every[low:high]), axis=0, dtype=np.int32, out=sums[1:])
            first = starts[begin:end] - low
            yield begin, majority(sums[first + sizes[begin:end]] - sums[first], sizes[begin:end])
            begin = end


def block_values(fingerprints):
    """Values of the twelve blocks, by fingerprint and block."""
    bits = np.unpackbits(fingerprints.view(np.uint8).reshape(-1, 16), axis=1, bitorder="little").astype(np.int64)
    return np.stack([(bits[:, a:b] << np.arange(b - a)).sum(axis=1) for a, b in zip(_BOUNDS[:-1], _BOUNDS[1:])], axis=1)


_FLIPS = [[sum(1 << b for b in bits) for n in range(RADIUS // BLOCKS + 1) for bits in combinations(range(width), n)]
          for width in np.diff(_BOUNDS).tolist()]


class Shared:
    """The weighted Jaccard similarity of an item and of windows of one text, carried on from window to window."""

    def __init__(self, values, weights):
        self.weights = dict(zip(values.tolist(), weights.tolist()))
        self.size = int(weights.sum())
        self.begin, self.end, self.held, self.common = 0, 0, {}, 0

    def _add(self, shingles):
        for value in shingles.tolist():
            if value in self.weights:
                n = self.held[value] = self.held.get(value, 0) + 1
                self.common += n <= self.weights[value]

    def _drop(self, shingles):
        for value in shingles.tolist():
            if value in self.weights:
                self.common -= self.held[value] <= self.weights[value]
                self.held[value] -= 1

    def similarity(self, every, begin, end):
        """Of the window every[begin:end]; windows come by ascending begin and end."""
        if begin >= self.end:
            self.held, self.common = {}, 0
            self._add(every[begin:end])
        else:
            self._drop(every[self.begin:begin])
            self._add(every[self.end:end])
        self.begin, self.end = begin, end
        return self.common / (end - begin + self.size - self.common)


class Index:
    """Items of one part of a benchmark, by shingle and by near values of fingerprint blocks."""

    def __init__(self, rows):
        self.ids, self.words, self.shingles = [], [], []
        for item_id, text in rows:
            words, _ = hashed_texts(pa.array([text or ""]))
            if len(words):
                self.ids.append(item_id)
                self.words.append(len(words))
                self.shingles.append(shingles(words, min(SHINGLE, len(words))))
        self.counts = [np.unique(s, return_counts=True) for s in self.shingles]
        self.sizes = sorted({min(SHINGLE, n) for n in self.words})
        owner = np.repeat(np.arange(len(self.ids)), [len(c[0]) for c in self.counts])
        every = np.concatenate([c[0] for c in self.counts]) if self.ids else np.zeros(0, dtype=np.uint64)
        order = np.argsort(every, kind="stable")
        self.known, first = np.unique(every[order], return_index=True)
        self.items = np.split(owner[order], first[1:]) if len(first) else []
        self.prints = (np.concatenate([simhash(s) for s in self.shingles]) if self.ids else np.zeros((0, 2), dtype=np.uint64))
        # By shingle size and number of shingles, then by block and value.
        self.blocks = {}
        for item, (values, words) in enumerate(zip(block_values(self.prints).tolist(), self.words)):
            alike = self.blocks.setdefault((min(SHINGLE, words), len(self.shingles[item])), [{} for _ in range(BLOCKS)])
            for known, value, flips in zip(alike, values, _FLIPS):
                for flip in flips:
                    known.setdefault(value ^ flip, []).append(item)

    def within_radius(self, size, length, values, fingerprint):
        """Items of ``length`` shingles whose fingerprint is within RADIUS bits; ``values`` are those of its blocks."""
        found = set()
        for block, value in zip(self.blocks[size, length], values):
            found.update(block.get(value, ()))
        found = np.array(sorted(found), dtype=np.int64)
        return found[np.bitwise_count(self.prints[found] ^ fingerprint).sum(axis=1) <= RADIUS] if len(found) else found

    def matches(self, words, offsets):
        """(text, item, similarity, first word) of all pairs of SIMILARITY or more, the best window of each."""
        best = {}
        for size in self.sizes:
            every = shingles(words, size)
            if not len(every):
                continue
            at = np.minimum(np.searchsorted(self.known, every), len(self.known) - 1)
            starts = np.flatnonzero(self.known[at] == every)
            owner = np.searchsorted(offsets, starts, side="right") - 1
            last = offsets[owner + 1] - size + 1  # end of the text's shingles
            whole = starts < last
            wanted = {}
            for start, text, stop, place in zip(starts[whole].tolist(), owner[whole].tolist(), last[whole].tolist(), at[starts[whole]].tolist()):
                for length in {len(self.shingles[i]) for i in self.items[place].tolist() if min(SHINGLE, self.words[i]) == size}:
                    wanted.setdefault(length, []).append((start, text, min(length, stop - start)))
            for length, rows in wanted.items():
                rows = np.array(rows, dtype=np.int64)
                compared, current = {}, None
                for begin, prints in window_prints(every, rows[:, 0], rows[:, 2]):
                    part = rows[begin:begin + len(prints)].tolist()
                    for (first, text, held), fingerprint, values in zip(part, prints, block_values(prints).tolist()):
                        if text != current:
                            compared, current = {}, text
                        place = first - int(offsets[text])
                        for item in self.within_radius(size, length, values, fingerprint).tolist():
                            if item not in compared:
                                compared[item] = Shared(*self.counts[item])
                            alike = compared[item].similarity(every, first, first + held)
                            key = (text, item)
                            if alike >= SIMILARITY and (key not in best or (-alike, place) < best[key]):
                                best[key] = (-alike, place)
        return [(text, item, -alike, place) for (text, item), (alike, place) in sorted(best.items())]


def _find(model):
    def run(batches):
        index = model.value
        for batch in slices(batches):
            if not index.ids:
                continue
            words, offsets = hashed_texts(texts_of(batch))
            found = index.matches(words, offsets)
            if found:
                yield record(_RESULT, batch.column(0).take(pa.array([f[0] for f in found])), [index.ids[f[1]] for f in found],
                             [f[2] for f in found], [f[3] for f in found], [index.words[f[1]] for f in found])
    return run


def _find_leaking(model):
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary())])

    def run(batches):
        index = model.value
        for batch in slices(batches):
            if not index.ids:
                continue
            texts = texts_of(batch)
            rows = pa.array(sorted({f[0] for f in index.matches(*hashed_texts(texts))}), pa.int64())
            if len(rows):
                yield record(schema, batch.column(0).take(rows), [sha256(t.as_buffer()) for t in texts.take(rows).cast(pa.binary())])
    return run


def scanned(docs, benchmark, find, schema, part_items, part_bytes, id_column, text_column, item_column, item_text_column):
    """What ``find`` (a function of a broadcast Index) yields for all documents and all parts of the benchmark."""
    items = benchmark.select(F.col(item_column).cast("long").alias("item_id"), F.col(item_text_column).alias("text"))
    count, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-count // part_items), -(-size // part_bytes))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    found = None
    for part in range(parts):
        chosen = items if parts == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        model = docs.sparkSession.sparkContext.broadcast(Index([(r.item_id, r.text) for r in chosen.orderBy("item_id").collect()]))
        pairs = rows.mapInArrow(find(model), schema)
        found = pairs if found is None else found.union(pairs)
    return found


def contaminated(docs, benchmark, part_items=20_000, part_bytes=16 << 20, id_column="doc_id", text_column="text",
                 item_column="item_id", item_text_column="text"):
    """One row for each pair of a document and an item it contains: doc_id, item_id, similarity, start_word, n_words."""
    found = scanned(docs, benchmark, _find, "doc_id long, item_id long, similarity double, start_word long, n_words long",
                    part_items, part_bytes, id_column, text_column, item_column, item_text_column)
    # A repeated document or item gives its pair once, with its best window.
    best = F.max_by(F.struct("similarity", "start_word", "n_words"), F.struct("similarity", -F.col("start_word"))).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def drop_contaminated(docs, benchmark, part_items=20_000, part_bytes=16 << 20, id_column="doc_id", text_column="text",
                      item_column="item_id", item_text_column="text"):
    """The rows of ``docs`` that hold no benchmark item, with all their columns, whatever other rows of their id hold."""
    leaking, digest, own_digest = spare(docs.columns, "leaking", "digest", "own_digest")
    found = scanned(docs, benchmark, _find_leaking, "doc_id long, digest binary",
                    part_items, part_bytes, id_column, text_column, item_column, item_text_column).select(
        F.col("doc_id").alias(leaking), F.col("digest").alias(digest)).distinct()
    own = docs.withColumn(own_digest, F.unhex(F.sha2(text_or_empty(text_column).cast("binary"), 256)))
    return own.join(found, F.col(id_column).cast("long").eqNullSafe(F.col(leaking)) & (F.col(own_digest) == F.col(digest)),
                    "left_anti").select(*[f"`{c}`" for c in docs.columns])
