"""Byte-level BPE encoding and decoding from a file of ranks.

Text is cut by the tokenizer's pattern; within each match a segment tree over byte positions holds the
rank of the pair that starts there, and its root is the leftmost pair of minimum rank. A merge is three
point updates of logarithmic cost, on the merged position, its dead right neighbour and its live left
neighbour, so a match of n bytes takes n log n steps however it merges.

Words repeat, so a slice of texts is cut at single spaces and each different word is matched once: between a visible
character and a space the pattern always cuts. Texts with other runs of white space next to spaces are matched
whole. The trees of all new matches of up to 64 bytes are merged step by step together, as columns of one array; longer
matches one by one. Ids of words are kept in a bounded two-generation cache; what falls out is encoded again.

Defined cases: null texts are empty and have no ids; strings of special tokens are ordinary text; repeated
rows, null ids, empty tables and extra columns need no care.
"""

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from .texts import joined_ids, record, slices, texts_of

_NONE = 1 << 62
#: Bytes of the longest matches that are merged together, and how many are at a time.
LONGEST_TOGETHER, _TOGETHER = 64, 8192
_RESULT = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])


def merged(piece, ranks):
    """Ids of one match (bytes), by minimum-rank merges from left to right."""
    whole = ranks.get(piece)
    if whole is not None:
        return (whole,)
    n = len(piece)
    size = 1 << max(1, n - 1).bit_length()
    tree = [_NONE] * (2 * size)
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i:i + 2])
        if rank is not None:
            tree[size + i] = rank * size + i
    for node in range(size - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(i, value):
        node = size + i
        tree[node] = value
        node >>= 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            low = a if a < b else b
            if tree[node] == low:
                break
            tree[node] = low
            node >>= 1

    while tree[1] != _NONE:
        i = tree[1] & (size - 1)
        dead = end[i]
        stop = end[i] = end[dead]
        put(dead, _NONE)
        rank = get(piece[i:end[stop]]) if stop < n else None
        put(i, _NONE if rank is None else rank * size + i)
        if stop < n:
            before[stop] = i
        left = before[i]
        if left >= 0:
            rank = get(piece[left:stop])
            put(left, _NONE if rank is None else rank * size + left)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return tuple(ids)


class Pairs:
    """Rank of the token that two neighbouring tokens make up, looked up for arrays of tokens."""

    def __init__(self, ranks):
        found = [(ranks[token[:cut]] << 32 | ranks[token[cut:]], rank) for token, rank in ranks.items()
                 for cut in range(1, len(token)) if token[:cut] in ranks and token[cut:] in ranks]
        table = np.array(sorted(found), dtype=np.int64).reshape(-1, 2)
        self.keys, self.ranks = np.append(table[:, 0], _NONE), np.append(table[:, 1], _NONE)
        self.single = np.full(256, -1, dtype=np.int64)
        for byte in range(256):
            self.single[byte] = ranks[bytes([byte])]

    def __call__(self, left, right):
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)


def merged_together(pieces, pairs):
    """``merged`` for many matches of 2 to 2**k bytes at once: one tree for each, a column of an array; every step
    merges the root pair of all trees that have one. Returns (ids of all, offsets by match)."""
    count, lengths = len(pieces), np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    bits = max(1, (int(lengths.max()) - 1).bit_length())
    size, column = 1 << bits, np.arange(count)
    place = np.arange(size + 1)[:, None]
    inside = place < lengths
    token = np.zeros((size + 1, count), dtype=np.int64)
    owner = np.repeat(column, lengths)
    token[np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths), owner] = \
        pairs.single[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    end, before = np.repeat(place + 1, count, axis=1), np.repeat(place - 1, count, axis=1)
    tree = np.full((2 * size, count), _NONE, dtype=np.int64)
    at, col = np.nonzero(place[:-1] < lengths - 1)
    rank = pairs(token[at, col], token[at + 1, col])
    tree[size + at, col] = np.where(rank == _NONE, _NONE, rank << bits | at)
    for level in range(bits - 1, -1, -1):
        nodes = slice(1 << level, 2 << level)
        children = tree[2 << level:4 << level]
        np.minimum(children[0::2], children[1::2], out=tree[nodes])
    active = column
    while True:
        root = tree[1, active]
        active, root = active[root != _NONE], root[root != _NONE]
        if not len(active):
            break
        here, rank = root & size - 1, root >> bits
        dead = end[here, active]
        stop = end[dead, active]
        token[here, active], end[here, active], before[stop, active], inside[dead, active] = rank, stop, here, False
        left = before[here, active]
        last, first = stop >= lengths[active], left < 0
        rank_here = np.where(last, _NONE, pairs(rank, token[stop, active]))
        rank_left = np.where(first, _NONE, pairs(token[left, active], rank))
        leaves = ((dead, np.full(len(active), _NONE)), (here, np.where(rank_here == _NONE, _NONE, rank_here << bits | here)),
                  (np.where(first, here, left), None))
        for node, value in leaves[:2]:
            tree[size + node, active] = value
        some = ~first
        tree[size + left[some], active[some]] = np.where(rank_left == _NONE, _NONE, rank_left << bits | left)[some]
        for node in (dead, here, leaves[2][0]):
            node = size + node
            for _ in range(bits):
                node = node >> 1
                tree[node, active] = np.minimum(tree[2 * node, active], tree[2 * node + 1, active])
    alive = np.ascontiguousarray(inside.T)
    return np.ascontiguousarray(token.T)[alive], np.append(0, np.cumsum(alive.sum(axis=1)))


class Recent:
    """A dictionary of at most about twice ``limit`` entries that drops those not used lately."""

    def __init__(self, make, limit):
        self.make, self.limit, self.young, self.old = make, limit, {}, {}

    def __call__(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = self.make(key)
            self.put(key, found)
        return found

    def put(self, key, value):
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        self.young[key] = value

    def known(self, key):
        found = self.young.get(key)
        return self.old.get(key) if found is None else found


class Codec:
    """Encodes and decodes slices of texts; ids are kept as the bytes of 4-byte numbers, which join and store compactly."""

    def __init__(self, ranks_file, pattern, cached=200_000):
        with open(ranks_file, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pairs = Pairs(self.ranks)
        # The bytes of all ids one after the other, for decoding.
        by_id = sorted(self.ranks.items(), key=lambda item: item[1])
        self.sizes = np.zeros(by_id[-1][1] + 1, dtype=np.int64)
        self.sizes[[i for _, i in by_id]] = [len(b) for b, _ in by_id]
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(b for b, _ in by_id), dtype=np.uint8)
        # White space as in Unicode, without the separators 1C to 1F that Python's \s takes in.
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}")
                                     .replace(r"\s", r"\p{White_Space}"))
        self.words = Recent(None, cached)

    def of_matches(self, matches):
        """{match: bytes of its ids} for a set of matches; each is merged once."""
        found, by_bits = {}, {}
        for match in matches:
            piece = match.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(piece)
            if whole is not None:
                found[match] = whole.to_bytes(4, "little")
            elif len(piece) > LONGEST_TOGETHER:
                found[match] = np.array(merged(piece, self.ranks), dtype="<i4").tobytes()
            else:
                by_bits.setdefault((len(piece) - 1).bit_length(), []).append((match, piece))
        for group in by_bits.values():
            for begin in range(0, len(group), _TOGETHER):
                part = group[begin:begin + _TOGETHER]
                ids, offsets = merged_together([piece for _, piece in part], self.pairs)
                data, ends = ids.astype("<i4").tobytes(), (4 * offsets).tolist()
                for (match, _), a, b in zip(part, ends[:-1], ends[1:]):
                    found[match] = data[a:b]
        return found

    def of_texts(self, texts):
        """Bytes of the ids of each text, matched as a whole."""
        cut = [self.pattern.findall(text) for text in texts]
        known = self.of_matches({match for matches in cut for match in matches})
        return [b"".join([known[match] for match in matches]) for matches in cut]

    def after_space(self, words):
        """Ids of each word with a space before it; None where the pattern may not cut around it."""
        found = list(map(self.words.known, words))
        new = [i for i, ids in enumerate(found)
               if ids is None and words[i] and not words[i][0].isspace() and not words[i][-1].isspace()]
        for i, ids in zip(new, self.of_texts([" " + words[i] for i in new])):
            found[i] = ids
        for word, ids in zip(words, found):
            if ids is not None:
                self.words.put(word, ids)
        return found

    def encode(self, text):
        return self.of_texts([text])[0]

    def decode(self, ids):
        return self.decoded(np.frombuffer(ids, dtype="<i4"))[0].tobytes()

    def decoded(self, ids):
        """(bytes of all ids, offset of each id and of the end)."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.begins[ids] - (ends - sizes), sizes)
        at += np.arange(len(at))
        return self.bytes[at], np.append(0, ends)


@lru_cache(maxsize=2)
def codec(ranks_file, pattern):
    """One codec for each worker, kept over its tasks."""
    return Codec(ranks_file, pattern)


def _encoded(ranks_file, pattern):
    def run(batches):
        known = codec(ranks_file, pattern)
        for batch in slices(batches, 4 << 20):
            ids, offsets = joined_ids(texts_of(batch), known.after_space, known.of_texts)
            decoded, ends = known.decoded(ids)
            yield record(_RESULT, batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)),
                         pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(ends[offsets].astype(np.int32)), pa.py_buffer(decoded)]))
    return run


def encode(docs, ranks_file, pattern, id_column="doc_id", text_column="text"):
    """doc_id, ids (array of int), decoded (binary: the bytes of those ids) of every row."""
    return (docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
            .mapInArrow(_encoded(ranks_file, pattern), "doc_id long, ids array<int>, decoded binary"))
