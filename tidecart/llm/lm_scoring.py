"""Language-model scores from a bigram model run as a weighted backoff automaton.

Every word of the training texts is a state. A seen bigram is an arc between states with its smoothed
probability; a failure arc leads from a state to the root with the mass left to unseen words, and the root has
an arc for every word. Smoothing is Dirichlet: with c(v, w) and c(v) from the corpus, p(w | v) is
(c(v, w) + m p(w)) / (c(v) + m), so the failure arc of v weighs m / (c(v) + m) and each state's
probabilities add up to one. A text is read from left to right once: the state is carried, log-probabilities add up.

The model is never in one place. Documents are cut into slices. A slice asks for its distinct words and
bigrams (64-bit hashes) and brings its own training counts with it; requests meet in hash buckets, where the
counts of all slices are added up and sent back to each asker. There they make the part of the automaton that
the slice's documents can reach. A word of a third of all tokens is one row for each slice, so no key is hot.
Buckets grow in number with the text, so that each stays near ``bucket_bytes``. Sorted keys travel as
differences, by byte plane and compressed.

Counts cover all training rows. Defined cases: null texts are empty; every text ends with an end token, so an
empty one has one token; repeated rows count each time; rows with a null id are scored but not learned from.
Extra columns are ignored.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import functions as F

from .texts import record, slices, texts_of, words_of

PSEUDO_COUNT = 20.0
_END, _START = np.uint64(0xA5F152D3C1B7E9A1), np.uint64(0x3C8E41D7B06F9255)
_SLICE = 4 << 20
_DOCUMENTS = 2  # in column ``kind``: 0 words, 1 bigrams, 2 the documents themselves
_PARTS = ("slice long, kind int, bucket int, keys binary, numbers binary, ids array<long>, learned array<boolean>, lengths array<long>")
_PARTS_ARROW = pa.schema([("slice", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()),
                          ("numbers", pa.binary()), ("ids", pa.list_(pa.int64())), ("learned", pa.list_(pa.bool_())),
                          ("lengths", pa.list_(pa.int64()))])
_SCORES = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("base_score", pa.float64()), ("score", pa.float64())])


def tokens_of(texts):
    """(sorted keys of the distinct words and the end, codes of all tokens in that order, offsets by text)."""
    words, codes, offsets = words_of(pc.ascii_lower(texts))
    keys, place = np.unique(np.array([xxhash.xxh64_intdigest(w) for w in words] + [int(_END)], dtype=np.uint64), return_inverse=True)
    ends = offsets[1:] + np.arange(len(texts))
    stream = np.full(len(codes) + len(texts), place[-1], dtype=np.int64)
    inner = np.ones(len(stream), dtype=bool)
    inner[ends] = False
    stream[inner] = place[codes]
    return keys, stream, np.append(0, ends + 1)


def bigram_keys(keys, stream, offsets):
    """A hash for each token with the one before it, or the start."""
    current = keys[stream]
    before = np.roll(current, 1)
    before[offsets[:-1]] = _START
    mixed = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (current + np.uint64(0x7F4A7C15F39CC060))
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def packed(numbers):
    """Unsigned numbers as compressed byte planes."""
    return zstandard.compress(np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked(data):
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def packed_keys(keys):
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data):
    return np.cumsum(unpacked(data), dtype=np.uint64)


def bucket_of(keys, bits):
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), dtype=np.int64)


def _word_counts(batches):
    schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])
    for batch in slices(batches, 2 * _SLICE):
        keys, stream, _ = tokens_of(texts_of(batch))
        yield record(schema, keys.view(np.int64), np.bincount(stream, minlength=len(keys)))


def totals(docs, learned, text_column="text"):
    """(number of tokens, number of distinct tokens) of the training rows."""
    counts = (docs.filter(learned).select(F.col(text_column).alias("text")).mapInArrow(_word_counts, "word long, n long")
              .groupBy("word").agg(F.sum("n").alias("n")).filter("n > 0"))
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    return tokens, distinct


def _requests(bits):
    def run(batches):
        for batch in slices(batches, _SLICE):
            words, stream, offsets = tokens_of(texts_of(batch))
            learned = batch.column("learned").to_numpy(zero_copy_only=False).astype(bool)
            lengths = np.diff(offsets)
            ids = batch.column("doc_id")
            name = xxhash.xxh64_intdigest(repr(ids.to_pylist()).encode() + stream.tobytes() + words.tobytes()) >> 1
            counted = np.repeat(learned, lengths)
            rows = [(name, _DOCUMENTS, int(name % (1 << bits)), None, zstandard.compress(stream.astype(np.int32).tobytes(), 3),
                     ids.to_pylist(), learned.tolist(), lengths.tolist())]
            pairs, at = np.unique(bigram_keys(words, stream, offsets), return_inverse=True)
            for kind, keys, places in ((0, words, stream), (1, pairs, at)):
                counts = np.bincount(places[counted], minlength=len(keys))
                bounds = np.searchsorted(bucket_of(keys, bits), np.arange((1 << bits) + 1))
                for bucket in np.flatnonzero(np.diff(bounds)).tolist():
                    a, b = bounds[bucket], bounds[bucket + 1]
                    rows.append((name, kind, bucket, packed_keys(keys[a:b]), packed(counts[a:b]), None, None, None))
            yield record(_PARTS_ARROW, *zip(*rows))
    return run


def _answered(bucket):
    """Adds up the counts of a bucket's keys and answers each request in the order of its keys."""
    kinds = bucket.column("kind").to_numpy()
    out = [bucket.filter(pa.array(kinds == _DOCUMENTS))]
    for kind in (0, 1):
        asked = bucket.filter(pa.array(kinds == kind))
        if not asked.num_rows:
            continue
        keys = [unpacked_keys(k.as_py()) for k in asked.column("keys")]
        counts = np.concatenate([unpacked(n.as_py()) for n in asked.column("numbers")])
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.uint64)[at]
        bounds = np.append(0, np.cumsum([len(k) for k in keys]))
        answers = pa.array([packed(total[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())
        if kind == 1:  # the words' keys are needed again, to find the order of the bigrams
            asked = asked.set_column(3, "keys", pa.nulls(asked.num_rows, pa.binary()))
        out.append(asked.set_column(4, "numbers", answers))
    return pa.concat_tables([t.cast(_PARTS_ARROW) for t in out])


class BackoffAutomaton:
    """States are words by code, and the start; arcs and weights hold the part that a slice can reach."""

    def __init__(self, unigrams, backoff, arcs, width):
        """Log10 weights: root arcs by word, failure arcs by state, seen bigrams by state * width + word."""
        self.unigrams, self.backoff, self.arcs, self.width = unigrams, backoff, arcs, width

    def read(self, words, start):
        """The log10-probability of a sequence of word codes: one pass from left to right."""
        state, total, width = start, 0.0, self.width
        arc, failure, root = self.arcs.get, self.backoff, self.unigrams
        for word in words:
            weight = arc(state * width + word)
            total += failure[state] + root[word] if weight is None else weight
            state = word
        return total


def score_slice(words, stream, offsets, word_counts, bigram_counts, tokens, distinct, starts, pseudo):
    """(n_known, base_score, score) by document; counts are in the order of the slice's sorted distinct keys."""
    counts = word_counts.astype(np.float64)
    base = np.log10((counts + 0.5) / (tokens + 0.5 * (distinct + 1)))
    _, first = np.unique(bigram_keys(words, stream, offsets), return_index=True)
    begin, width = len(words), len(words) + 1
    before = np.roll(stream, 1)
    before[offsets[:-1]] = begin
    context = np.append(counts, starts)
    seen = first[bigram_counts > 0]
    arcs = np.log10((bigram_counts[bigram_counts > 0] + pseudo * 10 ** base[stream[seen]]) / (context[before[seen]] + pseudo))
    automaton = BackoffAutomaton(base.tolist(), np.log10(pseudo / (context + pseudo)).tolist(),
                                 dict(zip((before[seen] * width + stream[seen]).tolist(), arcs.tolist())), width)
    known, summed = np.add.reduceat(counts[stream] > 0, offsets[:-1], dtype=np.int64), np.add.reduceat(base[stream], offsets[:-1])
    codes = stream.tolist()
    return known, summed, [automaton.read(codes[a:b], begin) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def _scored(tokens, distinct, starts, pseudo):
    def run(parts):
        rows, answers, keys, documents = parts.to_pylist(), {}, {}, []
        for row in rows:
            if row["kind"] == _DOCUMENTS:
                documents.append(row)
            else:
                answers[row["kind"], row["bucket"]] = unpacked(row["numbers"])
                if row["kind"] == 0:
                    keys[row["bucket"]] = unpacked_keys(row["keys"])
        words = np.concatenate([keys[bucket] for bucket in sorted(keys)])
        counts = [np.concatenate([answers[key] for key in sorted(answers) if key[0] == kind]) for kind in (0, 1)]
        out = []
        for row in documents:
            stream = np.frombuffer(zstandard.decompress(row["numbers"]), dtype=np.int32).astype(np.int64)
            lengths = np.array(row["lengths"], dtype=np.int64)
            known, base, score = score_slice(words, stream, np.append(0, np.cumsum(lengths)),
                                             *counts, tokens, distinct, starts, pseudo)
            out.append(pa.Table.from_batches([record(_SCORES, row["ids"], lengths, known, base, score)]))
        return pa.concat_tables(out) if out else _SCORES.empty_table()
    return run


def fit_and_score(docs, learned, pseudo=PSEUDO_COUNT, bucket_bytes=12 << 20, id_column="doc_id", text_column="text"):
    """(scores, training tokens): one row per row of ``docs`` with doc_id, n_tokens, n_known, base_score, score.

    ``learned`` is the condition of the rows that the model learns from.
    """
    learned = F.coalesce(learned, F.lit(False))
    tokens, distinct = totals(docs, learned, text_column)
    size, starts = docs.agg(F.coalesce(F.sum(F.octet_length(text_column)), F.lit(0)),
                            F.coalesce(F.sum(learned.cast("long")), F.lit(0))).first()
    bits = int(max(0, np.ceil(np.log2(max(1, size / bucket_bytes)))))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), learned.alias("learned"))
    parts = rows.mapInArrow(_requests(bits), _PARTS)
    answered = parts.groupBy("bucket").applyInArrow(_answered, _PARTS)
    scores = answered.groupBy("slice").applyInArrow(
        _scored(tokens, distinct, starts, pseudo), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scores, tokens
