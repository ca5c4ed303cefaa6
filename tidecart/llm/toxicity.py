"""Toxicity scores from a factorization machine over hashed terms.

A text is its set of terms, each a 62-bit hash of a lower-cased word without outer punctuation. The machine
adds a weight for each term and, for each pair of terms, the product of their factor vectors, so that a
pair such as an insult with a group mention can count although neither term does. The pairs cost no more
than the terms: their sum is half of (square of the sum minus sum of the squares) in each factor.

Weights and factors are fitted with proximal AdaGrad steps on a bounded sample of labelled rows:
``per_label`` rows of each label, those with the smallest hash of the id, and on all their terms in ``least``
texts or more that tell the labels apart beyond chance, alone or in a pair, however many they are. A term's evidence is the chi-square of the term alone or, if larger, of its best pair, by what the
pair tells beyond its two terms. Factor vectors shrink as groups, by this
evidence, so terms that carry nothing alone or in a pair leave the model. Scores cover every row and its
whole text. The pairs of all rows of the sample are counted, text by text, for some terms at a time.

Defined cases: null and empty texts have no terms and get the intercept's score; without both labels in the
sample every score is 0. Labels that are null are not learned from; repeated labels count each time. Ties
in sampling go to the smaller id. Extra columns of either table are ignored.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .texts import first_by_hash, id_bucket, record, slices, sums_by_text, texts_of, words_of


def term_hashes(words):
    """Hashes of distinct words as written; words without a letter or digit become -1."""
    found = np.empty(len(words), dtype=np.int64)
    for i, word in enumerate(words):
        if not word.isalnum():
            begin, end = 0, len(word)
            while begin < end and not word[begin].isalnum():
                begin += 1
            while end > begin and not word[end - 1].isalnum():
                end -= 1
            word = word[begin:end]
        found[i] = xxhash.xxh64_intdigest(word.lower(), 7) >> 2 if word else -1
    return found


def _term_sets(batches):
    schema = pa.schema([("label", pa.int32()), ("terms", pa.list_(pa.int64()))])
    for batch in slices(batches):
        words, codes, offsets = words_of(texts_of(batch))
        every = term_hashes(words)[codes]
        sets = [np.unique(every[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        yield record(schema, batch.column(0), [s[s >= 0] for s in sets])


def bounded_sample(docs, labels, per_label, label_column, id_column, text_column):
    """(label, terms) of at most ``per_label`` labelled rows of each of the labels 0 and 1."""
    usable = (labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
              .filter("label IN (0, 1) AND id IS NOT NULL"))
    chosen = first_by_hash(usable, "label", "id", per_label)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # At most 2 * per_label ids, a bound that does not grow with the tables.
    return rows.join(F.broadcast(chosen), "id").select("label", "text").mapInArrow(
        _term_sets, "label int, terms array<long>")


class Machine:
    def __init__(self, hashes, weights, factors, intercept):
        self.hashes, self.weights, self.factors, self.intercept = hashes, weights, factors, intercept

    def margins(self, columns, offsets):
        """Margins of texts whose distinct known terms are columns[offsets[i]:offsets[i + 1]]."""
        linear = sums_by_text(self.weights[columns], offsets)
        rows = self.factors[columns]
        total, squares = sums_by_text(rows, offsets), sums_by_text(rows * rows, offsets)
        return self.intercept + linear + 0.5 * (total * total - squares).sum(axis=1)

    def places(self, hashes):
        """Index of each hash in the model, -1 where it has none."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


#: Chi-square of one degree of freedom that one term in twenty reaches by chance.
BY_CHANCE = 3.84
#: Texts of label 1 are counted beside all texts in one number, exact up to 2^26 of each.
_TOXIC = 2.0 ** 26
#: Pairs of terms counted, and pairs of texts listed, in one step: some 20 MB each.
_CELLS, _LISTED = 250_000, 200_000
#: Terms of texts whose gradients are computed together: some 10 MB for each factor held.
_TOGETHER = 100_000


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def pair_evidence(y, columns, offsets, seen, hits, least):
    """For each term the most that one pair with another tells beyond both terms and beyond chance, 0 or more.

    That is the likelihood ratio (distributed as chi-square) of the pair's labels against the odds of both terms
    taken together, less what the best of as many pairs reaches by chance.
    """
    found = np.zeros(len(seen))
    rate = y.mean()
    odds = np.log((hits + rate) / (seen - hits + 1 - rate)) - np.log(rate / (1 - rate))
    owner = np.repeat(np.arange(len(y)), np.diff(offsets))
    columns = columns[np.lexsort((columns, owner))]  # ascending in each text: a pair is met once, at its lesser term
    order = np.argsort(columns, kind="stable")
    starts = np.searchsorted(columns[order], np.arange(len(seen) + 1))
    after = order + 1
    listed = np.append(0, np.cumsum(offsets[owner[order] + 1] - after))
    marks = 1.0 + _TOXIC * (y[owner[order]] == 1)
    tested, low = 0, 0
    while low < len(seen):
        width = len(seen) - low
        high = min(low + max(1, _CELLS // width), len(seen))
        counts = np.zeros((high - low) * width)
        begin, last = starts[low], starts[high]
        while begin < last:
            end = min(max(np.searchsorted(listed, listed[begin] + _LISTED, side="right") - 1, begin + 1), last)
            many = np.diff(listed[begin:end + 1])
            partners = columns[np.arange(many.sum()) + np.repeat(after[begin:end] - (listed[begin:end] - listed[begin]), many)]
            cells = np.repeat((columns[order[begin:end]] - low) * width, many) + partners - low
            counts += np.bincount(cells, weights=np.repeat(marks[begin:end], many), minlength=len(counts))
            begin = end
        cells = np.flatnonzero(counts % _TOXIC >= least)
        if len(cells):
            first, second = low + cells // width, low + cells % width
            n, h = counts[cells] % _TOXIC, counts[cells] // _TOXIC
            p = sigmoid(np.log(rate / (1 - rate)) + odds[first] + odds[second])
            told = 2 * (h * np.log(np.maximum(h, 1) / (n * p)) + (n - h) * np.log(np.maximum(n - h, 1) / (n * (1 - p))))
            np.maximum.at(found, first, told)
            np.maximum.at(found, second, told)
            tested += 2 * len(cells)
        low = high
    return np.maximum(found - 2 * np.log(max(tested, 1)), 0)


def _pairs_of_sample(y, codes, owner, seen, least):
    """pair_evidence of all terms, from the frequent ones: a pair of terms that tell nothing alone, in fewer texts
    than ``few``, cannot tell more than the best pair does by chance."""
    few = max(least, int(np.ceil(np.log(max(len(seen), 2)) / -np.log(min(y.mean(), 1 - y.mean())))))
    frequent = np.flatnonzero(seen >= few)
    place = np.full(len(seen), -1)
    place[frequent] = np.arange(len(frequent))
    columns = place[codes]
    known = columns >= 0
    columns, owner = columns[known], owner[known]
    found = np.zeros(len(seen))
    if len(columns) and 0 < y.sum() < len(y):
        offsets = np.searchsorted(owner, np.arange(len(y) + 1))
        total = np.bincount(columns, minlength=len(frequent))
        toxic = np.bincount(columns, weights=y[owner], minlength=len(frequent))
        found[frequent] = pair_evidence(y, columns, offsets, total, toxic, few)
    return found


def learn(labels, term_sets, least=3, factors=6, steps=60, rate=1.0, shrink=0.02):
    """Fits a Machine to bounded arrays; None if only one label is present."""
    y = np.asarray(labels, dtype=np.float64)
    if not 0 < y.sum() < len(y):
        return None
    owner = np.repeat(np.arange(len(y)), [len(t) for t in term_sets])
    every, codes = np.unique(np.concatenate(term_sets).astype(np.int64), return_inverse=True)
    seen = np.bincount(codes, minlength=len(every))
    hits = np.bincount(codes, weights=y[owner], minlength=len(every))
    expected = seen * y.mean()
    chi = np.where(seen >= least, (hits - expected) ** 2 / np.maximum(expected * (1 - seen / (len(y) + 1)), 1e-9), -1)
    paired = _pairs_of_sample(y, codes, owner, seen, least)
    evidence = np.maximum(chi, np.where(seen >= least, paired, -1))
    chosen = np.flatnonzero((chi >= BY_CHANCE) | (paired > 0))
    place = np.full(len(every), -1)
    place[chosen] = np.arange(len(chosen))
    columns = place[codes]
    known = columns >= 0
    columns, owner = columns[known], owner[known]
    offsets = np.searchsorted(owner, np.arange(len(y) + 1))
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))  # both labels weigh the same
    random = np.random.default_rng(11)
    model = Machine(every[chosen], np.zeros(len(chosen)), random.normal(0, 0.01, (len(chosen), factors)), 0.0)
    # The adaptive penalty: nothing to speak of for terms that tell the labels apart, out of reach for chance.
    pull, pull_factors = shrink / (1 + chi[chosen]), shrink / (1 + evidence[chosen])
    w_seen, v_seen, b_seen = np.full(len(chosen), 1e-8), np.full(model.factors.shape, 1e-8), 1e-8
    # Runs of whole texts, so that memory does not grow with the sample.
    edges = np.unique(np.searchsorted(offsets, np.arange(0, offsets[-1] + _TOGETHER, _TOGETHER)).clip(0, len(y)))
    if edges[-1] < len(y):
        edges = np.append(edges, len(y))
    for _ in range(steps):
        dw, dv, pulled = np.zeros(len(chosen)), np.zeros((len(chosen), factors)), 0.0
        for begin, end in zip(edges[:-1], edges[1:]):
            some = columns[offsets[begin]:offsets[end]]
            within = offsets[begin:end + 1] - offsets[begin]
            rows = model.factors[some]
            total = sums_by_text(rows, within)
            margins = (model.intercept + sums_by_text(model.weights[some], within)
                       + 0.5 * (total * total - sums_by_text(rows * rows, within)).sum(axis=1))
            error = (sigmoid(margins) - y[begin:end]) * share[begin:end]
            own = np.repeat(error, np.diff(within))
            dw += np.bincount(some, weights=own, minlength=len(chosen))
            seen_by = np.repeat(error[:, None] * total, np.diff(within), axis=0) - own[:, None] * rows
            for f in range(factors):
                dv[:, f] += np.bincount(some, weights=seen_by[:, f], minlength=len(chosen))
            pulled += error.sum()
        w_seen += dw ** 2
        v_seen += dv ** 2
        b_seen += pulled ** 2
        step = rate / np.sqrt(w_seen)
        moved = model.weights - step * dw
        model.weights = np.sign(moved) * np.maximum(np.abs(moved) - step * pull, 0)
        step = 0.3 * rate / np.sqrt(v_seen.sum(axis=1, keepdims=True))
        moved = model.factors - step * dv
        norm = np.linalg.norm(moved, axis=1, keepdims=True)
        model.factors = moved * np.maximum(1 - step * pull_factors[:, None] / np.maximum(norm, 1e-12), 0)
        model.intercept -= rate / np.sqrt(b_seen) * pulled
    used = (model.weights != 0) | (model.factors != 0).any(axis=1)
    return Machine(model.hashes[used], model.weights[used], model.factors[used], model.intercept)


def fit(docs, labels, per_label=4000, label_column="toxic", id_column="doc_id", text_column="text", **options):
    rows = bounded_sample(docs, labels, per_label, label_column, id_column, text_column).toPandas()
    return learn(rows["label"].to_numpy(), [np.asarray(t) for t in rows["terms"]], **options) if len(rows) else None


def _scores(model):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        machine = model.value
        for batch in slices(batches):
            if machine is None:
                yield record(schema, batch.column(0), np.zeros(batch.num_rows))
                continue
            words, codes, offsets = words_of(texts_of(batch))
            place = machine.places(term_hashes(words))[codes]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            width = len(machine.hashes) + 1
            pairs = np.unique(owner[place >= 0] * width + place[place >= 0])
            margins = machine.margins(pairs % width, np.searchsorted(pairs // width, np.arange(batch.num_rows + 1)))
            yield record(schema, batch.column(0), sigmoid(margins))
    return run


def score(docs, machine, id_column="doc_id", text_column="text"):
    """doc_id and score (0 to 1) of every row; reads only the text."""
    model = docs.sparkSession.sparkContext.broadcast(machine)
    return (docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
            .mapInArrow(_scores(model), "doc_id long, score double"))


def fit_and_score(docs, labels, held_out=1, **options):
    """Learns from labels whose crc32(doc_id) mod 3 is not ``held_out``; scores every row."""
    return score(docs, fit(docs, labels.filter(id_bucket("doc_id", 3) != held_out), **options))
