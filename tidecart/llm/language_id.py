"""Language identification by unigram pieces with marginalised segmentations.

Each language has probabilities of the pieces of a fixed public vocabulary. A word's probability in a
language is the sum over all its segmentations into pieces, by a forward recursion over its characters;
a text's score is the product over its words. Piece probabilities are fitted by expectation maximisation
(forward-backward counts) on a bounded sample of labelled rows: ``per_language`` rows for each language,
those with the smallest hash of the id. Everything else covers all rows and whole texts.

Defined cases: null texts and texts without letters give ``und`` with score 0; ties go to the first
language by name; without any labelled row every text is ``und``. Words are runs between ASCII white
space, reduced to letters and lower-cased, and summed over all cuts however long they are: the sums are
rescaled on the way, and words over ``_BLOCK`` letters are taken in blocks that hand on the sums at their edge. Only
fitting takes words over ``LEARNED`` letters in parts. Repeated rows, null ids and extra columns change nothing. The
score is the posterior of the chosen language with equal priors, with the evidence counted as at most ``EVIDENCE``
words so that long texts stay comparable, and less by the share of letters that no piece covers: a text of such
letters alone has the score 1 / languages.
"""

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .texts import cut, first_by_hash, id_bucket, record, slices, sums_by_text, texts_of, words_of

UNDETERMINED = "und"
EVIDENCE = 50.0
#: Letters of one run in fitting.
LEARNED = 4096
#: Letters between two rescalings of the sums.
RESCALED = 16
#: Probability of a letter that no piece covers, and weight of the common distribution in smoothing.
UNKNOWN, PRIOR = 1e-7, 50.0
#: Bytes of text scored at a time, and letters in one lattice: 160,000 take some 80 MB.
_SLICE, _BLOCK = 2 << 20, 160_000
_RESULT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


@lru_cache(maxsize=2)
def pieces_of(model):
    """The lower-cased letter pieces of a sentencepiece vocabulary; ``^`` marks the start of a word."""
    import sentencepiece

    vocabulary = sentencepiece.SentencePieceProcessor(model_file=model)
    found = set()
    for i in range(vocabulary.get_piece_size()):
        if vocabulary.is_control(i) or vocabulary.is_unknown(i) or vocabulary.is_byte(i):
            continue
        piece = vocabulary.id_to_piece(i).replace("▁", "^").lower()
        if all(c.isalpha() for c in piece.lstrip("^")) and piece.count("^") < 2:
            found.add(piece)
    return tuple(sorted(found))


def letters(word):
    return word.lower() if word.isalpha() else "".join(c for c in word if c.isalpha()).lower()


def learned_runs(word):
    """Runs of at most LEARNED letters, the first with the mark of a word's start."""
    return ["^" * (i == 0) + word[i:i + LEARNED] for i in range(0, len(word), LEARNED)]


def parts_by_letters(items, size, limit=_BLOCK):
    """Cuts a list into parts of at most about ``limit`` letters, one item at least."""
    part, held = [], 0
    for item in items:
        if part and held + size(item) > limit:
            yield part
            part, held = [], 0
        part.append(item)
        held += size(item)
    if part:
        yield part


class Trie:
    """The pieces as a double array: the child of ``node`` by ``c`` is slot base[node] + c if check says so."""

    def __init__(self, vocabulary):
        alphabet = sorted({c for piece in vocabulary for c in piece})
        self.width = len(alphabet) + 1
        self.longest = max(map(len, vocabulary), default=1)
        self.alone = np.zeros(0x110000, dtype=bool)
        self.alone[[ord(piece) for piece in vocabulary if len(piece) == 1]] = True
        self.codes = np.zeros(0x110000, dtype=np.int32)
        self.codes[[ord(c) for c in alphabet]] = np.arange(1, self.width)
        children, ends = [{}], [-1]
        for number, piece in enumerate(vocabulary):
            node = 0
            for c in piece:
                c = int(self.codes[ord(c)])
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][c]
            ends[node] = number
        room = len(children) + 2 * self.width
        check, base, piece = [-1] * room, [0] * room, [-1] * room
        check[0], low, pending = -2, 1, [(0, 0)]
        for node, slot in pending:
            codes = sorted(children[node])
            piece[slot] = ends[node]
            if not codes:
                base[slot] = 0
                continue
            while check[low] != -1:
                low += 1
            start = max(0, low - codes[0])
            while any(check[start + c] != -1 for c in codes):
                start += 1
            base[slot] = start
            if start + 2 * self.width >= len(check):
                more = start + 3 * self.width - len(check)
                check, base, piece = check + [-1] * more, base + [0] * more, piece + [-1] * more
            for c in codes:
                check[start + c] = slot
                pending.append((children[node][c], start + c))
        self.check, self.base, self.piece = (np.array(a, dtype=np.int32) for a in (check, base, piece))
        self.pieces = len(vocabulary)


class Lattice:
    """All ways to cut runs into pieces, as arcs between positions; row ``trie.pieces`` is the unknown letter.

    With ``own``, only arcs from the first ``own`` letters of each run are taken.
    """

    def __init__(self, trie, runs, own=None):
        lengths = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
        codes = trie.codes[np.frombuffer("".join(runs).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        stop = np.cumsum(lengths)
        run = np.repeat(np.arange(len(runs)), lengths)
        limit = stop[run]
        at, node, depth, found = np.arange(len(codes)), np.zeros(len(codes), dtype=np.int64), 0, []
        while len(at):
            slot = trie.base[node] + codes[at + depth]
            real = (trie.check[slot] == node) & (codes[at + depth] > 0)
            at, node = at[real], slot[real].astype(np.int64)
            depth += 1
            piece = trie.piece[node]
            hit = piece >= 0
            found.append((at[hit], at[hit] + depth, piece[hit]))
            more = at + depth < limit[at]
            at, node = at[more], node[more]
        bare = np.ones(len(codes), dtype=bool)
        if found:
            bare[found[0][0]] = False
        bare = np.flatnonzero(bare)
        found.append((bare, bare + 1, np.full(len(bare), trie.pieces)))
        start, end, self.piece = (np.concatenate(x) for x in zip(*found))
        self.run = run[start]
        level = start - (stop - lengths)[self.run]
        order = np.argsort(level, kind="stable")
        if own is not None:
            order = order[:np.searchsorted(level[order], own)]
        # Positions of a run are its letters and one more, so each run has its own end.
        self.start, self.end, self.piece, self.run = (
            (start + self.run)[order], (end + self.run)[order], self.piece[order].astype(np.int64), self.run[order])
        self.levels = np.append(np.flatnonzero(np.diff(level[order], prepend=-1)), len(order))
        self.first, self.last = stop - lengths + np.arange(len(runs)), stop + np.arange(len(runs))
        self.size, self.reach = len(codes) + len(runs), np.arange(trie.longest + 1)

    def _rescaled(self, sums, level):
        """Makes the largest of the sums from ``level`` on, as far as a piece reaches, 1 in each longer run: (runs, logs)."""
        runs = np.flatnonzero(self.last - self.first > level)
        at = np.minimum(self.first[runs, None] + level + self.reach, self.last[runs, None])
        values = sums[at]
        peak = values.max(axis=1, keepdims=True)
        peak[peak == 0] = 1
        sums[at] = values / peak
        return runs, np.log(peak[:, 0])

    def forward(self, weights, begin=None):
        """Sums over all cuts up to each position (weights by arc, with any further axes), and logarithms to add to them.

        A position's logarithm is the sum of the returned ones from its run's first position to its own. ``begin``
        gives the sums at the first positions of a single run.
        """
        sums, logs = np.zeros((self.size,) + weights.shape[1:]), np.zeros((self.size,) + weights.shape[1:])
        if begin is None:
            sums[self.first] = 1
        else:
            sums[:len(begin)] = begin
        for level, (a, b) in enumerate(zip(self.levels[:-1], self.levels[1:])):
            if level and level % RESCALED == 0:
                runs, by = self._rescaled(sums, level)
                logs[self.first[runs] + level] = by
            sums[self.end[a:b]] += sums[self.start[a:b]] * weights[a:b]  # the arcs of a level have different ends
        return sums, logs

    def backward(self, weights):
        """As forward, from the ends; a position's logarithm takes in those less than a piece before it."""
        sums, logs = np.zeros(self.size), np.zeros(self.size)
        sums[self.last] = 1
        for level in range(len(self.levels) - 2, -1, -1):
            a, b = self.levels[level], self.levels[level + 1]
            np.add.at(sums, self.start[a:b], sums[self.end[a:b]] * weights[a:b])
            if level and level % RESCALED == 0:
                runs, by = self._rescaled(sums, level)
                logs[self.first[runs] + level] = by
        return sums, logs

    def expected(self, weights, times):
        """Expected use of each arc, for runs that were seen ``times`` times."""
        ahead, ahead_logs = self.forward(weights)
        behind, behind_logs = self.backward(weights)
        ahead_logs = np.cumsum(ahead_logs)  # a run's first position adds nothing, but runs before it do
        behind_logs = np.append(np.cumsum(behind_logs[::-1])[::-1], 0)
        reached = np.maximum(self.end - len(self.reach) + 1, self.first[self.run])
        logs = (ahead_logs[self.start] - ahead_logs[self.last[self.run]]
                + behind_logs[reached] - behind_logs[self.last[self.run] + 1])
        return ahead[self.start] * weights * behind[self.end] * np.exp(logs) / ahead[self.last[self.run]] * times[self.run]


def log_probability(trie, table, run):
    """Log-probabilities of one long run in each language, block by block."""
    total, begin = np.zeros(table.shape[1]), np.ones((1, table.shape[1]))
    for at in range(0, len(run), _BLOCK):
        own = min(_BLOCK, len(run) - at)
        lattice = Lattice(trie, [run[at:at + own + trie.longest]], own)
        sums, logs = lattice.forward(table[lattice.piece], begin)
        edge = sums[own:]
        peak = edge.max(axis=0)
        total += logs.sum(axis=0) + np.log(peak)
        begin = edge / peak
    return total


def log_probabilities(trie, table, words):
    """Log-probabilities of words (letters only) in each language: the sums over all their cuts."""
    found = np.zeros((len(words), table.shape[1]))
    short = []
    for place, word in enumerate(words):
        if len(word) < _BLOCK:
            short.append((place, "^" + word))
        else:
            found[place] = log_probability(trie, table, "^" + word)
    for part in parts_by_letters(short, lambda item: len(item[1])):
        lattice = Lattice(trie, [run for _, run in part])
        sums, logs = lattice.forward(table[lattice.piece])
        found[[place for place, _ in part]] = np.log(sums[lattice.last]) + np.add.reduceat(logs, lattice.first, axis=0)
    return found


def bounded_sample(docs, per_language, id_column, lang_column, text_column):
    """Texts and languages of at most ``per_language`` labelled rows of each language."""
    labelled = docs.select(F.col(lang_column).alias("lang"), F.col(id_column).alias("id")).filter("lang IS NOT NULL")
    chosen = first_by_hash(labelled, "lang", "id", per_language).distinct()
    rows = docs.select(F.col(lang_column).alias("lang"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # At most languages * per_language ids, a bound that does not grow with the table.
    return rows.join(F.broadcast(chosen), ["lang", "id"]).select("lang", "text")


def _word_counts(batches):
    for frame in batches:
        counts = {}
        for lang, text in zip(frame["lang"], frame["text"]):
            for word in (text or "").split():
                word = letters(word)
                if word:
                    counts[lang, word] = counts.get((lang, word), 0) + 1
        yield pd.DataFrame([(lang, word, n) for (lang, word), n in counts.items()], columns=["lang", "word", "n"])


def with_unknown(table):
    return np.vstack([table, np.full((1, table.shape[1]), UNKNOWN)])


def fit(docs, vocabulary, per_language=500, rounds=3, id_column="doc_id", lang_column="lang", text_column="text"):
    """(languages, table of piece probabilities): fitted on the labelled rows of ``docs``.

    What reaches the driver is bounded by languages times pieces.
    """
    sample = bounded_sample(docs, per_language, id_column, lang_column, text_column)
    words = cut(sample.mapInPandas(_word_counts, "lang string, word string, n long")
                .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    languages = sorted(r.lang for r in words.select("lang").distinct().collect())
    place = {lang: i for i, lang in enumerate(languages)}
    table = np.full((len(vocabulary), max(1, len(languages))), 1.0 / max(1, len(vocabulary)))
    trie = Trie(vocabulary)
    for _ in range(rounds if languages else 0):
        model = words.sparkSession.sparkContext.broadcast((trie, with_unknown(table)))

        def count(batches):
            known, weights = model.value
            for frame in batches:
                every = [(run, place[lang], n) for lang, word, n in zip(frame["lang"], frame["word"], frame["n"])
                         for run in learned_runs(word)]
                for runs in parts_by_letters(every, lambda r: len(r[0])):
                    lattice = Lattice(known, [r[0] for r in runs])
                    language = np.array([r[1] for r in runs])[lattice.run]
                    used = lattice.expected(weights[lattice.piece, language], np.array([r[2] for r in runs], dtype=float))
                    cells, at = np.unique(language * len(weights) + lattice.piece, return_inverse=True)
                    yield pd.DataFrame({"lang": cells // len(weights), "piece": cells % len(weights), "n": np.bincount(at, weights=used)})

        counts = np.zeros_like(table)
        for row in (words.mapInPandas(count, "lang int, piece int, n double")
                    .groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()):
            if row.piece < len(vocabulary):
                counts[row.piece, row.lang] = row.n
        common = (counts.sum(axis=1) + 0.01) / (counts.sum() + 0.01 * len(vocabulary))
        table = (counts + PRIOR * common[:, None]) / (counts.sum(axis=0) + PRIOR)
        model.unpersist()
    return languages, table


class Model:
    """Trie, languages and table, and in each worker the log-probabilities of up to ``cached`` recent words."""

    def __init__(self, trie, languages, table, cached=250_000):
        self.trie, self.languages, self.table, self.cached = trie, languages, table, cached
        self.places, self.rows = {}, None

    def __getstate__(self):
        return {**self.__dict__, "places": {}, "rows": None}

    def log_probabilities(self, words):
        """By word and language; words not seen lately are computed together and remembered."""
        if self.rows is None or len(self.places) + len(words) > len(self.rows):
            self.places, self.rows = {}, np.zeros((self.cached + len(words), self.table.shape[1]))
        places = self.places
        new = [word for word in words if word not in places]
        if new:
            begin = len(places)
            self.rows[begin:begin + len(new)] = log_probabilities(self.trie, self.table, new)
            places.update(zip(new, range(begin, begin + len(new))))
        return self.rows[np.fromiter(map(places.__getitem__, words), dtype=np.int64, count=len(words))]


def predictions(model, texts):
    """(language, score) of each text."""
    languages, width = model.languages, model.table.shape[1]
    words, codes, offsets = words_of(texts)
    bare = [letters(word) for word in words]
    distinct = sorted({word for word in bare if word})
    place = {word: i for i, word in enumerate(distinct)}
    rows = np.zeros((len(distinct) + 1, width + 3))  # the last row: words without letters
    rows[:-1, :width] = model.log_probabilities(distinct)
    rows[:-1, width] = 1
    if distinct:
        lengths = np.fromiter(map(len, distinct), dtype=np.int64, count=len(distinct))
        covered = model.trie.alone[np.frombuffer("".join(distinct).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        rows[:-1, width + 1] = np.add.reduceat(covered.astype(np.float64), np.cumsum(lengths) - lengths)
        rows[:-1, width + 2] = lengths
    at = np.array([place.get(word, len(distinct)) for word in bare], dtype=np.int64)
    sums = sums_by_text(rows[at[codes]], offsets)
    count = sums[:, width]
    told_share = sums[:, width + 1] / np.maximum(sums[:, width + 2], 1)
    tempered = sums[:, :width] * (told_share * np.minimum(1, EVIDENCE / np.maximum(count, 1)))[:, None]
    shares = np.exp(tempered - tempered.max(axis=1, keepdims=True))
    shares /= shares.sum(axis=1, keepdims=True)
    best = sums[:, :width].argmax(axis=1)
    told = (count > 0) & bool(languages)
    names = [languages[b] if ok else UNDETERMINED for b, ok in zip(best, told)]
    return names, np.where(told, shares[np.arange(len(best)), best], 0.0)


def _scorer(model):
    def run(batches):
        for batch in slices(batches, _SLICE):
            yield record(_RESULT, batch.column(0), *predictions(model.value, texts_of(batch)))
    return run


def _keeper(model, text_column):
    def run(batches):
        for batch in slices(batches, _SLICE, text_column):
            names, _ = predictions(model.value, texts_of(batch, text_column))
            yield batch.filter(pa.array([name != UNDETERMINED for name in names], pa.bool_()))
    return run


def shared_model(docs, languages, table, vocabulary):
    return docs.sparkSession.sparkContext.broadcast(Model(Trie(vocabulary), languages, with_unknown(table)))


def identify(docs, languages, table, vocabulary, id_column="doc_id", text_column="text"):
    """One row per row of ``docs``: doc_id, lang_pred, score. Reads only the text."""
    model = shared_model(docs, languages, table, vocabulary)
    return (docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
            .mapInArrow(_scorer(model), "doc_id long, lang_pred string, score double"))


def keep_told(docs, languages, table, vocabulary, text_column="text"):
    """The rows of ``docs``, with all columns, for which ``identify`` names a language."""
    model = shared_model(docs, languages, table, vocabulary)
    return docs.mapInArrow(_keeper(model, text_column), docs.schema)


def learn(docs, model_file, held_out=2, **options):
    """(languages, table, vocabulary), from labelled rows whose crc32(doc_id) mod 4 is not ``held_out``."""
    vocabulary = pieces_of(model_file)
    return *fit(docs.filter(id_bucket("doc_id", 4) != held_out), vocabulary, **options), vocabulary
