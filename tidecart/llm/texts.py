"""Helpers that the text operators share: null-safe text columns, bounded slices of Arrow batches,
words of a slice, and where lineage is cut."""

import os
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text that a task works on at a time (a single longer text is a slice of its own).
SLICE_BYTES = 4 << 20


def text_or_empty(column="text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lower_ascii(column):
    """Lower-cases A-Z only; whole-string lower() where the text has no other characters."""
    ascii_only = F.octet_length(column) == F.char_length(column)
    return F.when(ascii_only, F.lower(column)).otherwise(F.translate(column, UPPER, LOWER))


def spare(columns, *names):
    """Names like the given ones that no column has yet, for columns that a caller's table must not clash with."""
    taken, free = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free


def id_bucket(column, modulus):
    """crc32 of the id as text, modulo; null for a null id."""
    return (F.crc32(F.col(column).cast("string").cast("binary")) % modulus).cast("int")


def first_by_hash(rows, key, ident, limit):
    """The ``limit`` rows of each key that come first by the hash of ``ident`` (more than one column: a list of names).

    A key is counted first, and only rows under a hash that some twice ``limit`` of them fall under are ranked, so a
    key with most of the rows brings no more of them together than any other. One row for each key is broadcast.
    """
    names = [ident] if isinstance(ident, str) else list(ident)
    hashed = F.xxhash64(*names)
    counted, total, place = spare(rows.columns, "counted", "total", "place")
    counts = rows.groupBy(F.col(key).alias(counted)).agg(F.count(F.lit(1)).alias(total))
    share = F.shiftrightunsigned(hashed, 24) / F.lit(float(1 << 40))
    likely = rows.join(F.broadcast(counts), F.col(key) == F.col(counted)).filter(share * F.col(total) < 2 * limit + 100)
    # Unsigned, as the share is.
    order = Window.partitionBy(key).orderBy(F.shiftrightunsigned(hashed, 24), *names)
    return likely.withColumn(place, F.row_number().over(order)).filter(F.col(place) <= limit).select(*[f"`{c}`" for c in rows.columns])


def slices(batches, limit=SLICE_BYTES, column="text"):
    """Cuts each Arrow batch into runs of rows of at most about ``limit`` bytes of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        begin, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


def texts_of(batch, column="text"):
    return pc.fill_null(batch.column(column), "")


def words_of(texts):
    """Splits texts at ASCII white space: (distinct words, codes of all words in order, offsets by text)."""
    parts = pc.ascii_split_whitespace(texts)
    flat = parts.flatten()
    owner = pc.list_parent_indices(parts)
    filled = pc.not_equal(flat, "")
    flat, owner = flat.filter(filled), owner.filter(filled).to_numpy()
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1))
    coded = flat.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), offsets


_LETTER, _MARK, _LINE_END = 1, 2, 3
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", dtype=np.uint8)] = _LETTER
_KIND[np.frombuffer(b".,;:!?", dtype=np.uint8)] = _MARK
_KIND[ord("\n")] = _LINE_END


def cuts_within(data, offsets):
    """(places in ``data`` within words where GPT-2's pattern begins a match in any text, 1 + number of the word of each).

    These are the places between an ASCII letter or digit and a mark, and those around a single line end between such
    characters: no match holds both sides, and none looks further than the line end. ``offsets`` are those of the words.
    """
    kind = _KIND[data]
    # Beside a word's ends nothing is seen of its neighbours.
    places = np.flatnonzero(kind > _LETTER)
    word = np.searchsorted(offsets, places, side="right") - 1
    begins, ends = places == offsets[word], places + 1 == offsets[word + 1]
    before = np.where(begins, 0, kind[places - 1])
    after = np.where(ends, 0, kind[np.minimum(places + 1, len(data) - 1)])
    marks = kind[places] == _MARK
    alone = ~marks & np.isin(before, (_LETTER, _MARK)) & np.isin(after, (_LETTER, _MARK))
    # A mark after a line end that stands alone is cut there already.
    cut = np.concatenate([places[marks & (before == _LETTER)], places[alone], places[alone] + 1])
    word = np.concatenate([word[marks & (before == _LETTER)], word[alone], word[alone]])
    order = np.argsort(cut, kind="stable")
    return cut[order], word[order] + 1


def _cut(words, bounds):
    """(pieces of all words, offsets by text, whether each is a later piece of its word)."""
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int32)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(data or b"", dtype=np.uint8)
    if not offsets[-1]:
        return words, bounds, np.zeros(len(words), dtype=bool)
    places, word = cuts_within(data[:offsets[-1]], offsets)
    later = np.insert(np.zeros(len(words), dtype=bool), word, True)
    pieces = pa.StringArray.from_buffers(len(later), pa.py_buffer(np.insert(offsets, word, places.astype(np.int32))), words.buffers()[2])
    return pieces, bounds + np.searchsorted(word, bounds, side="right"), later


def _by_place(words, codes, later, after_space, inside):
    """(ids of the words after a space and of those inside a word, code of each piece); a word may be asked for both."""
    use = np.zeros((2, len(words)), dtype=bool)
    use[0, codes[~later]] = True
    use[1, codes[later]] = True
    place = np.cumsum(use.ravel()) - 1
    entries = after_space([words[i] for i in np.flatnonzero(use[0]).tolist()])
    entries += inside([words[i] for i in np.flatnonzero(use[1]).tolist()])
    return entries, place[np.where(later, codes + len(words), codes)]


def joined_ids(texts, after_space, of_texts, end=None, special=(), inside=None):
    """Token ids of texts from the ids of their different words: (ids of all texts, offsets by text).

    ``after_space(words)`` gives the ids (bytes of 4-byte numbers) of each word with a space before it, or None where a
    neighbour can change them; ``of_texts(texts)`` those of texts as they are, for first words and for texts
    with such words or with one of the ``special`` strings. Each text is followed by the id ``end``, if there is one.
    With ``inside``, words are cut further (``cuts_within``), and it gives the ids of pieces that no space is before, as
    ``after_space`` does.
    """
    if not len(texts):
        return np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
    split = pc.split_pattern(texts, " ")
    pieces, bounds, later = split.flatten(), split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py(), None
    if inside is not None:
        pieces, bounds, later = _cut(pieces, bounds)
    coded = pieces.dictionary_encode()
    codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
    if later is None:
        entries = after_space(words)
    else:
        entries, codes = _by_place(words, codes, later, after_space, inside)
    unsafe = np.array([ids is None for ids in entries], dtype=bool)
    heads, sizes = bounds[:-1], np.diff(bounds)
    # The first word has no space before it; a text whose words depend on each other is one entry.
    alone = np.add.reduceat(unsafe[codes].astype(np.int64), heads) > unsafe[codes[heads]]
    for token in special:
        alone |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
    first = coded.dictionary.take(coded.indices.take(pa.array(heads))).to_pylist()
    alone |= np.array([w[-1].isspace() if w else n > 1 for w, n in zip(first, sizes.tolist())], dtype=bool)
    inner = ~np.repeat(alone, sizes)
    inner[heads] = True
    codes = codes.copy()
    codes[heads] = len(entries) + np.arange(len(heads))
    entries += of_texts([texts[row].as_py() if single else word for row, (single, word) in enumerate(zip(alone.tolist(), first))])
    entries = [e or b"" for e in entries]
    held = np.where(alone, 1, sizes)
    if end is not None:
        entries.append(np.array([end], dtype=np.int32).tobytes())
        held = held + 1
    lengths = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries)) // 4
    flat = np.frombuffer(b"".join(entries), dtype=np.int32)
    begins = np.cumsum(lengths) - lengths
    ends = np.cumsum(held) - 1
    stream = np.full(int(held.sum()), len(entries) - 1, dtype=np.int64)
    filled = np.ones(len(stream), dtype=bool)
    if end is not None:
        filled[ends] = False
    stream[filled] = codes[inner]
    taken = lengths[stream]
    total = np.cumsum(taken)
    at = np.repeat(begins[stream] - (total - taken), taken)
    at += np.arange(len(at))
    return flat[at], np.append(0, total[ends])


def sums_by_text(values, offsets):
    """Sums of rows of ``values`` (one per word) for each text; zeros for texts without words."""
    total = np.zeros((len(offsets),) + values.shape[1:], dtype=np.float64)
    filled = np.flatnonzero(np.diff(offsets))
    if len(filled):
        total[filled] = np.add.reduceat(values, offsets[filled], axis=0, dtype=np.float64)
    return total[:-1]


def record(schema, *columns):
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) if not isinstance(c, (pa.Array, pa.ChunkedArray))
                                       else c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def cut(frame):
    """Writes a frame to the folder in spark.checkpoint.dir, so that lost executors cost no recomputation."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return frame.checkpoint()


def importable(spark):
    """Lets Python workers that have this package's folder find it; elsewhere ship it with ``--py-files``."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
