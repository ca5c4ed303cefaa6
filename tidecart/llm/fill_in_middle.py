"""Fill-in-middle transformation by rotating blocks of a document in place.

A document is cut into prefix, middle and suffix at two places that follow from its id. Sentinels are inserted
before the three segments in a byte array, which then reads ``<P>prefix<M>middle<S>suffix``; one exchange of two
neighbouring blocks gives the form that is wanted:

    psm    <P>prefix<S>suffix<M>middle    middle and suffix with their sentinels change places
    spm    <S>suffix<P>prefix<M>middle    the suffix moves before all the rest

Blocks change places by three reversals (each block, then both together) within the array, a bounded piece at a time.
``restore`` finds the sentinels, undoes the rotation by the reversals in the opposite direction, and takes the
sentinels out. Places are counted in code points and turned into bytes by the lead bytes of the text.

Defined cases: a null text is empty; empty texts, texts that hold a sentinel, and those that the rates leave out
stay as they are (form ``plain``, no counts). A null id is written as an empty number; repeated rows are cut alike.
Texts of any length are transformed whole, in memory of a few times their size. Bytes that are no UTF-8 are kept.
An empty table gives no row. Extra columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .texts import record, slices, text_or_empty

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_PIECE = 1 << 16


def reverse(view, begin, end):
    """Reverses bytes of an array in place, swapping pieces from both ends."""
    end -= 1
    while begin < end:
        size = min(_PIECE, (end - begin + 1) // 2)
        head = view[begin:begin + size].copy()
        view[begin:begin + size] = view[end - size + 1:end + 1][::-1]
        view[end - size + 1:end + 1] = head[::-1]
        begin, end = begin + size, end - size


def exchange(view, begin, between, end):
    """Two neighbouring blocks change places."""
    reverse(view, begin, between)
    reverse(view, between, end)
    reverse(view, begin, end)


def byte_places(text, *places):
    """Byte offsets of places given in code points."""
    codes = np.frombuffer(text, dtype=np.uint8)
    leads = (codes & 0xC0) != 0x80
    if leads.all():
        return list(places)
    starts = np.append(np.flatnonzero(leads), len(codes))
    return [int(starts[p]) for p in places]


def rotated(text, form, first, second):
    """The transformed bytes of a text that is cut at two byte offsets."""
    array = bytearray(text)
    array[second:second] = SUFFIX
    array[first:first] = MIDDLE
    array[0:0] = PREFIX
    middle = len(PREFIX) + first
    suffix = middle + len(MIDDLE) + second - first
    view = np.frombuffer(array, dtype=np.uint8)
    if form == "psm":
        exchange(view, middle, suffix, len(array))
    else:
        exchange(view, 0, suffix, len(array))
    del view
    return array


def restored(output, form):
    """The text of transformed bytes."""
    if form == "plain":
        return bytes(output)
    array = bytearray(output)
    middle = array.index(MIDDLE)
    view = np.frombuffer(array, dtype=np.uint8)
    if form == "psm":
        suffix = array.index(SUFFIX)
        # The middle moves back before the suffix.
        exchange(view, suffix, middle, len(array))
        middle, suffix = suffix, suffix + len(array) - middle
    else:
        prefix = array.index(PREFIX)
        # The suffix, which comes first, moves back behind the rest.
        exchange(view, 0, prefix, len(array))
        middle, suffix = middle - prefix, len(array) - prefix
    del view
    del array[suffix:suffix + len(SUFFIX)]
    del array[middle:middle + len(MIDDLE)]
    del array[:len(PREFIX)]
    return bytes(array)


_OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
_OUTPUT_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                           ("middle_chars", pa.int64()), ("output", pa.binary())])


def _transform(batches):
    for batch in slices(batches):
        doc_id, n, form, prefix, middle, text = batch.columns
        out = []
        for kind, first, size, content in zip(form.to_pylist(), prefix.to_pylist(), middle.to_pylist(), text.to_pylist()):
            out.append(content if kind == "plain" else
                       bytes(rotated(content, kind, *byte_places(content, first, first + size))))
        yield record(_OUTPUT_ARROW, doc_id, n, form, prefix, middle, out)


def transform(docs, seed=1, plain_from=90, spm_below=20, id_column="doc_id", text_column="text"):
    """doc_id, n, form, prefix_chars, middle_chars, output (binary) of every row.

    Cuts and form follow from the SHA-256 of ``seed:doc_id``: of 100 documents some ``plain_from`` are transformed,
    ``spm_below`` of 100 of these with the suffix first.
    """
    text = text_or_empty(text_column)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).cast("binary"), 256)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"), digest.alias("digest"))
    number = lambda i: F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long")
    length = F.char_length("text").cast("long")
    cut = lambda i: number(i) % (length + 1)
    plain = (F.col("text") == "") | (number(2) % 100 >= plain_from)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        plain |= F.contains("text", F.lit(sentinel.decode()))
    form = F.when(plain, "plain").when(number(3) % 100 < spm_below, "spm").otherwise("psm")
    placed = rows.select("doc_id", length.alias("n"), form.alias("form"), F.least(cut(0), cut(1)).alias("first"),
                         F.greatest(cut(0), cut(1)).alias("second"), F.col("text").cast("binary").alias("text"))
    turned = F.col("form") != "plain"
    return placed.select(
        "doc_id", "n", "form", F.when(turned, F.col("first")).alias("prefix_chars"),
        F.when(turned, F.col("second") - F.col("first")).alias("middle_chars"), "text").mapInArrow(_transform, _OUTPUT)


def _restore(batches):
    for batch in slices(batches, column="output"):
        texts = [restored(o, f) for o, f in zip(batch.column("output").to_pylist(), batch.column("form").to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "restored"])


def restore(transformed):
    """The rows of ``transform`` with ``restored`` (binary), rebuilt from ``output`` and ``form`` alone."""
    rows = transformed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    return rows.mapInArrow(_restore, f"{_OUTPUT}, restored binary")
