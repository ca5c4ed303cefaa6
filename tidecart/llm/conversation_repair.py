"""Repair of conversations: the cheapest edits that leave ``(system? (user assistant)+)?``.

The edits are Keep (0), Rerole to user or assistant (1), Delete (2, required for blank and repeated turns) and
Insert of an empty user or assistant turn (5); a cut-off turn that is not deleted adds 5. Among the cheapest the
one whose initials in order (the audit) come first in ASCII order is taken.

One integer is both: its high digits are the cost, its low digits, three bits each and as many as an audit
can have, are the audit's letters from the left, with zeros behind its end. So the smaller integer is the
cheaper edit list, and of equally cheap ones the first in order, a prefix before what it begins. Edges run from
a place among the turns and a state of the pattern to a later one; the least integer of each node is found from
the end to the start. A letter put before an audit moves its digits one place to the right, which keeps
the order of any two, so a plain minimum at each node decides everything, and the audit is read off the result.

On Spark: only codes of the turns (initial, fault, digest) are dealt by conversation and sorted by turn for the
decision, which keeps those codes and four integers. Texts are dealt once, sorted beside their edits, and pass one by
one, so a conversation's texts are never in memory together, however long it is; its codes are (about 60 bytes
a turn, and audits of that length), and the integers make the time of a conversation of n turns grow with n * n / 64.

Defined cases: null ids make up one conversation; null roles and texts are one space; turns without a number come
first; equal numbers are ordered by the digest of role and text; repeated rows are repeated turns. Turns are
equal if the SHA-256 digests of their role and text are. Very long texts are read whole. An empty table gives no row; a
conversation without any turn left has cost 0 and an empty audit. Other columns are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .texts import record

SPACE = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
#: The state after the user or assistant turn that may come next.
NEXT = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
ROLE = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
LETTERS = " DIKR"
_BITS = 3


def kept_in(initial, state):
    """The state after a turn of that initial is kept, None where it may not follow."""
    if initial == "s":
        return AFTER_SYSTEM if state == START else None
    after = NEXT[state]
    return after if initial == ROLE[after][0] else None


def cheapest(turns):
    """(cost, audit) for the turns of one conversation, given as (initial of the role, fault)."""
    top = _BITS * (3 * len(turns) + 2)  # each turn's letter, and at most two inserts in each gap
    low = (1 << top) - 1
    edge = lambda letter, cost: (cost << top) + (LETTERS.index(letter) << top - _BITS)
    delete, insert = edge("D", 2), edge("I", 5)
    keep, rerole = {c: edge("K", c) for c in (0, 5)}, {c: edge("R", 1 + c) for c in (0, 5)}
    never = 1 << top + 60

    def moved(values):
        return [(v & ~low) + ((v & low) >> _BITS) for v in values]

    def with_inserts(values):
        once = moved(values)
        once = [min(values[s], insert + once[NEXT[s]]) for s in range(4)]
        twice = moved(once)
        return [min(values[s], insert + twice[NEXT[s]]) for s in range(4)]

    best = with_inserts([0, never, never, 0])
    for initial, fault in reversed(turns):
        rest, here = moved(best), []
        for state in range(4):
            least = delete + rest[state]
            if fault not in (BLANK, DUPLICATE):
                more = 5 if fault == TRUNCATED else 0
                after = kept_in(initial, state)
                if after is not None:
                    least = min(least, keep[more] + rest[after])
                least = min(least, rerole[more] + rest[NEXT[state]])
            here.append(least)
        best = with_inserts(here)
    value = best[START]
    audit, place = [], top - _BITS
    while place >= 0 and value >> place & 7:
        audit.append(LETTERS[value >> place & 7])
        place -= _BITS
    return value >> top, "".join(audit)


def replay(turns, audit):
    """([(place, new role or None, roles inserted before)] of the turns that stay, roles inserted at the end)."""
    stay, waiting, state, place = [], [], START, 0
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            waiting.append(ROLE[state])
            continue
        if letter == "K":
            stay.append((place, None, waiting))
            state, waiting = kept_in(turns[place][0], state), []
        elif letter == "R":
            state = NEXT[state]
            stay.append((place, ROLE[state], waiting))
            waiting = []
        place += 1
    return stay, waiting


# Order of rows within a conversation: turns without number, numbered turns, the conversation itself.
_EDIT = "conv_id long, rank int, turn long, digest binary, kind int, role string, text string, before array<string>"
_STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_DECIDED = f"{_EDIT}, {', '.join(f'{c} long' for c in _STATS)}, audit string"
_EDIT_FIELDS = [("conv_id", pa.int64()), ("rank", pa.int32()), ("turn", pa.int64()), ("digest", pa.binary()), ("kind", pa.int32()),
                ("role", pa.string()), ("text", pa.string()), ("before", pa.list_(pa.string()))]
_DECIDED_ARROW = pa.schema(_EDIT_FIELDS + [(c, pa.int64()) for c in _STATS] + [("audit", pa.string())])


def _spaced(column):
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def turns_of(frame, present=None):
    """conv_id, turn, role, text, present of a table; rows that are not ``present`` only name their conversation."""
    return frame.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        _spaced("role").alias("role"), _spaced("text").alias("text"),
                        (F.lit(True) if present is None else present).alias("present"))


def damage(frame):
    """Turns with planted faults: by the crc32 of ``conv_id:turn`` some are dropped, emptied, stripped of their
    full stops, repeated, or given to the user."""
    what = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20
    planted = turns_of(frame, what != 0).withColumn("what", what)
    once, again = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))
    return planted.select(
        "conv_id", "turn", F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        "present", F.explode(F.when(F.col("what") == 3, again).otherwise(once)).alias("copy")).drop("copy")


def _keys(turns):
    """Turns with the order of their rows and the digest of role and text."""
    text = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return turns.withColumns({"rank": F.when(F.col("turn").isNull(), 0).otherwise(1),
                              "digest": F.unhex(F.sha2(text.cast("binary"), 256))})


def _codes(turns):
    """One short row for each turn, dealt by conversation and in order."""
    stripped = F.rtrim("text", F.lit(SPACE))
    codes = _keys(turns).select(
        "conv_id", "present", "rank", "turn", "digest", F.substring("role", 1, 1).alias("initial"),
        (F.btrim(stripped, F.lit(SPACE)) == "").alias("blank"),
        (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("cut_off")).repartition("conv_id")
    first = F.row_number().over(Window.partitionBy("conv_id", "present", "digest").orderBy("rank", "turn"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("earlier") > 1, DUPLICATE).when(F.col("cut_off"), TRUNCATED).otherwise(0)
    return codes.withColumn("earlier", first).select(
        "conv_id", "present", "rank", "turn", "digest", "initial", fault.alias("fault"), "earlier",
    ).sortWithinPartitions("conv_id", "rank", "turn", "digest", "earlier").drop("earlier")


def _runs(batches):
    """The slices of each conversation's rows, from batches sorted by conversation."""
    held, current = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0)
        filled = ids.fill_null(0).to_numpy()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((filled[1:] != filled[:-1]) | (null[1:] != null[:-1])) + 1
        begin = 0
        for end in [*edges.tolist(), batch.num_rows]:
            key = (bool(null[begin]), int(filled[begin]))
            if held and key != current:
                yield held
                held = []
            current = key
            held.append(batch.slice(begin, end - begin))
            begin = end
    if held:
        yield held


_ROWS_OUT = 10_000


def _decide(batches):
    """Edits of the turns that stay, and one row for each conversation."""
    out = []
    for run in _runs(batches):
        table = pa.Table.from_batches(run)
        conv_id = table.column("conv_id")[0].as_py()
        table = table.filter(table.column("present"))
        turns = list(zip(table.column("initial").to_pylist(), table.column("fault").to_pylist()))
        cost, audit = cheapest(turns)
        stay, trailing = replay(turns, audit)
        numbers = table.column("turn").drop_null().to_numpy()
        gaps = int(numbers[-1]) - int(numbers[0]) + 1 - (1 + int(np.count_nonzero(np.diff(numbers)))) if len(numbers) else 0
        faults = [fault for _, fault in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(turns, turns[1:]))
        rank, turn, digest = table.column("rank"), table.column("turn"), table.column("digest")
        for place, role, before in stay:
            out.append((conv_id, rank[place].as_py(), turn[place].as_py(), digest[place].as_py(), 0, role, None, before) + (None,) * 7)
            if len(out) >= _ROWS_OUT:
                yield record(_DECIDED_ARROW, *zip(*out))
                out = []
        out.append((conv_id, 2, None, None, 0, None, None, trailing, gaps, *map(faults.count, (BLANK, DUPLICATE, TRUNCATED)),
                    illegal, cost, audit))
    if out:
        yield record(_DECIDED_ARROW, *zip(*out))


def edits(turns):
    """What is to be done: a row for each turn that stays (its new role where it changes, roles inserted before it),
    and a row of rank 2 for each conversation (counts of its faults, cost, audit, roles inserted at the end)."""
    return _codes(turns).mapInArrow(_decide, _DECIDED)


def _beside_texts(turns):
    """Edits, and after each the turn it is about, in the order of the conversations."""
    stored = _keys(turns.filter("present")).select(
        "conv_id", "rank", "turn", "digest", F.lit(1).alias("kind"), "role", "text", F.lit(None).cast("array<string>").alias("before"),
        *[F.lit(None).cast("long").alias(c) for c in _STATS], F.lit(None).cast("string").alias("audit"))
    order = ["conv_id", "rank", "turn", "digest", "kind"]
    return edits(turns).unionByName(stored).repartition("conv_id").sortWithinPartitions(*order)


def _repaired(batches):
    """(row of the conversation or None, conv_id, role, text) of each repaired turn in order, then of each conversation."""
    waiting = None
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in range(batch.num_columns)]
        for conv_id, rank, turn, digest, kind, role, text, before, *stats in zip(*columns):
            if rank == 2:
                for inserted in before:
                    yield None, conv_id, inserted, ""
                yield stats, conv_id, None, None
            elif kind == 0:
                waiting = (conv_id, rank, turn, digest), role, before
            elif waiting and waiting[0] == (conv_id, rank, turn, digest):
                for inserted in waiting[2]:
                    yield None, conv_id, inserted, ""
                yield None, conv_id, waiting[1] or role, text
                waiting = None  # further rows of that digest repeat it and go


_SUMMARY = f"conv_id long, {', '.join(f'{c} long' for c in _STATS)}, audit string, repaired_sha256 string"
_SUMMARY_ARROW = pa.schema([("conv_id", pa.int64())] + [(c, pa.int64()) for c in _STATS] + [("audit", pa.string()), ("repaired_sha256", pa.string())])


def _summaries(batches):
    out, hashed, begun = [], hashlib.sha256(), False
    for stats, conv_id, role, text in _repaired(batches):
        if stats is None:
            hashed.update((("\n" if begun else "") + f"{role}:{text}").encode())
            begun = True
            continue
        out.append((conv_id, *stats, hashed.hexdigest()))
        hashed, begun = hashlib.sha256(), False
        if len(out) >= _ROWS_OUT:
            yield record(_SUMMARY_ARROW, *zip(*out))
            out = []
    if out:
        yield record(_SUMMARY_ARROW, *zip(*out))


def summaries(turns):
    """conv_id, counts of faults, cost, audit, and the digest of the repaired ``role:text`` lines."""
    return _beside_texts(turns).mapInArrow(_summaries, _SUMMARY)


_TURN_ARROW = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _turns_out(batches):
    out, held, place = [], 0, 0
    for stats, conv_id, role, text in _repaired(batches):
        if stats is not None:
            place = 0
            continue
        out.append((conv_id, place, role, text))
        place, held = place + 1, held + len(text)
        if len(out) >= _ROWS_OUT or held > 4 << 20:
            yield record(_TURN_ARROW, *zip(*out))
            out, held = [], 0
    if out:
        yield record(_TURN_ARROW, *zip(*out))


def repaired(turns):
    """The repaired turns themselves: conv_id, turn (from 0 without gaps), role, text."""
    return _beside_texts(turns).mapInArrow(_turns_out, "conv_id long, turn long, role string, text string")
