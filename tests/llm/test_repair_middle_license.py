"""Conversation repair, fill-in-middle and licence notices against plain versions and awkward rows."""

import hashlib
import itertools
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from compare import assert_same, connect
from tidecart.llm import conversation_repair as repair
from tidecart.llm import fill_in_middle as middle
from tidecart.llm import license_scan as licences
from tidecart.llm.queries import ORACLE, QUERIES
from tidecart.sources.tables import table

sys.setrecursionlimit(10_000)
FOLDER = "/root/testdata/sf0.001"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# Conversation repair


def every_edit(turns):
    """(cost, audit) of all edit lists with up to two inserts in a gap, the least of them."""
    def walk(i, last, cost, audit, inserts):
        if i == len(turns) and last in ("", "a"):
            yield cost, audit
        if inserts < 2:
            yield from walk(i, NEXT[last], cost + 5, audit + "I", inserts + 1)
        if i == len(turns):
            return
        initial, fault = turns[i]
        yield from walk(i + 1, last, cost + 2, audit + "D", 0)
        if fault in (repair.BLANK, repair.DUPLICATE):
            return
        more = 5 if fault == repair.TRUNCATED else 0
        if initial == NEXT[last] or initial == "s" and last == "":
            yield from walk(i + 1, initial, cost + more, audit + "K", 0)
        yield from walk(i + 1, NEXT[last], cost + 1 + more, audit + "R", 0)
    return min(walk(0, "", 0, "", 0))


def plain_repair(turns):
    """The same least pair, of tuples, from the end."""
    @lru_cache(maxsize=None)
    def best(i, last, inserts):
        options = [(0, "")] if i == len(turns) and last in ("", "a") else []
        add = lambda cost, letter, rest: rest and options.append((cost + rest[0], letter + rest[1]))
        if inserts < 2:
            add(5, "I", best(i, NEXT[last], inserts + 1))
        if i < len(turns):
            initial, fault = turns[i]
            add(2, "D", best(i + 1, last, 0))
            if fault not in (1, 2):
                more = 5 if fault == 3 else 0
                if initial == NEXT[last] or initial == "s" and last == "":
                    add(more, "K", best(i + 1, initial, 0))
                add(1 + more, "R", best(i + 1, NEXT[last], 0))
        return min(options, default=None)
    return best(0, "", 0)


def test_least_integer_is_least_edit_list():
    for n in range(4):
        for turns in itertools.product([("u", 0), ("a", 0), ("s", 0), ("x", 0), ("u", 1), ("a", 3), ("s", 3)], repeat=n):
            assert repair.cheapest(list(turns)) == every_edit(turns) == plain_repair(turns), turns
    rng = random.Random(3)
    for _ in range(400):
        turns = tuple((rng.choice("uuaasx "), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(4, 40)))
        assert repair.cheapest(list(turns)) == plain_repair(turns), turns


def plain_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        spaced = lambda v: " " if v is None else str(v)
        what = zlib.crc32(f"{spaced(conv_id)}:{spaced(turn)}".encode()) % 20
        role, text = "user" if what == 4 else spaced(role), spaced(text)
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        out += [(conv_id, turn, role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    return out


def plain_summary(conv_id, rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
    numbers = [r[1] for r in rows if r[1] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    turns, seen = [], set()
    for _, _, role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        turns.append((role[:1], 1 if not shown else 2 if (role, text) in seen else 0 if shown[-1] in ".!?" else 3))
        seen.add((role, text))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    cost, audit = plain_repair(tuple(turns))
    lines, last, left = [], "", iter(rows)
    for letter in audit:
        role = {"u": "user", "a": "assistant"}[NEXT[last]]
        if letter == "I":
            lines.append(f"{role}:")
            last = NEXT[last]
            continue
        row = next(left)
        if letter == "K":
            lines.append(f"{row[2]}:{row[3]}")
            last = row[2][:1]
        elif letter == "R":
            lines.append(f"{role}:{row[3]}")
            last = NEXT[last]
    count = [f for _, f in turns].count
    return conv_id, gaps, count(1), count(2), count(3), illegal, cost, audit, sha("\n".join(lines)), lines


def plain_summaries(rows):
    damaged = plain_damage(rows)
    return {i: plain_summary(i, [r for r in damaged if r[0] == i]) for i in {r[0] for r in rows}}


ODD_TURNS = [
    (1, 0, "user", "Hello."), (1, 1, "assistant", "Yes."), (1, None, "system", "Rule."), (1, None, None, None), (1, 1, "assistant", "Yes."),
    (2, 5, "user", "cut off"), (2, 9, "assistant", "Fine! "), (2, 9, "", "no role."), (2, 10, "user", " \t\r\n"),
    (3, None, None, None), (None, 1, "user", "Who?"), (None, 2, "assistant", "Nobody."), (None, None, "tool", "x y. "),
    (4, 3, "user", "a:b\nc."), (4, 3, "user", "a:b\nc."), (4, 3, "assistant", "Same turn."), (5, 2, "sun", "Odd initial?"), (5, 3, "uncle", "Why."),
    (5, 4, "aunt", "So."), (6, 1, "system", "Only a rule."), (7, -3, "assistant", "Backwards."), (7, -7, "user", "First."),
] + [(8, n, ("user", "assistant")[n % 2], f"Turn {n % 250}." if n % 9 else f"no end {n}") for n in range(400)] \
  + [(9, 1, "user", "long words " * 100_000 + "."), (9, 2, "assistant", "Ok.")] + [(100 + n, 0, "user", "Hi.") for n in range(60)]


@pytest.fixture(scope="module")
def odd_turns(spark):
    return spark.createDataFrame([(*r, "x", 1, b"y", 7) for r in ODD_TURNS],
                                 "conv_id long, turn long, role string, text string, what string, rank int, digest binary, kind int")


def summary_rows(frame):
    return {r.conv_id: (r.conv_id, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in frame.collect()}


def test_repair_of_odd_turns(odd_turns):
    expected = {i: s[:-1] for i, s in plain_summaries(ODD_TURNS).items()}
    damaged = repair.damage(odd_turns)
    assert summary_rows(repair.summaries(damaged)) == expected
    assert summary_rows(repair.summaries(damaged.repartition(7, F.rand(3)))) == expected
    gone = [i for i in expected if i is not None and i >= 100 and not any(r[0] == i for r in plain_damage(ODD_TURNS))]
    assert gone and all(expected[i][1:] == (0, 0, 0, 0, 0, 0, "", sha("")) for i in gone)


def test_repaired_turns_themselves(odd_turns):
    lines = {}
    for r in repair.repaired(repair.damage(odd_turns)).orderBy("conv_id", "turn").collect():
        held = lines.setdefault(r.conv_id, [])
        assert r.turn == len(held)
        held.append(f"{r.role}:{r.text}")
    assert lines == {i: s[-1] for i, s in plain_summaries(ODD_TURNS).items() if s[-1]}


def test_undamaged_turns_and_empty_tables(odd_turns):
    rows = [(i, t, " " if r is None else r, " " if x is None else x) for i, t, r, x in ODD_TURNS]
    found = summary_rows(repair.summaries(repair.turns_of(odd_turns)))
    assert found == {i: plain_summary(i, [r for r in rows if r[0] == i])[:-1] for i in {r[0] for r in rows}}
    assert repair.summaries(repair.damage(odd_turns.limit(0))).count() == 0 == repair.repaired(repair.damage(odd_turns.limit(0))).count()


def test_repair_query(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert summary_rows(QUERIES["op11_conversation_repair"](spark, FOLDER)) == {i: s[:-1] for i, s in plain_summaries(rows).items()}


def test_a_conversation_of_many_turns(spark):
    n = 5_000
    turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                  F.concat(F.lit("Turn "), F.col("id"), F.lit(".")).alias("text"))
    row = repair.summaries(repair.turns_of(turns)).first()
    assert (row.cost, row.audit) == (0, "K" * n)


# Fill in the middle


ODD_TEXTS = [(1, "plain words here"), (2, None), (3, ""), (4, "x"), (5, "holds <M> itself"), (6, "Ünï\U0001f600cödé 東京都 \x00 end"), (7, "<<S<P<S"),
             (7, "<<S<P<S"), (None, "no id"), (None, "other text without id"), (8, "ends with <"), (9, "é" * 70_001 + "<S"), (10, "a" * 300_000)] \
    + [(20 + i, f"text {i} with <P and S> parts " * (i % 4)) for i in range(80)]


def plain_middle(doc_id, text):
    text = text or ""
    numbers = [int(sha(f"1:{'' if doc_id is None else doc_id}")[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(n % (len(text) + 1) for n in numbers[:2])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or numbers[2] % 100 >= 90:
        return doc_id, len(text), "plain", None, None, text, text
    p, m, s = text[:a], text[a:b], text[b:]
    spm = numbers[3] % 100 < 20
    return doc_id, len(text), "spm" if spm else "psm", a, b - a, f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}", text


@pytest.fixture(scope="module")
def odd_docs(spark):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in ODD_TEXTS], "doc_id long, text string, form string, n int, output string")


def as_text(rows):
    return sorted((tuple(bytes(v).decode() if isinstance(v, (bytes, bytearray)) else v for v in r) for r in rows), key=repr)


def test_middle_of_odd_texts(odd_docs):
    found = as_text(middle.restore(middle.transform(odd_docs)).collect())
    assert found == as_text(plain_middle(*r) for r in ODD_TEXTS)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}
    assert middle.restore(middle.transform(odd_docs.limit(0))).count() == 0


def test_other_rates(odd_docs):
    assert {r.form for r in middle.transform(odd_docs, plain_from=0).collect()} == {"plain"}
    rows = middle.restore(middle.transform(odd_docs, seed=7, plain_from=100, spm_below=100)).collect()
    assert all(bytes(r.restored) == (bytes(r.output) if r.form == "plain" else bytes(r.restored)) for r in rows)
    assert {r.form for r in rows} == {"plain", "spm"} and as_text((r.restored,) for r in rows) == as_text((t or "",) for _, t in ODD_TEXTS)


def test_rotations_are_undone():
    rng = random.Random(5)
    for _ in range(300):
        text = bytes(rng.choice(b"<PSM>ab") for _ in range(rng.randrange(1, 40)))
        if any(s in text for s in (b"<P>", b"<S>", b"<M>")):
            continue
        a, b = sorted(rng.randrange(len(text) + 1) for _ in range(2))
        for form in ("psm", "spm"):
            assert middle.restored(bytes(middle.rotated(text, form, a, b)), form) == text
    import numpy as np
    for size in (0, 1, 2, middle._PIECE - 1, middle._PIECE * 2 + 1, middle._PIECE * 5):
        data = np.random.default_rng(size).integers(0, 256, size, dtype=np.uint8)
        turned = data.copy()
        middle.reverse(turned, 0, size)
        assert (turned == data[::-1]).all()


def test_middle_sql(spark):
    assert_same(QUERIES["op12_fill_in_middle"](spark, FOLDER), connect(FOLDER), ORACLE["op12_fill_in_middle"])


# Licence notices


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_base(text):
    words, places = plain_words(text), []
    for label, phrase, _ in licences.BASE:
        phrase = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(phrase)] == phrase]
    return len(words), sorted(places)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def least_edits(words, notice):
    """Fewest edits of the groups between exact words, for words that make up the whole place."""
    groups = []
    for word in notice.text.split():
        exact = word in notice.exact
        if not exact and groups and not groups[-1][0]:
            groups[-1][1].append(word)
        else:
            groups.append((exact, [word]))

    def fit(text, rest):
        exact, group = rest[0]
        group = " ".join(group)
        if len(rest) == 1:
            return (0 if text == group else 99) if exact else distance(text, group)
        least = 99
        for cut in range(len(text)):
            if text[cut] == " ":
                here = (0 if text[:cut] == group else 99) if exact else distance(text[:cut], group)
                if here <= notice.edits:
                    least = min(least, here + fit(text[cut + 1:], rest[1:]))
        return least
    return fit(" ".join(words), groups)


def plain_labels(text):
    words, found = plain_words(text), {label for _, label in plain_base(text)[1]}
    for notice in licences.scanner(licences.NOTICES, licences.BASE).notices:
        for i in range(len(words)):
            for j in range(i + 1, min(len(words), i + len(notice.text.split()) + notice.edits) + 1):
                if abs(len(" ".join(words[i:j])) - len(notice.text)) <= notice.edits and least_edits(words[i:j], notice) <= notice.edits:
                    found.add(notice.label)
    return sorted(found)


NOTICE_TEXTS = [
    "Released UNDER the MIT License.", "under the mit licence", "undr the MIT lisence", "under the mpl license", "under the mitt license",
    "Apache License, Version 2.0", "Apache Licence; version-2", "apache license version 1", "apachelicense version 2", "Apachee Licence versjon 2",
    "CC BY-NC 4.0", "cc by nd", "cc-by-sa", "under the mit license under the mit license cc by nc apache license version 2",
    "GNU General Public License, version 3", "gnu generl public licence v ersion 3", "gnu lesser general public license version 3", "", None,
    "under the mit", "mit license", "éunder the mit license", "under the mit licensé", " under the mit license ", "under\x00the\x1fmit_license",
    "under thé mit license", "apache 2.0 license", "Mozilla Public License version 2 and under the mitlicense", "the under the mit license2",
]


def test_notices_with_errors(spark):
    rng = random.Random(11)
    texts = list(NOTICE_TEXTS)
    for _ in range(120):
        text = list(" ".join(["some words", rng.choice(licences.NOTICES)[1], "and more"]))
        for _ in range(rng.randrange(1, 5)):
            place = rng.randrange(len(text))
            text[place:place + rng.randrange(2)] = rng.choice(["", "x", " ", "e", "2"])
        texts.append("".join(text))
    docs = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, spans string, label string")
    for row in licences.scan(docs).collect():
        text = texts[row.doc_id]
        number, base = plain_base(text)
        assert row.n_words == number
        assert sorted((s.word, s.label) for s in row.spans if s.base) == base
        assert sorted({s.label for s in row.spans}) == plain_labels(text), text
        for s in row.spans:
            shown = plain_words(text[s.begin:s.end])
            assert plain_words(text)[s.word] == shown[0]
            assert any(n.label == s.label and abs(1 - s.edits / len(n.text) - s.score) < 1e-9 and least_edits(shown, n) == s.edits
                       for n in licences.scanner(licences.NOTICES, licences.BASE).notices)


def test_notices_in_long_texts_and_repeats(spark):
    long = "er the license of all words under the mit license, " * 100_000
    rows = [(1, long), (1, long), (None, "CC BY-NC"), (2, "z" * 3_000_000), (3, "the mit " * 400_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in licences.scan(docs).collect()}
    assert len(found[1].spans) == 100_000 and found[1].spans[-1].word == 10 * 99_999 + 6
    assert [s.label for s in found[None].spans] == ["cc-by-nc"] and not found[2].spans and not found[3].spans
    assert licences.scan(docs.limit(0)).count() == 0


def test_license_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
    for row in QUERIES["op13_license_scan"](spark, FOLDER).collect():
        number, base = plain_base(texts[row.doc_id])
        labels = lambda found: ",".join(sorted(set(found)))
        words = [w for w, _ in base]
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == (
            number, len(base), min(words, default=None), max(words, default=None), labels(label for _, label in base))
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) and 0 <= row.score <= 1
