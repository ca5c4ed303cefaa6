"""Short licence notices in text, with a few typing errors allowed.

A text is reduced to its words: A-Z lower-cased, everything else in ASCII but digits is a gap, one space between words. A
notice of L characters may differ in k = min(3, L // 10) edits (insertions, deletions, substitutions of
characters), except in its exact words, which tell one licence from another. Cut into k + 1 pieces, at least one piece
of any such place is untouched: one pass of an Aho-Corasick automaton over all pieces finds the candidates, and each
piece fixes where the place can begin and end. In that window, of whole words, the regex library looks for the
best match within k edits. Exact places are confirmed by comparing the text at the first piece.

Nothing is shuffled; every text is read whole, a slice of texts at a time. Work grows with the text and with
the pieces in it.

Defined cases: a null text is empty: no words, no spans, score 0. Repeated rows give repeated results, an empty
table none; ids may be null. Very long texts are one slice each; positions of spans are in code points of
the original text. Extra columns are ignored.
"""

from bisect import bisect
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from .texts import record, slices, text_or_empty

# Label, notice, words that must be there exactly.
BASE = (
    ("mit", "under the mit license", "mit"),
    ("apache-2", "apache license version 2", "2"),
    ("cc-by-nc", "cc by nc", "cc by nc"),
)
NOTICES = BASE + (
    ("agpl-3", "gnu affero general public license version 3", "affero 3"),
    ("apache-2", "apache 2 0 license", "2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification", ""),
    ("cc-by-nc", "creative commons attribution noncommercial", ""),
    ("cc-by-sa", "cc by sa", "cc by sa"),
    ("cc-by-sa", "creative commons attribution sharealike", ""),
    ("cc0", "cc0 1 0 universal", "cc0 1 0"),
    ("gpl-2", "gnu general public license version 2", "2"),
    ("gpl-3", "gnu general public license version 3", "3"),
    ("lgpl-3", "gnu lesser general public license version 3", "lesser 3"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", ""),
    ("mpl-2", "mozilla public license version 2", "2"),
    ("unlicense", "this is free and unencumbered software released into the public domain", ""),
)
MOST_EDITS = 3
CHARACTERS_PER_EDIT = 10

_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_GAPS = bytes(c for c in range(128) if not chr(c).isalnum())
_PLAIN = bytes.maketrans(_UPPER + _GAPS, _LOWER + b" " * len(_GAPS))
_WORD = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_joined(text):
    """The words of a text (UTF-8) with single spaces between them."""
    return b" ".join(text.translate(_PLAIN).split()).decode("utf-8", "replace")


@dataclass
class Notice:
    label: str
    text: str
    exact: frozenset
    base: bool
    edits: int = 0
    pieces: list = field(default_factory=list)

    def __post_init__(self):
        self.edits = min(MOST_EDITS, len(self.text) // CHARACTERS_PER_EDIT)
        if all(word in self.exact for word in self.text.split()):
            self.edits = 0
        ends = [len(self.text) * i // (self.edits + 1) for i in range(self.edits + 2)]
        self.pieces = [(a, self.text[a:b]) for a, b in zip(ends, ends[1:])]
        # Runs of words that may be edited, with the exact words between them.
        groups = []
        for word in self.text.split():
            if word in self.exact or not groups or groups[-1][0]:
                groups.append((word in self.exact, [word]))
            else:
                groups[-1][1].append(word)
        parts = [" ".join(words) if exact or not self.edits else f"(?:{' '.join(words)}){{e<={self.edits}}}" for exact, words in groups]
        self.pattern = regex.compile(f"(?b)(?<![^ ]){' '.join(parts)}(?![^ ])")

    def window(self, text, at, offset):
        """The whole words within which a place of this notice lies, if a piece of it is at ``at``."""
        begin, end = at - offset - self.edits, at - offset + len(self.text) + self.edits
        if begin <= 0:
            begin = 0
        elif text[begin - 1] != " ":
            begin = text.find(" ", begin) + 1
            if not begin:
                return None
        end = len(text) if end >= len(text) else text.rfind(" ", 0, end + 1)
        return (begin, end) if begin < end else None

    def exactly(self, text, begin):
        """Whether the words of the notice stand at ``begin``."""
        end = begin + len(self.text)
        return (begin >= 0 and text.startswith(self.text, begin) and (begin == 0 or text[begin - 1] == " ")
                and (end == len(text) or text[end] == " "))


def _best(spans):
    """Of sorted spans of a notice: all exact ones, and of the others those that overlap none with as few edits."""
    exact, kept, last = [s for s in spans if not s[2]], [], None
    for span in spans:
        if not span[2]:
            continue
        place = bisect(exact, span)
        if any(e[0] < span[1] and span[0] < e[1] for e in exact[max(place - 1, 0):place + 1]):
            continue
        if last and span[0] < last[1]:
            last = min(last, span, key=lambda s: (s[2], s[0]))
            continue
        if last:
            kept.append(last)
        last = span
    return exact + kept + ([last] if last else [])


class Scanner:
    def __init__(self, notices, base):
        self.notices = [Notice(label, text, frozenset(exact.split()), (label, text, exact) in base) for label, text, exact in notices]
        by_piece = {}
        for notice in self.notices:
            for number, (offset, piece) in enumerate(notice.pieces):
                by_piece.setdefault(piece, []).append((notice, number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in by_piece.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def places(self, text):
        """[(begin, end, edits, notice)] in joined words, by begin: all exact places, and other places where no
        overlapping one of the same notice has fewer edits."""
        found, tried = {}, {}
        for last, (size, uses) in self.automaton.iter(text):
            at = last + 1 - size
            for notice, number, offset in uses:
                if number == 0 and notice.exactly(text, at):
                    found.setdefault(id(notice), (notice, set()))[1].add((at, at + len(notice.text), 0))
                if not notice.edits:
                    continue
                window = notice.window(text, at, offset)
                # Pieces of one place name nearly the same window; it comes again within the next few.
                recent = tried.setdefault(id(notice), [])
                if window is None or window in recent:
                    continue
                recent.append(window)
                del recent[:-8]
                match = notice.pattern.search(text, *window)
                if match and sum(match.fuzzy_counts) <= notice.edits:
                    found.setdefault(id(notice), (notice, set()))[1].add((*match.span(), sum(match.fuzzy_counts)))
        out = [(*span, notice) for notice, spans in found.values() for span in _best(sorted(spans))]
        return sorted(out, key=lambda p: (p[0], p[1], p[3].label))

    def scan(self, raw):
        """(number of words, [(label, base, word, begin, end, edits)]) of a text in UTF-8."""
        text = words_joined(raw)
        n_words = text.count(" ") + 1 if text else 0
        places = self.places(text)
        if not places:
            return n_words, []
        # Word numbers of both ends, counted on from the place before; then the code points of those words.
        ends, word, counted = [], 0, 0
        for begin, end, edits, notice in places:
            word += text.count(" ", counted, begin)
            counted = begin
            ends.append((word, word + text.count(" ", begin, end)))
        wanted = {w for pair in ends for w in pair}
        spans, last = {}, max(wanted)
        for number, match in enumerate(_WORD.finditer(raw.decode("utf-8", "replace"))):
            if number in wanted:
                spans[number] = match.span()
            if number == last:
                break
        return n_words, [(notice.label, notice.base and edits == 0, first, spans[first][0], spans[final][1], edits, 1 - edits / len(notice.text))
                         for (_, _, edits, notice), (first, final) in zip(places, ends)]


@lru_cache(maxsize=4)
def scanner(notices, base):
    """One scanner for each worker, kept over its tasks."""
    return Scanner(notices, base)


_SPAN = "label string, base boolean, word long, begin long, end long, edits int, score double"
_SPAN_ARROW = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("word", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()),
                         ("edits", pa.int32()), ("score", pa.float64())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(_SPAN_ARROW))])
_NAMES = [f.name for f in _SPAN_ARROW]


def _scanned(notices, base):
    def run(batches):
        known = scanner(notices, base)
        for batch in slices(batches):
            found = [known.scan(raw) for raw in batch.column("text").to_pylist()]
            yield record(_RESULT, batch.column(0), [n for n, _ in found],
                         [[dict(zip(_NAMES, span)) for span in spans] for _, spans in found])
    return run


def scan(docs, notices=NOTICES, base=BASE, id_column="doc_id", text_column="text"):
    """doc_id, n_words, spans of every row: label, whether it is an exact place of a base notice, first word (from 0),
    code points of begin and end, edits, and score (1 - edits / characters of the notice)."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).cast("binary").alias("text"))
    return rows.mapInArrow(_scanned(tuple(notices), tuple(base)), f"doc_id long, n_words long, spans array<struct<{_fields()}>>")


def _fields():
    return ", ".join(f"{name}: {kind}" for name, kind in (part.split() for part in _SPAN.split(", ")))
