"""Secret scans by grammar inference.

Fixed patterns find the base spans. From the credentials they label, one probabilistic automaton for each kind is
inferred: a prefix tree of the values, whose states are merged in order of depth wherever the frequencies of
ending and of each next character, and those of all following states, differ by no more than a Hoeffding
bound allows. A further automaton is inferred from other long runs of characters. Each candidate, a run of
16 characters or more of the credential alphabet outside the base spans, is scored by the log-likelihood ratio of
its best format against that background; spans above both thresholds are added as ``like_`` kinds. Base spans
are scored by the format of their own kind, and stay whatever their score.

The grammars are learned from a bounded sample of labelled values: all documents are searched, and of the different
values of each kind ``per_kind`` with the smallest hash are taken, values over ``longest`` characters left out. The
scan covers every row and its whole text, in time that grows with the text (a text of many megabytes too).

Defined cases: null texts are empty. Without labelled credentials of a kind that kind adds no spans. Ties
between formats go to the first kind listed. Repeated rows, null ids and extra columns need no care.
"""

import math
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .texts import record, slices, texts_of

#: The base patterns, the kinds in order, and the least length of what counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Thresholds of an added span: nats in all, and nats per character.
LEAST_TOTAL, LEAST_MEAN = 10.0, 0.4
FLOOR = 1e-6
#: The sample is drawn from this many ranges (as a power of 2) of the hash first.
_SLICE_BITS = 6


def base_spans(text):
    """(kind, start, end, value) of the base patterns, by start and then kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in WORDS):
        found += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    if longest_word(text) >= 24:
        found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def longest_word(text):
    return max(map(len, text.split()), default=0)


def candidates(text, spans):
    """Runs of the credential alphabet that no base span touches."""
    if longest_word(text) < 16:
        return []
    found, ahead, covered = [], 0, 0
    for m in CANDIDATE.finditer(text):
        # Spans come by their start: the farthest end of those that begin before this run tells whether one touches it.
        while ahead < len(spans) and spans[ahead][1] < m.end():
            covered = max(covered, spans[ahead][2])
            ahead += 1
        if covered <= m.start():
            found.append((m.start(), m.end(), m[0]))
    return found


class Automaton:
    """A deterministic probabilistic automaton inferred by state merging."""

    def __init__(self, values, doubt=0.05):
        self.count, self.ends, self.next = [0], [0], [{}]
        for value in values:
            state = 0
            for c in value:
                self.count[state] += 1
                if c not in self.next[state]:
                    self.next[state][c] = [len(self.count), 0]
                    self.count.append(0)
                    self.ends.append(0)
                    self.next.append({})
                arc = self.next[state][c]
                arc[1] += 1
                state = arc[0]
            self.count[state] += 1
            self.ends[state] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / doubt))
        self._merge_all()
        self._weigh()

    def _differ(self, hits, n, other_hits, m):
        return n and m and abs(hits / n - other_hits / m) > self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, a, b):
        pending = [(a, b)]
        while pending:
            a, b = pending.pop()
            n, m = self.count[a], self.count[b]
            if self._differ(self.ends[a], n, self.ends[b], m):
                return False
            for c in self.next[a].keys() | self.next[b].keys():
                x, y = self.next[a].get(c), self.next[b].get(c)
                if self._differ(x[1] if x else 0, n, y[1] if y else 0, m):
                    return False
                if x and y and x[0] != y[0]:
                    pending.append((x[0], y[0]))
        return True

    def _fold(self, a, b):
        """Adds the tree below b to state a; returns the states that have changed."""
        pending, changed = [(a, b)], []
        while pending:
            a, b = pending.pop()
            changed.append(a)
            self.count[a] += self.count[b]
            self.ends[a] += self.ends[b]
            for c, (target, n) in self.next[b].items():
                arc = self.next[a].get(c)
                if arc is None:
                    self.next[a][c] = [target, n]
                else:
                    arc[1] += n
                    pending.append((arc[0], target))
        return changed

    def _merge_all(self):
        """Red states are settled; each state below them joins the first compatible red state or becomes one."""
        red, settled, pending = [0], {0}, deque([0])
        while pending:
            state = pending.popleft()
            for c in sorted(self.next[state]):
                blue = self.next[state][c][0]
                if blue in settled:
                    continue
                match = next((r for r in red if self._compatible(r, blue)), None)
                if match is None:
                    red.append(blue)
                    settled.add(blue)
                    pending.append(blue)
                else:
                    self.next[state][c][0] = match
                    # A fold may hang new states under settled ones.
                    pending.extend(s for s in self._fold(match, blue) if s in settled)
        self.states = red

    def _weigh(self):
        self.stop, self.arcs = {}, {}
        for state in self.states:
            n = self.count[state]
            self.stop[state] = math.log(max(self.ends[state] / n if n else 0, FLOOR))
            self.arcs[state] = {c: (math.log(hits / n), target) for c, (target, hits) in self.next[state].items()}

    def log_likelihood(self, value):
        """Log-probability; a missing arc costs FLOOR and starts over."""
        total, state, missing = 0.0, 0, math.log(FLOOR)
        for c in value:
            arc = self.arcs[state].get(c)
            if arc is None:
                total, state = total + missing, 0
            else:
                total, state = total + arc[0], arc[1]
        return total + self.stop[state]


def infer(rows, least=5):
    """(background, {kind: Automaton}) from (kind, value) rows; kind -1 is the background."""
    values = {}
    for kind, value in rows:
        values.setdefault(kind, []).append(value)
    kinds = {k: Automaton(sorted(v)) for k, v in values.items() if k >= 0 and len(v) >= least}
    return Automaton(sorted(values.get(-1, []))), kinds


def likelihood(value, kind, background, kinds):
    """How much likelier a value is as one of its kind than as plain text (logarithm); None for a kind not learned."""
    return kinds[kind].log_likelihood(value) - background.log_likelihood(value) if kind in kinds else None


def like(value, background, kinds):
    """The kind whose format explains a candidate well enough, or None."""
    plain, best = background.log_likelihood(value), None
    for kind in sorted(kinds):
        ratio = kinds[kind].log_likelihood(value) - plain
        if ratio >= LEAST_TOTAL and ratio >= LEAST_MEAN * len(value) and (best is None or ratio > best[0]):
            best = (ratio, kind)
    return best


def _labelled(batches):
    schema = pa.schema([("kind", pa.int32()), ("value", pa.string())])
    for batch in slices(batches):
        kinds, values = [], []
        for text in texts_of(batch).to_pylist():
            spans = base_spans(text)
            for kind, value in [(s[0], s[3]) for s in spans] + [(-1, c[2]) for c in candidates(text, spans)]:
                kinds.append(kind)
                values.append(value)
        yield record(schema, kinds, values)


def learn(docs, per_kind=1500, longest=128, id_column="doc_id", text_column="text"):
    """Automata from at most ``per_kind`` different labelled values of each kind, up to ``longest`` characters long.

    All documents are searched for values, so a rare format is learned wherever it is. The values that come first by
    their hash are taken, in two steps: of each of ``2 ** _SLICE_BITS`` ranges of the hash, then of those together.
    """
    hashed = F.xxhash64("value")
    slice_of = F.shiftrightunsigned(hashed, 64 - _SLICE_BITS)
    in_slice = Window.partitionBy("kind", slice_of).orderBy(hashed, "value")
    in_kind = Window.partitionBy("kind").orderBy(slice_of, hashed, "value")
    found = (docs.select(F.col(text_column).alias("text")).mapInArrow(_labelled, "kind int, value string")
             .filter(F.length("value") <= longest).distinct())
    first = found.withColumn("place", F.row_number().over(in_slice)).filter(F.col("place") <= per_kind)
    chosen = first.withColumn("place", F.row_number().over(in_kind)).filter(F.col("place") <= per_kind)
    return infer([(r.kind, r.value) for r in chosen.select("kind", "value").orderBy("kind", "value").collect()])


def _scan(model):
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))])

    def run(batches):
        background, kinds = model.value
        for batch in slices(batches):
            every = []
            for text in texts_of(batch).to_pylist():
                spans = base_spans(text)
                found = [(start, kind, end, likelihood(value, kind, background, kinds)) for kind, start, end, value in spans]
                for start, end, value in candidates(text, spans):
                    best = like(value, background, kinds)
                    if best is not None:
                        found.append((start, len(KINDS) + best[1], end, best[0]))
                every.append([{"kind": KINDS[k] if k < len(KINDS) else "like_" + KINDS[k - len(KINDS)],
                               "start": start, "end": end, "score": score} for start, k, end, score in sorted(found, key=lambda s: s[:2])])
            yield record(schema, batch.column(0), every)
    return run


def scan(docs, model, id_column="doc_id", text_column="text"):
    """doc_id and spans (kind, start, end in code points, score; null for a base kind without a format) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return (docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
            .mapInArrow(_scan(shared), "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double>>"))


def written(spans):
    """kind:start:end of spans, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def is_base(span):
    return ~span["kind"].startswith("like_")


def number_of(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
