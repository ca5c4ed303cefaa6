"""Plain versions of the operators, for small tables: dictionaries, loops over all pairs, the public libraries."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as public
import tiktoken
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def exact(rows):
    """rows: (doc_id, text). Returns (doc_id, keep_id, group_size, kept, sha) for each row."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(lower_az(text), []).append(doc_id)
    out = []
    for doc_id, text in rows:
        members = groups[lower_az(text)]
        best = max((m for m in members if m is not None), default=None)
        out.append((doc_id, best, len(members), doc_id == best, sha(lower_az(text))))
    return out


def lines(rows, least):
    documents = {}
    for doc_id, text in rows:
        documents[doc_id, text or ""] = [lower_az(x.strip(" \t\n\x0b\f\r")) for x in (text or "").split("\n")]
    seen = Counter(k for keys in documents.values() for k in set(keys) if k)
    out = []
    for doc_id, text in rows:
        pairs = list(zip((text or "").split("\n"), documents[doc_id, text or ""]))
        kept = [line for line, key in pairs if seen[key] < least or not key]
        out.append((doc_id, len(pairs), len(pairs) - len(kept), sha("\n".join(kept))))
    return out


def fingerprint(text):
    words = WORD.findall(lower_az(text))
    runs = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) > 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(rows):
    """(doc_id, fingerprint, component_id) by comparing all pairs."""
    prints = np.array([fingerprint(t) for _, t in rows], dtype=np.uint64)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 4).tolist():
            parent[max(root(i), root(j))] = min(root(i), root(j))
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in (lowest.get(root(i)), doc_id) if x is not None]
        lowest[root(i)] = min(known, default=None)
    return [(doc_id, format(int(prints[i]), "016x"), lowest[root(i)]) for i, (doc_id, _) in enumerate(rows)]


def bare_words(text):
    found = []
    for word in (text or "").split():
        while word and not word[0].isalnum():
            word = word[1:]
        while word and not word[-1].isalnum():
            word = word[:-1]
        if word:
            found.append(word.lower())
    return found


def leaks(rows, items):
    """{(doc_id, item_id): similarity} over every window of every document."""
    out = {}
    for item_id, item in items:
        item = bare_words(item)
        if not item:
            continue
        size = min(5, len(item))
        own = Counter(tuple(item[i:i + size]) for i in range(len(item) - size + 1))
        long = sum(own.values())
        for doc_id, text in rows:
            words = bare_words(text)
            every = [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]
            if not own.keys() & set(every):
                continue
            for i in range(len(every)):
                window = Counter(every[i:i + long])
                shared = sum((window & own).values())
                alike = shared / (sum(window.values()) + long - shared)
                if alike >= 0.8:
                    out[doc_id, item_id] = max(alike, out.get((doc_id, item_id), 0))
    return out


SECRETS = [
    ("assign", re.compile(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
                          r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 1, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
]


def secrets(text):
    found = [(m.start(), k, m.end()) for k, (_, pattern, group, least) in enumerate(SECRETS)
             for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return [f"{SECRETS[k][0]}:{a}:{b}" for a, k, b in sorted(found)]


def language_model(rows, pseudo):
    """{doc_id: (n_tokens, n_known, base, score)} and the number of training tokens."""
    tokens = lambda text: WORD.findall(lower_az(text)) + [None]
    words, pairs, starts = Counter(), Counter(), 0
    for doc_id, text in rows:
        if doc_id is not None and remainder(doc_id, 5) != 1:
            found = tokens(text)
            words.update(found)
            pairs.update(zip([0] + found[:-1], found))
            starts += 1
    number, distinct = sum(words.values()), len(words)
    context = {**words, 0: starts}
    plain = lambda w: (words[w] + 0.5) / (number + 0.5 * (distinct + 1))
    out = {}
    for doc_id, text in rows:
        found = tokens(text)
        score = sum(math.log10((pairs[v, w] + pseudo * plain(w)) / (context.get(v, 0) + pseudo)) for v, w in zip([0] + found[:-1], found))
        out[doc_id] = (len(found), sum(words[w] > 0 for w in found), sum(math.log10(plain(w)) for w in found), score)
    return out, number


def byte_pairs():
    with open(public.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
