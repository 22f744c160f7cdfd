"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import defaultdict
from fractions import Fraction
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, n):
    words = WORD.findall(lower(text))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def jaccard_components(rows, n, threshold):
    """Component names per row, in order."""
    threshold = Fraction(threshold)
    sets = [shingles(text, n) for _, text in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for run in s:
            holders[run].append(i)
    pairs = {p for at in holders.values() for p in combinations(at, 2)}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if both >= threshold * (len(sets[i]) + len(sets[j]) - both):
            up[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (id_, _) in enumerate(rows):
        ids[find(i)].append(id_)
    return [(rows[i][0], len(sets[i]),
             min((x for x in ids[find(i)] if x is not None), default=None))
            for i in range(len(rows))]


MARKS, CLOSERS = ".!?。．！？｡…।॥۔؟።།", "\"')]}”’»」』）】"


def sentences(text):
    """(words, start, end) of each sentence; its text reaches to the next one's first word."""
    words = [(m[0], m.start(), m.end()) for m in WORD.finditer(text)]
    out, now = [], []
    for i, (word, start, end) in enumerate(words):
        now.append(lower(word))
        closed = word[-1] in MARKS or len(word) > 1 and word[-1] in CLOSERS and word[-2] in MARKS
        gap = text[end:words[i + 1][1]] if i + 1 < len(words) else "\n"
        if closed or any(c in "\n\v\f\r" for c in gap):
            out.append(now)
            now = []
    return out


def sentence_runs(text, min_sentences, min_words):
    """{(first sentence, sentences): words}"""
    found, cut = {}, sentences(text)
    for i in range(len(cut)):
        for j in range(i + min_sentences, len(cut) + 1):
            if sum(map(len, cut[i:j])) >= min_words:
                found[i, j - i] = tuple(w for s in cut[i:j] for w in s)
                break
    for j in range(len(cut), 0, -1):
        for i in range(j - min_sentences, -1, -1):
            if sum(map(len, cut[i:j])) >= min_words:
                found[i, j - i] = tuple(w for s in cut[i:j] for w in s)
                break
    for i, words in enumerate(cut if min_sentences > 1 else []):
        if len(words) >= 50 or len(cut) == 1 and len(words) >= min_words:
            found[i, 1] = tuple(words)
    return found


def removed_sentences(rows, min_sentences, min_words):
    """Removed sentences per document, for documents with different ids."""
    where = defaultdict(list)
    for id_, text in rows:
        for (i, n), words in sentence_runs(text or "", min_sentences, min_words).items():
            where[words].append((id_, i, n))
    gone = defaultdict(set)
    for places in where.values():
        for id_, i, n in sorted(places)[1:]:
            gone[id_].update(range(i, i + n))
    return {id_: len(gone[id_]) for id_, _ in rows}


def tiles(item, doc, k):
    """Greedy string tiling by trying everything."""
    used_i, used_j, out = [False] * len(item), [False] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                       and not used_i[i + n] and not used_j[j + n]):
                    n += 1
                if n >= k and (best is None or (-n, i, j) < (-best[2], best[0], best[1])):
                    best = (i, j, n)
        if best is None:
            return out
        out.append(best)
        i, j, n = best
        used_i[i:i + n] = [True] * n
        used_j[j:j + n] = [True] * n
