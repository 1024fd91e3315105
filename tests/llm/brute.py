"""Plain versions of the operators for small inputs. Documents are dicts with doc_id, text, lang, source."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_counts(text):
    ws = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    windows = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    again = {i + k for i in range(len(ws) - 7) if windows[tuple(ws[i : i + 8])] > 1 for k in range(8)}
    stutter = sum(a == b for a, b in zip(ws, ws[1:]))
    symbols = sum(c in "#*$%&|<>" for w in ws for c in w)
    return len(ws), sum(map(len, ws)), symbols, len(lines) - len(set(lines)), len(again), stutter, len(lines)


def bucket(value):
    shift = max(0, value.bit_length() - 8)
    return value >> shift << shift


def quality(docs):
    """Kept or not, for each document."""
    rows = [(d, base_counts(d["text"])) for d in docs]
    measure = {
        id(d): {n: c[k] * 10000 // max(c[of], 1) for n, k, of in (("len", 1, 0), ("sym", 2, 0), ("dup", 3, 6), ("stu", 5, 0), ("rep", 4, 0))}
        for d, c in rows
    }

    def quantiles(group, name):
        values = sorted(bucket(measure[id(d)][name]) for d, c in group if c[0])
        return [next(v for i, v in enumerate(values, 1) if i * 10 >= len(values) * k) for k in (1, 5, 9)]

    out = []
    for d, c in rows:
        groups = [
            [r for r in rows if r[1][0] and (r[0]["lang"], r[0]["source"]) == (d["lang"], d["source"])],
            [r for r in rows if r[1][0] and r[0]["lang"] == d["lang"]],
            [r for r in rows if r[1][0]],
        ]
        failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
        group = next((g for g in groups if len(g) >= 200), groups[-1])
        for name, lower, least in (("len", True, 20000), ("sym", False, 1000), ("dup", False, 3000), ("stu", False, 2000), ("rep", False, 1000)):
            if not group or not c[0]:
                continue
            low, mid, high = quantiles(group, name)
            value = measure[id(d)][name]
            if value > max(high + 3 * (high - low), mid + least):
                failed = True
            if lower and value < min(low - 3 * (high - low), mid - least):
                failed = True
        out.append(not failed)
    return out


def tokens(line):
    return frozenset(w for w in re.split(r"[\x20\x09\x0B-\x0D]", line) if w)


def deduped_lines(docs):
    """Texts after line dedup."""
    places = [
        ((d["doc_id"] if d["doc_id"] is not None else float("inf"), k), tokens(line))
        for d in docs
        for k, line in enumerate((d["text"] or "").split("\n"))
    ]
    places = [p for p in places if p[1]]

    def stays(at, line):
        mine = tokens(line)
        if not mine:
            return True
        return not any(p < at and 7 * len(mine & other) >= 3 * (len(mine) + len(other)) for p, other in places)

    out = []
    for d in docs:
        first = d["doc_id"] if d["doc_id"] is not None else float("inf")
        kept = [line for k, line in enumerate((d["text"] or "").split("\n")) if stays((first, k), line)]
        out.append(None if d["text"] is None else "\n".join(kept))
    return out


def repeats(docs, size):
    """(n_words, n_removed, digest of what is left) of each document."""
    texts = [words(d["text"]) for d in docs]
    counts = Counter(tuple(w[s : s + size]) for w in texts for s in range(len(w) - size + 1))
    out = []
    for w in texts:
        gone = {s + k for s in range(len(w) - size + 1) if counts[tuple(w[s : s + size])] > 1 for k in range(size)}
        out.append((len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def shingle_set(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = words(lowered)
    if len(ws) < 5:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}


def components(docs):
    """The list of places of each document's component; documents without words have their own."""
    sets = [shingle_set(d["text"]) for d in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and Fraction(len(a & sets[j]), len(a | sets[j])) >= Fraction(3, 4):
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i in range(len(docs)):
        members[root(i)].append(i)
    return [members[root(i)] for i in range(len(docs))], sets


def component_ids(docs):
    groups, sets = components(docs)
    ids = [[docs[i]["doc_id"] for i in g if docs[i]["doc_id"] is not None] for g in groups]
    return [(len(s), min(g, default=None)) for s, g in zip(sets, ids)]


def one_of_each(docs):
    groups, sets = components(docs)
    order = lambda i: (docs[i]["doc_id"] is None, docs[i]["doc_id"] or 0, i)
    return [d for i, d in enumerate(docs) if not sets[i] or i == min(groups[i], key=order)]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def leaks(docs, benchmark):
    """{(doc_id, item_id): least distance}"""
    found = {}
    for d in docs:
        ws = re.findall(r"\w+", (d["text"] or "").lower())
        for item, text in benchmark:
            it = re.findall(r"\w+", (text or "").lower())
            if len(it) < 8:
                continue
            best = min(edit_distance(ws[s : s + len(it)], it) for s in range(max(1, len(ws) - len(it) + 1)))
            if best <= len(it) // 5:
                found[d["doc_id"], item] = best
    return found
