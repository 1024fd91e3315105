"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelloom.llm import spellings


def plain(rows):
    counts = Counter()
    for number, text in rows:
        for run in re.findall(r"[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if number is None else number}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        return len(long) - len(short) == 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))

    partners = {a: [b for b in words if near(a, b)] for a in words}
    best = {a: min(p, key=lambda b: (-words[b], b), default=None) for a, p in partners.items()}
    form = {a: b if b is not None and words[b] >= 10 * words[a] else None for a, b in best.items()}

    def root(a):
        return a if form[a] is None else root(form[a])

    return {a: (n, form[a], words[form[a]] if form[a] else None, root(a), len(partners[a])) for a, n in words.items()}


def made_rows():
    rng = random.Random(5)
    base = ["Thingsten", "größeren", "ciónmente", "aaaaaaab", "letterer", "séparément", "conjunction"]
    letters = "abcdeéßöx"

    def variant(word):
        at = rng.randrange(len(word))
        return rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]])

    rows = []
    for k in range(120):
        said = [rng.choice(base) for _ in range(20)]
        said += [variant(w) for w in said[:6]] + [variant(variant(w)) for w in said[:3]] + [variant(variant(w)) for w in said[:3]] * 2
        rows.append((k, rng.choice([" ", "\n", "1", "-", "×"]).join(said)))
    rows += [(900, "aaaaaaaa " * 400 + "aaaaaaaaa " * 30 + "aaaaaaaaaa " * 3)]  # a chain of forms
    rows += [(901, "twinword twinword twinwore twinwore twinworf twinworf"), (901, "twinword")]  # ties, a row id that repeats
    rows += [(902, None), (None, "Nullword nullword"), (None, ""), (903, "short runs only, ab cd"), (904, "x" * 5000 + " " + "x" * 5000)]
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(*r, "clash", 1, "root") for r in made_rows()]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, n int, root string").repartition(3)


def test_groups_equal_the_plain_version(frame):
    got = {r.word: (r.n, r.form, r.form_n, r.root, r.n_near) for r in spellings.spelling_groups(frame).collect()}
    want = plain(made_rows())
    assert got == want
    assert sum(v[1] is not None for v in want.values()) > 20
    chain = want["aaaaaaaaaa"]
    assert chain[1] == "aaaaaaaaa" and chain[3] == "aaaaaaaa"


def test_words_are_handed_on_in_bounded_pieces(frame, monkeypatch):
    monkeypatch.setattr(spellings, "COUNTED_AT_ONCE", 5)
    got = {r.word: r.n for r in spellings.word_counts(frame).collect()}
    assert got == {w: v[0] for w, v in plain(made_rows()).items()}


def test_words_one_letter_apart_share_a_signature():
    rng = random.Random(2)
    for _ in range(2000):
        word = "".join(rng.choice("aabbcdeé") for _ in range(rng.randrange(7, 14)))
        at = rng.randrange(len(word))
        other = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abzé") + word[at + 1 :], word[:at] + rng.choice("abz") + word[at:]])
        assert set(spellings.signatures(word)) & set(spellings.signatures(other))
        short, long = sorted((word, other), key=len)
        assert set(spellings.halves(short, len(short))) & set(spellings.halves(long, len(short)))


def test_empty_tables_give_no_rows(frame):
    assert spellings.spelling_groups(frame.limit(0)).collect() == []
    assert spellings.spelling_groups(frame.where(F.col("text").isNull())).collect() == []
