"""The prefix trie of conversations against a plain version."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from labelloom.llm import dialogues

SCHEMA = "conv_id long, turn long, role string, text string, depth string, conv int"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            text = text or ""
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.md5(text.encode()).digest(), text))
    told = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (conv % 20 if conv >= 0 else -(-conv % 20))
        told[conv] = [(t[2], t[4]) for t in sorted(own.get(base, []))[:h] + sorted(turns)[h:]]
    members = defaultdict(list)
    for conv in sorted(told):
        for d in range(len(told[conv]) + 1):
            members[tuple(told[conv][:d])].append(conv)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * words
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in m if len(told[c]) == len(k))
        parent = members[k[:-1]][0] if k else None
        out.append((m[0], len(k), parent, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def made_rows():
    rng = random.Random(3)
    rows = []
    for conv in [*range(130), -5, -20, -41, 1000, 1001]:
        if conv % 20 == 0 and rng.random() < 0.3:
            continue  # a family without its first conversation
        turns = 300 if conv in (7, 47) else rng.choice([1, 1, 2, 3, 5, 7, 20, 40])
        turns = min(turns, 4) if conv % 3 == 0 else turns
        for t in range(turns):
            turn = rng.choice([t, t, None]) if conv % 7 == 0 else t
            role = rng.choice(["user", "assistant", None]) if rng.random() < 0.1 else "u"
            text = rng.choice(["hi there", "a\tb  c", None, "x"]) if rng.random() < 0.15 else f"turn {t} word"
            rows.append((conv, turn, role, text))
    rows += [(None, 1, "u", "x"), rows[5], rows[5], (2000, 0, "u", "word " * 30_000), (2001, 0, "", "")]
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(*r, "clash", 1) for r in made_rows()], SCHEMA).repartition(3)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def test_trie_equals_the_plain_version(frame):
    assert collected(dialogues.prefix_trie(frame)) == plain(made_rows())


def test_bands_blocks_and_pieces_of_any_size_give_the_same(frame, monkeypatch):
    for name, value in (("BAND", 3), ("TURNS", 8), ("PIECE", 2)):
        monkeypatch.setattr(dialogues, name, value)
    assert collected(dialogues.prefix_trie(frame)) == plain(made_rows())


def test_many_conversations_of_one_text_share_their_nodes(spark):
    rows = [(c, t, "u", f"said {t}") for c in range(3000) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert collected(dialogues.prefix_trie(df)) == plain(rows)


def test_an_empty_table_has_no_nodes(frame):
    assert dialogues.prefix_trie(frame.limit(0)).collect() == []
