"""Personal data against regular expressions that search whole texts."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from labelloom.llm import personal

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes_luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def searched(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            holds = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and passes_luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]
            if holds():
                out.append((m.start(), k, m.end(), kind))
    return [(s, e, kind) for s, _, e, kind in sorted(out)]


def made_texts():
    rng = random.Random(1)
    alphabet = "0123456789" * 2 + "..@@-- ++()ab_é%X:/\n"
    pieces = ["4111 1111 1111 1111", "+1 (988) 555-2485", "1.2.3.4", "255.256.1.1", "0255.1.1.001", "a@b.co", "x.y@z-1.example.com"]
    pieces += ["tel:5551234567", "https://u:p@h.org", "IBAN: DE89 3704 0044 0532 0130 00", "account no. 12345678", "+12 345", "a@b@c.de"]
    return ["".join(rng.choice(pieces if rng.random() < 0.25 else alphabet) for _ in range(rng.randrange(60))) for _ in range(4000)]


def test_base_kinds_equal_a_search_of_the_whole_text():
    found = 0
    for text in made_texts():
        base = [s for s in personal.spans_of(text) if s[2] in personal.BASE]
        assert base == searched(text), text
        found += len(base)
    assert found > 5000


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("IBAN: DE89 3704 0044 0532 0130 00 AND", [("DE89 3704 0044 0532 0130 00", "iban")]),
        ("iban GB82WEST12345698765432.", [("GB82WEST12345698765432", "iban")]),
        ("IBAN DE88 3704 0044 0532 0130 00", []),  # the check fails
        ("Account number: 12345678, konto 99887766", [("12345678", "account"), ("99887766", "account")]),
        ("SSN 123-45-6789 passport no X1234567", [("123-45-6789", "account"), ("X1234567", "account")]),
        ("accounted 1234567, discount 1234567, account 12", []),
        ("tel:030-1234567", [("030-1234567", "tel")]),
        ("hotel:030-1234567", []),
        ("see ftp://bob:secret@host/x", [("bob:secret", "login")]),
        ("see https://host/x ://a:b@c", []),
    ],
)
def test_cues_and_schemes_add_spans(text, spans):
    assert [(text[s:e], kind) for s, e, kind in personal.spans_of(text)] == spans


@pytest.mark.parametrize(
    "text", ["1" * 200_000, "@" * 200_000, "a@" * 100_000, "1.2." * 50_000, "iban " * 50_000, "account 1" + " 1" * 100_000, "+1" * 100_000, "0." * 100_000 + "9" * 5000]
)
def test_long_texts_take_time_in_proportion(text):
    started = time.process_time()
    personal.spans_of(text)
    assert time.process_time() - started < 5


def test_reports_and_redaction(spark):
    texts = [None, "", "nothing", "é a@b.co, 1.2.3.4 and +1 (988) 555-2485", "4111 1111 1111 1111", "4111 1111 1111 1111", "x " * 60_000 + "a@b.co", "ftp://bob:secret@host.com/x"]
    rows = [(None if k == 5 else k, t, "clash", 7) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, id int").repartition(2)
    got = {(r.doc_id, r.spans): r for r in personal.reported(personal.find_personal(df)).collect()}
    assert len(got) == len(texts)
    for number, text, *_ in rows:
        base = searched(text)
        said = ",".join(f"{kind}:{s}:{e}" for s, e, kind in base)
        row = next(r for (d, _), r in got.items() if d == number)
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(s[2] == k for s in base) for k in PATTERNS)
        assert row.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        added = ",".join(f"{kind}:{s}:{e}" for s, e, kind in personal.spans_of(text or ""))
        assert row.spans == added
    cleaned = {r.id: r for r in personal.redacted(df.withColumn("id", F.monotonically_increasing_id())).collect()}
    texts_left = [r.text for r in cleaned.values()]
    assert "é [email], [ip] and [phone]" in texts_left and texts_left.count("[card]") == 2 and None in texts_left
    assert "ftp://[login].com/x" not in texts_left and "ftp://[login]/x" in texts_left  # the login and the address overlap
    assert personal.find_personal(df.limit(0)).collect() == []
    assert personal.redacted(df.limit(0)).collect() == []
