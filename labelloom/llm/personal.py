"""Personal data in texts: an Aho-Corasick automaton finds anchors, local parsers expand and validate each of them.

Anchors are at-signs, digits, plus signs, schemes (``://``, ``tel:``) and cues that announce an identifier (``IBAN``, ``account no``).
Each anchor is handed to the parser of its kind, which reads on (for an address also back) over the characters
that the kind allows and then validates what it has read. An anchor inside a stretch that its parser has read already is
skipped, so a text is read a bounded number of times however many anchors it has.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds with a fixed definition, in the order of spans that start at one place; then those that cues and schemes add.
BASE = ("email", "ip", "card", "phone")
ADDED = ("login", "tel", "iban", "account")
KINDS = (*BASE, *ADDED)
#: Words that announce an account or identity number.
CUES = ("iban", "account", "acct", "ssn", "social security", "passport", "konto", "kontonummer", "cuenta", "compte")
SCHEME, TEL = "://", "tel:"
DIGITS = "0123456789"
SCHEME_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
LOCAL_CHARS = SCHEME_CHARS | frozenset("_%")
#: Rows of a batch that are turned into Python texts at a time.
ROWS_AT_ONCE = 256

# each is applied at a given place only and never looks for its start
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_dotted = re.compile(r"[0-9]+(?:\.[0-9]+)*").match
_grouped = re.compile(r"[0-9](?:[\x20-]?[0-9])*").match
_dialled = re.compile(r"\+[0-9][\x20().0-9-]+").match
_userinfo = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=-]+:[A-Za-z0-9._~%!$&'()*+,;=:-]+@").match
_subscriber = re.compile(r"\+?[0-9][0-9().-]*[0-9]").match
_bridge = re.compile(r"(?:[\x20]?(?:number|no|nr|nummer))?[\x20]?[.:#=]{0,2}[\x20]?(?=[A-Za-z0-9])").match
_iban = re.compile(r"[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]){11,30}").match
_account = re.compile(r"[A-Z]{0,3}[0-9](?:[\x20-]?[0-9])*+(?![A-Za-z0-9])").match

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        value = ord(c) - 48
        if k % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of an IBAN: country and check digits go to the end, letters count from 10."""
    remainder = 0
    for c in iban[4:] + iban[:4]:
        value = int(c, 36)
        remainder = (remainder * (100 if value > 9 else 10) + value) % 97
    return remainder == 1


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def reads_email(text: str, at: int, done: int) -> tuple[int, Span | None]:
    """From an at-sign back over the local part (not before ``done``) and on over the domain."""
    start = at
    while start > done and text[start - 1] in LOCAL_CHARS:
        start -= 1
    domain = _domain(text, at + 1) if start < at else None
    return (domain.end(), (start, domain.end(), "email")) if domain else (done, None)


def reads_ips(text: str, at: int) -> tuple[int, list[Span]]:
    """A chain of numbers between dots: each four of them are one address if none is over 255."""
    chain = _dotted(text, at)
    parts, found = chain.group().split("."), []
    if len(parts) >= 4:
        start = at
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) < 3 or len(p.lstrip("0")) == 3 and int(p) <= 255 for p in four):
                found.append((start, end, "ip"))
            start = end + 1
    return chain.end(), found


def reads_card(text: str, at: int) -> tuple[int, Span | None]:
    """A chain of digits with single spaces or dashes between them."""
    chain = _grouped(text, at)
    start, end = chain.span()
    if 14 <= end - start and 14 <= len(digits := only_digits(chain.group())) <= 19 and luhn(digits):
        return end, (start, end, "card")
    return end, None


def reads_phone(text: str, at: int) -> Span | None:
    """A plus sign, and digits with spaces, dots, dashes or brackets up to the last digit."""
    chain = _dialled(text, at)
    if not chain:
        return None
    said = chain.group().rstrip(" ().-")
    if len(said) >= 4 and 10 <= len(only_digits(said)) <= 15:
        return at, at + len(said), "phone"
    return None


def reads_login(text: str, at: int) -> Span | None:
    """User and password behind a scheme, without the at-sign. The scheme is read backwards and has to have letters."""
    if at == 0 or text[at - 1] not in SCHEME_CHARS:
        return None
    start = at + len(SCHEME)
    found = _userinfo(text, start)
    return (start, found.end() - 1, "login") if found else None


def reads_tel(text: str, at: int) -> Span | None:
    """A number of 7 to 15 digits behind ``tel:``."""
    start = at + len(TEL)
    found = _subscriber(text, start)
    if (at and text[at - 1].isalnum()) or not found or not 7 <= len(only_digits(found.group())) <= 15:
        return None
    return start, found.end(), "tel"


def reads_identifier(text: str, at: int, cue: str) -> Span | None:
    """An identifier behind a cue: an IBAN whose check holds, else a number of 7 to 18 digits."""
    end = at + len(cue)
    if at and text[at - 1].isalnum():
        return None
    bridge = _bridge(text, end)
    if not bridge or bridge.end() == end:
        return None
    start = bridge.end()
    if found := _iban(text, start):
        said = found.group()
        while said:  # the longest beginning whose check holds; words in capitals may follow
            packed = said.replace(" ", "")
            follow = text[start + len(said) : start + len(said) + 1]
            if 15 <= len(packed) <= 34 and not follow.isalnum() and mod97(packed):
                return start, start + len(said), "iban"
            said = said.rpartition(" ")[0]
    found = _account(text, start)
    if found and 7 <= len(only_digits(found.group())) <= 18:
        return start, found.end(), "account"
    return None


@cache
def anchors() -> ahocorasick.Automaton:
    """The automaton over all anchors; a cue is found in small letters, with a capital and in capitals."""
    automaton = ahocorasick.Automaton()
    for c in DIGITS:
        automaton.add_word(c, ("digit", c))
    for c in ("@", "+", SCHEME):
        automaton.add_word(c, (c, c))
    for word, kind in ((TEL, "tel"), *((c, "cue") for c in CUES)):
        for spelled in {word, word.capitalize(), word.title(), word.upper()}:
            automaton.add_word(spelled, (kind, spelled))
    automaton.make_automaton()
    return automaton


def spans_of(text: str) -> list[Span]:
    """(start, end, kind) by start, then by kind. Spans of one kind don't overlap; spans of different kinds may."""
    found: list[Span | None] = []
    done = dict.fromkeys(KINDS, 0)
    for last, (kind, word) in anchors().iter(text):
        at = last - len(word) + 1
        if kind == "digit":
            if at >= done["ip"]:
                done["ip"], ips = reads_ips(text, at)
                found += ips
            if at >= done["card"]:
                done["card"], card = reads_card(text, at)
                found.append(card)
            continue
        if kind == "@":
            done["email"], span = reads_email(text, at, done["email"])
        elif kind == "+":
            span = reads_phone(text, at)
        elif kind == SCHEME:
            span = reads_login(text, at)
        elif kind == "tel":
            span = reads_tel(text, at)
        else:
            span = reads_identifier(text, at, word)
        if span and span[2] in ADDED:  # a cue inside what a cue before has read, or a longer cue that ends there
            span = span if span[0] >= done[span[2]] else None
            if span:
                done[span[2]] = span[1]
        found.append(span)
    order = {kind: k for k, kind in enumerate(KINDS)}
    return sorted((s for s in found if s), key=lambda s: (s[0], order[s[2]]))


SPANS = "array<struct<kind: string, start: long, end: long>>"


def find_personal(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, spans) for each row of ``docs``: kind, start and end (exclusive, in code points) of the personal data in its whole text.

    Kinds of BASE: email, ip (four parts up to 255), card (14 to 19 digits that pass Luhn) and phone (a plus sign, 10 to 15
    digits), each leftmost and without overlaps in its kind. Kinds of ADDED: login (user and password of a URL), tel
    (a ``tel:`` number without a plus sign is enough), iban and account (behind a cue). Spans of different kinds may
    overlap; they are ordered by start, then by kind.

    A null or empty text has no spans. Rows are independent: repeated rows give repeated results, a null id stays null, an
    empty table gives no rows, other columns are not read. A text takes time in proportion to its length.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                spans = [
                    [{"kind": k, "start": s, "end": e} for s, e, k in spans_of(text or "")]
                    for text in part.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind)], names=["id", "spans"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id_column)


def count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def reported(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans, of ``find_personal``'s rows."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        *(c for c in found.columns if c != "spans"),
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def redacted(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with each stretch of personal data replaced by its kind in brackets, like ``[email]``.

    Overlapping spans are one stretch, named after the first. All columns stay, whatever their names; a null text stays null.
    """

    def clean(text: str) -> str:
        out, done = [], 0
        for start, end, kind in spans_of(text):
            if start >= done:
                out += [text[done:start], f"[{kind}]"]
            done = max(done, end)
        return "".join([*out, text[done:]])

    where = docs.columns.index(text_column)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                texts = [None if t is None else clean(t) for t in part.column(where).to_pylist()]
                yield part.set_column(where, part.schema.names[where], pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)
