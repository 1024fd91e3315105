"""SentencePiece encoding and decoding for merge-type vocabularies."""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat
from operator import add

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Segments whose ids a Python worker remembers, twice this number at most, each up to so many characters.
REMEMBERED_SEGMENTS = 300_000
LONGEST_REMEMBERED = 64
#: Characters up to which the agenda is searched instead of kept as a heap.
SHORT = 64
NEVER = float("inf")

codecs.register_error("labelloom_each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Merger(dict):
    """Ids of a segment by merging adjacent symbols, best score first, leftmost among equals.

    A text is cut into segments that no piece of the vocabulary can span, so each segment is merged by itself and
    remembered. The dictionary holds the segments met lately; ``older`` those of the time before.
    """

    def __init__(self, model: bytes):
        super().__init__()
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces, self.bytes, self.texts, self.older, self.fresh = {}, {}, [], {}, []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.texts.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.texts.append(" ⁇ ".encode() if sp.is_unknown(i) else b"")
            else:
                self.texts.append(piece.replace(SPACE, " ").encode())
                if not sp.is_unused(i):
                    self.pieces[piece] = (-sp.get_score(i), i)
        self.ids = {p: i for p, (_, i) in self.pieces.items()}
        self.scores = {p: s for p, (s, _) in self.pieces.items() if len(p) > 1}
        self.neighbours = {p[k : k + 2] for p in self.pieces for k in range(len(p) - 1)}
        joined = {c for pair in self.neighbours for c in pair}
        alone = "".join(c for c in "\n\r\t" if c not in joined)
        crossing = any(pair[1] == SPACE != pair[0] for pair in self.neighbours)
        one = f"[{alone}]|" if alone else ""
        starts = re.escape("".join(sorted(self.starters())))
        rest = f"[^{SPACE}{alone}{starts}]+"
        word = f"(?:[{starts}]+(?:{rest})?|{rest})" if starts else rest
        self.cut = re.compile(r"(?s).+" if crossing else f"{one}{SPACE}*{word}|{SPACE}+")

    def starters(self) -> set[str]:
        """Characters other than letters that no piece has behind another character than such a one or the space."""
        found = {c for pair in self.neighbours for c in pair if not c.isalpha() and c not in f"{SPACE}\n\r\t"}
        while bound := {b for a, b in self.neighbours if b in found and a != SPACE and a not in found}:
            found -= bound
        return found

    def __missing__(self, segment: str) -> tuple[int, ...]:
        if (ids := self.older.get(segment)) is None:
            pairs = list(map(add, segment, segment[1:]))
            if self.neighbours.issuperset(pairs):
                short = len(segment) <= SHORT
                ids = self.ids_of(self.merge_short(segment, pairs) if short else self.merge(segment))
                self.fresh.append((segment, ids))
            else:  # cut where no piece has the two characters side by side
                cuts = [k for k, pair in enumerate(pairs, 1) if pair not in self.neighbours]
                parts = map(segment.__getitem__, map(slice, [0, *cuts], [*cuts, None]))
                ids = tuple(chain.from_iterable(map(self.__getitem__, parts)))
        if len(segment) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED_SEGMENTS:
                self.older = dict(self)
                self.clear()
            self[segment] = ids
        return ids

    def merge_short(self, segment: str, pairs: list[str] | None = None) -> list[str]:
        """The agenda is the row of scores of adjacent pairs itself: short enough to look for the best each time.

        ``pairs`` are the segment's adjacent characters, where the caller has made them already.
        """
        score, symbols = self.scores.get, list(segment)
        pairs = list(map(add, segment, segment[1:])) if pairs is None else pairs
        agenda = list(map(score, pairs, repeat(NEVER)))
        while agenda and (best := min(agenda)) != NEVER:
            at = agenda.index(best)
            symbols[at] = merged = symbols[at] + symbols.pop(at + 1)
            del agenda[at]
            if at < len(agenda):
                agenda[at] = score(merged + symbols[at + 1], NEVER)
            if at:
                agenda[at - 1] = score(symbols[at - 1] + merged, NEVER)
        return symbols

    def merge(self, segment: str) -> list[str]:
        """The agenda is a heap of each adjacent pair that is a piece, by score and then by place."""
        pieces, symbols = self.pieces, list(segment)
        count = len(symbols)
        after = list(range(1, count + 1))
        before = list(range(-1, count - 1))
        agenda = []
        for i in range(count - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in pieces:
                agenda.append((pieces[pair][0], i, i + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            head, tail = symbols[left], symbols[right]
            if head is None or tail is None or len(head) + len(tail) != len(pair):
                continue  # one of the two was merged meanwhile
            symbols[left], symbols[right] = pair, None
            after[left] = follow = after[right]
            if follow < count:
                before[follow] = left
                wider = pair + symbols[follow]
                if wider in pieces:
                    heapq.heappush(agenda, (pieces[wider][0], left, follow, wider))
            if (lead := before[left]) >= 0:
                wider = symbols[lead] + pair
                if wider in pieces:
                    heapq.heappush(agenda, (pieces[wider][0], lead, left, wider))
        return [symbol for symbol in symbols if symbol is not None]

    def ids_of(self, symbols: list[str]) -> tuple[int, ...]:
        try:
            return tuple(map(self.ids.__getitem__, symbols))
        except KeyError:  # some are no pieces
            return tuple(chain.from_iterable(map(self.ids_of_symbol, symbols)))

    def ids_of_symbol(self, symbol: str) -> list[int]:
        if symbol in self.ids:
            return [self.ids[symbol]]
        return [self.bytes[b] for b in symbol.encode()] if self.bytes else [self.library.unk_id()]

    def agrees(self) -> bool:
        """Whether the library gives the same ids for the segments merged since the last call.

        The library puts a space before each text. A segment that doesn't begin with one is given to it behind a line
        break, whose ids it has in common with the line break alone.
        """
        fresh, self.fresh = self.fresh, []
        lead = self.library.encode("\n")
        inner = [f for f in fresh if f[0][0] != SPACE]
        outer = [f for f in fresh if f[0][0] == SPACE]
        for segments, prefix, cut in ((inner, "\n", lead), (outer, "", [])):
            texts = [prefix + s[len(prefix) == 0 :].replace(SPACE, " ") for s, _ in segments]
            theirs = self.library.encode(texts, num_threads=1) if texts else []
            for text, (_, ids), want in zip(texts, segments, theirs, strict=True):
                if text and [*cut, *ids] != want:
                    return False
        return True

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        segments = self.cut.findall(SPACE + text.replace(" ", SPACE))
        return list(chain.from_iterable(map(self.__getitem__, segments)))

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.texts.__getitem__, ids))
        return raw.removeprefix(b" ").decode("utf-8", "labelloom_each_byte")


@lru_cache(maxsize=2)
def merger(model: bytes) -> Merger:
    return Merger(model)


def encode_decode(df: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids, decoded, agrees) for each row of ``df``: the ids of its whole text, and the text they decode to.

    The model has to be of the merge type with an identity normaliser and a dummy prefix. The decoded text is the
    library's. In each Arrow batch the library also encodes all new segments and a whole text in 256, and all ids are decoded
    both here and there; the job fails where the two disagree, so ``agrees`` is true in every row.

    A null or empty text has no ids and decodes to the empty text. Rows are independent: repeated rows give repeated
    results, a null id stays null, an empty table gives no rows, other columns are not read. Memory is bounded by one
    Arrow batch and the remembered segments.
    """
    with open(model_file, "rb") as file:  # a vocabulary file, half a megabyte
        model = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = merger(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = part.column(1).to_pylist()
                ids = [own.encode(t) for t in texts]
                decoded = own.library.decode(ids, num_threads=1)
                whole = not texts or own.library.encode(texts[0]) == ids[0]
                agrees = [own.decode(i) == d for i, d in zip(ids, decoded, strict=True)]
                if not (whole and own.agrees() and all(agrees)):
                    raise RuntimeError("the sentencepiece library gives other ids or another text")
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array(decoded, pa.string()),
                        pa.array(agrees, pa.bool_()),
                    ],
                    names=["id", "ids", "decoded", "agrees"],
                )

    rows = df.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded string, agrees boolean").select(
        F.col("id").alias(id_column), "ids", "decoded", "agrees"
    )


def token_digests(encoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Number of ids, and digests of ids and decoded text, of ``encode_decode``'s rows."""
    return encoded.select(
        id_column,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "agrees",
    )
