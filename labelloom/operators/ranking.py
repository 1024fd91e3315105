"""Exact ranks at scale.

Taking "the first k rows of each label in a seeded random order" with a window would
sort a whole label in one task. Here every row gets a uniform order key (an MD5), and
the key value at rank k is found by counting: a histogram over leading hex digits
locates the bucket that holds rank k, the next pass looks only into that bucket. The histograms
stay on the executors; a count per key and one row per search reach the driver. With the cut values
known, choosing the rows is a comparison per row: no shuffle, no join, no window. Only where keys are many
the cuts are a table that is sent to the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions.text import text_digest
from labelloom.operators.rank_search import BUCKET, HELD, HIGH, LIST, LOW, N, RANK, bucket_list, holding
from labelloom.session import ROW_ID, drop, new_path, stage, stage_with_row_id

DIGEST = "_digest"
ORDER = "_order"
FIRST_DIGITS = 2  # every task emits all buckets of every key here, so few of them
DIGITS = 3
BUCKETS = 16**DIGITS
WHOLE = 1_000  # longer than any order key
FEW_ROWS = 16 * BUCKETS
#: So many cuts are predicates; more are a table.
PREDICATES = 64
SEARCH, INSIDE, CUT, PLACE, PLACE_CUT = "_search", "_inside", "_cut", "_place", "_place_cut"

Key = tuple
Targets = Callable[[dict[Key, int]], Mapping[Key, Sequence[int]]]


def order_key(df: DataFrame, seed: int | Column, purpose: str) -> Column:
    """Seeded uniform order of the rows by text.

    ``purpose`` keeps the orders of different steps independent: without it a split of a
    sampled table would follow the sample's own cut. The text enters as its digest, so
    that tables staged with one need not be read whole again.
    """
    digest = F.col(DIGEST) if DIGEST in df.columns else text_digest(F.col("text"))
    seed_text = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws(":", seed_text, F.lit(purpose), digest))


def with_digest(df: DataFrame) -> DataFrame:
    return df if DIGEST in df.columns else df.withColumn(DIGEST, text_digest(F.col("text")))


def shuffle_rows(df: DataFrame, seed: int) -> DataFrame:
    """All rows in a seeded random order."""
    return df.orderBy(order_key(df, seed, "shuffle"))


@dataclass(frozen=True)
class Cut:
    """The order value at one rank of one key.

    ``value`` is None when the rank lies outside the key's rows, then ``take`` says
    whether all or none are within. Otherwise rows below ``value`` are within, and
    ``take`` of the ``ties`` rows equal to it.
    """

    value: str | None
    take: int
    ties: int

    @property
    def splits_ties(self) -> bool:
        return self.value is not None and self.take < self.ties


def _key_filter(keys: Sequence[str], key: Key) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(keys, key)), F.lit(True))


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in names), F.lit(True))


def _table(df: DataFrame, keys: Sequence[str], rows: Sequence[tuple], more: str) -> DataFrame:
    """Rows from the driver whose first fields are keys of ``df``."""
    kinds = [T.StructField(k, df.schema[k].dataType) for k in keys]
    return df.sparkSession.createDataFrame(rows, T.StructType([*kinds, *T._parse_datatype_string(more).fields]))


def _buckets(rows: DataFrame, keys: Sequence[str], length: int) -> DataFrame:
    """Per key the list of its buckets: rows by the first ``length`` characters of their order value."""
    counted = rows.groupBy(*keys, F.substring(ORDER, 1, length).alias(BUCKET)).agg(
        F.count(F.lit(1)).alias(N), F.min(F.col(ORDER)).alias(LOW), F.max(F.col(ORDER)).alias(HIGH)
    )
    return counted.groupBy(*keys).agg(bucket_list())


def find_cuts(
    df: DataFrame, keys: Sequence[str], order: Column, targets: Targets
) -> tuple[dict[Key, int], dict[tuple[Key, int], Cut]]:
    """Rows per key, and the cut for every (key, rank) that ``targets`` asks for.

    ``targets`` is called with the counts, so quotas that depend on them cost no extra
    pass. Passes over ``df`` read only the keys and the order column: one to count, one
    that looks into the buckets found, and a third only beyond some million rows per key. The driver gets a count per key
    and the bucket of each search; what is counted stays in staged tables.
    """
    ordered = df.select(*keys, order.alias(ORDER))
    prefix = F.substring(ORDER, 1, FIRST_DIGITS)
    path = new_path(df.sparkSession, "order-counts")
    try:
        first = stage(ordered.groupBy(*keys, prefix.alias(BUCKET)).agg(F.count(F.lit(1)).alias(N)), path=path)
        counts, cuts, searches, found = _first_level(df, keys, first, targets)
    finally:
        drop(df.sparkSession, path)
    while found:
        # Few rows left: tell them all apart at once rather than by another level.
        length = len(found[0][BUCKET])
        deeper = WHOLE if sum(r[N] for r in found) <= FEW_ROWS else length + DIGITS
        open_ = [(*searches[r[SEARCH]][0], r[SEARCH], r[RANK], r[BUCKET]) for r in found]
        asked = _table(df, keys, open_, f"{SEARCH} long, {RANK} long, {INSIDE} string")
        here = ordered.withColumn(INSIDE, F.substring(ORDER, 1, length)).alias("r")
        inside = here.join(F.broadcast(asked).alias("s"), _same("r", "s", [*keys, INSIDE])).select(SEARCH, RANK, ORDER)
        held = _buckets(inside, [SEARCH, RANK], deeper).select(SEARCH, holding()).select(SEARCH, f"{HELD}.*")
        found = []
        for r in held.collect():
            if r[LOW] == r[HIGH]:
                cuts[searches[r[SEARCH]]] = Cut(r[LOW], r[RANK], r[N])
            else:
                found.append(r)
    return counts, cuts


def _first_level(df: DataFrame, keys: Sequence[str], first: DataFrame, targets: Targets):
    """Counts, the cuts that need no search, the searches, and the first bucket of each."""
    counts = {tuple(r[: len(keys)]): r[N] for r in first.groupBy(*keys).agg(F.sum(N).alias(N)).collect()}
    cuts: dict[tuple[Key, int], Cut] = {}
    searches: list[tuple[Key, int]] = []
    for key, ranks in targets(counts).items():
        for rank in ranks:
            total = counts.get(key, 0)
            if rank >= total:
                cuts[key, rank] = Cut(None, 1, 0)
            elif rank <= 0:
                cuts[key, rank] = Cut(None, 0, 0)
            else:
                searches.append((key, rank))
    if not searches:
        return counts, cuts, searches, []
    asked = _table(df, keys, [(*key, i, rank) for i, (key, rank) in enumerate(searches)], f"{SEARCH} long, {RANK} long")
    none = F.lit(None).cast("string")
    lists = first.withColumns({LOW: none, HIGH: none}).groupBy(*keys).agg(bucket_list())
    met = lists.alias("l").join(F.broadcast(asked).alias("s"), _same("l", "s", keys)).select(SEARCH, RANK, LIST)
    return counts, cuts, searches, met.select(SEARCH, holding()).select(SEARCH, f"{HELD}.*").collect()


@dataclass(frozen=True)
class Ranked:
    """A table together with exact "rank within key is at most r" predicates.

    ``cuts`` holds for each (key, rank) the order value of the last row within, and the last place among the rows of that
    value, if the cut falls among them; (None, None) for all rows of the key, ("", None) for none.
    """

    df: DataFrame
    keys: tuple[str, ...]
    counts: dict[Key, int]
    cuts: dict[tuple[Key, int], tuple[str | None, str | None]] = field(repr=False)

    def within(self, key: Key, rank: int) -> Column:
        """The predicate of one (key, rank)."""
        value, place = self.cuts[key, rank]
        if value is None:
            inside = F.lit(True)
        elif place is None:
            inside = F.col(ORDER) <= value
        else:
            inside = (F.col(ORDER) < value) | ((F.col(ORDER) == value) & (_place(self.df) <= place))
        return _key_filter(self.keys, key) & inside

    def take(self) -> DataFrame:
        """Rows within the (single) target of their key."""
        if not self.cuts:
            return self.df.where(F.lit(False))
        if len(self.cuts) <= PREDICATES:
            return self.df.where(reduce(lambda a, b: a | b, (self.within(*c) for c in self.cuts)))
        rows = [(*key, value, place) for (key, _), (value, place) in self.cuts.items()]
        cuts = F.broadcast(_table(self.df, self.keys, rows, f"{CUT} string, {PLACE_CUT} string")).alias("c")
        tied = any(place is not None for _, place in self.cuts.values())
        placed = self.df.withColumn(PLACE, _place(self.df) if tied else F.lit(""))
        joined = placed.alias("r").join(cuts, _same("r", "c", self.keys))
        up_to_place = F.col(PLACE_CUT).isNull() | (F.col(PLACE) <= F.col(PLACE_CUT))
        inside = F.col(CUT).isNull() | (F.col(ORDER) < F.col(CUT)) | ((F.col(ORDER) == F.col(CUT)) & up_to_place)
        return joined.where(inside).select("r.*").drop(PLACE)


def _place(df: DataFrame) -> Column:
    """A uniform order of rows that share an order value: by content, then by their place in the staged table."""
    content = F.to_json(F.struct(*[c for c in df.columns if c not in (ROW_ID, ORDER)]))
    return F.concat(F.md5(content), F.md5(F.col(ROW_ID)))


def rank_rows(df: DataFrame, keys: Sequence[str], order: Column, targets: Targets) -> Ranked:
    """Predicates that pick exactly the first r rows of each key in the given order.

    ``order`` is a hex string per row; the returned table carries it as ``_order``, computed
    once however many predicates use it. Rows that share an order value are told apart only
    if a cut falls among them; then the table is staged, and a hash over all columns plus
    the row's place in the staged table decides, by the same counting, for all such cuts together.
    """
    counts, found = find_cuts(df, keys, order, targets)
    df = df.withColumn(ORDER, order)
    cuts = {at: (cut.value if cut.value is not None else None if cut.take else "", None) for at, cut in found.items()}
    tied = {at: cut for at, cut in found.items() if cut.splits_ties}
    if tied:
        if ROW_ID not in df.columns:
            df = stage_with_row_id(df)
        wanted: dict[Key, set[int]] = {}
        for (key, _), cut in tied.items():
            wanted.setdefault((*key, cut.value), set()).add(cut.take)
        values = F.broadcast(_table(df, [*keys, ORDER], list(wanted), "")).alias("t")
        rows = df.alias("r").join(values, _same("r", "t", [*keys, ORDER]), "left_semi")
        places = rows.select(*keys, F.col(ORDER).alias(CUT), _place(df).alias(PLACE_CUT))
        _, inner = find_cuts(places, [*keys, CUT], F.col(PLACE_CUT), lambda _: {k: sorted(r) for k, r in wanted.items()})
        for at, cut in tied.items():
            cuts[at] = (cut.value, inner[(*at[0], cut.value), cut.take].value)
    return Ranked(df, tuple(keys), counts, cuts)
