"""Near-duplicate lines: an exact set-similarity join of line tokens, native in Spark SQL.

The tokens of a line are its distinct words, ordered by hash; two neighbours are a gram. A word that only one of two
lines has takes two grams of this line and one of the other at most, so lines with a Jaccard similarity of 3/4 or more
share a gram among the rarest half of both. Lines meet on those grams, pairs are filtered by length, and what is left is
verified on the words themselves. Later matches are removed. Single words are too few: how many lines share one grows
with the input, and the pairs with its square.

Rarity comes from a sketch of fixed size: how often the hash bucket of a token occurs. Only grams of several lines go on;
until then a row is a gram and the hash of its line. A line needs one earlier match to
go. Lines that share a gram with few others are compared with each of them; where there are many, each line is first
compared with the oldest, and only lines that are still there with all earlier ones. A bitmap of 64 bits per line rules
out most pairs before their words are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.llm.common import small
from labelloom.session import drop, new_path, stage

NEAR, OF = 3, 4
BUCKETS = 1 << 16
RAREST = 255
#: A gram of so few lines and one more is settled where it is; more lines are compared with the oldest first.
FEW = 32
#: A line with more than this share of all lines is taken once into the join; there are fewer than so many such lines.
HOT_SHARE = 10_000
#: Removed lines (a number and a hash each) that are broadcast at most.
BROADCAST_LINES = 1_000_000
#: Numbers of 64 bits in the wide bitmap of a line, which rules out most pairs of long lines before their words meet.
WIDE = 8
#: Numbers of 64 bits that are broadcast to tell which lines are asked for; more lines than bits only make them tell less.
MARKS = 1 << 17
OTHER_SPACES = r"[\x09\x0B-\x0D]"
LAST = (1 << 63) - 1


def tokens_of(line: Column) -> Column:
    """Distinct words of a line whose white space are spaces."""
    return F.array_distinct(F.array_remove(F.split(line, " "), ""))


def spaced(text: Column) -> Column:
    """White space other than line feeds as spaces; most texts have none and are not rewritten."""
    return F.when(F.rlike(text, F.lit(OTHER_SPACES)), F.regexp_replace(text, OTHER_SPACES, " ")).otherwise(text)


def text_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, number, line, l1, l2): a null text is one empty line; other white space is spaces; l1, l2 are 128 bits of hash of the line."""
    text = F.split(spaced(F.coalesce(F.col("text"), F.lit(""))), "\n", -1)
    lines = docs.select("doc_id", F.posexplode(text).alias("number", "line"))
    return lines.select(
        "doc_id", "number", "line", F.xxhash64("line").alias("l1"), F.xxhash64("line", F.lit(1)).alias("l2")
    )


def position() -> Column:
    """The order of lines: by doc_id, null last, then by number."""
    return F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"), F.col("number").alias("n"))


def rarity(lines: DataFrame) -> Column:
    """An array with the rarity of each token bucket (0 to 255, in eighths of a power of two). BUCKETS counts at most reach the driver."""
    words = lines.select(F.explode(F.split("line", " ")).alias("word"))
    counted = words.groupBy(F.xxhash64("word").bitwiseAND(F.lit(BUCKETS - 1)).alias("bucket"))
    found = counted.agg(F.count(F.lit(1)).alias("n")).select(F.expr(f"n * {BUCKETS} + bucket").alias("code")).collect()
    codes = [r.code for r in found]
    total, rare = sum(code // BUCKETS for code in codes), [RAREST] * BUCKETS
    for code in codes:
        rare[code % BUCKETS] = min(RAREST, round(8 * math.log2(total / (code // BUCKETS))))
    return F.split(F.lit(",".join(map(str, rare))), ",").cast("array<bigint>")


def token_codes(line: Column) -> Column:
    """A hash of each distinct word of a line."""
    return F.array_distinct(F.transform(F.array_remove(F.split(line, " "), ""), lambda w: F.xxhash64(w)))


def measures(lines: DataFrame) -> DataFrame:
    """``lines`` with size and bits. Each token of a line turns over one of the 64 bits, so two lines differ in as many
    tokens as bits at least."""
    one = F.lit(1).cast("long")

    def turned(bits: Column, token: Column) -> Column:
        return bits.bitwiseXOR(F.call_function("shiftleft", one, token.bitwiseAND(F.lit(63)).cast("int")))

    coded = lines.withColumn("tokens", token_codes(F.col("line")))
    bits = F.aggregate("tokens", F.lit(0).cast("long"), turned)
    return coded.withColumns({"size": F.size("tokens"), "bits": bits}).drop("tokens")


def gram_rows(lines: DataFrame, rare: Column) -> DataFrame:
    """(l1, gram): the rarest grams of each line with words; a single word is a gram with itself.

    Of n words against m, of which 3 (n + m) / 7 are common at least, two grams go for each word that is not common and one
    for each such word of the other line: (5 n - 2 m) / 7 at most, and m is 3 n / 4 at least. Among one more of the rarest
    grams of both lines is one that they share. A word's last byte is its rarity, a gram's first bits are that of both.
    """

    def token(code: Column) -> Column:
        bucket = code.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
        return code.bitwiseAND(F.lit(-256)).bitwiseOR(F.get(rare, bucket))

    def gram(a: Column, b: Column) -> Column:
        usual = 2 * RAREST - a.bitwiseAND(F.lit(255)) - b.bitwiseAND(F.lit(255))
        return F.shiftleft(usual, 54).bitwiseOR(F.shiftrightunsigned(F.xxhash64(a, b), 10))

    coded = lines.select("l1", token_codes(F.col("line")).alias("codes")).where(F.size("codes") > 0)
    tokens = coded.select("l1", F.sort_array(F.transform("codes", token)).alias("tokens"))
    size, count = F.size("tokens"), F.greatest(F.size("tokens") - 1, F.lit(1))
    left, right = F.slice("tokens", F.lit(1), count), F.slice("tokens", F.least(size, F.lit(2)), count)
    grams = F.sort_array(F.zip_with(left, right, gram))
    most = F.floor((5 * size - 2 * F.ceil(size * NEAR / OF)) / (NEAR + OF)).cast("int") + 1
    return tokens.select("l1", F.explode(F.slice(grams, F.lit(1), most)).alias("gram"))


def can_be_near(a: str, b: str) -> Column:
    sizes = f"{OF} * least({a}.size, {b}.size) >= {NEAR} * greatest({a}.size, {b}.size)"
    differ = f"{OF + NEAR} * bit_count({a}.bits ^ {b}.bits) <= {a}.size + {b}.size"
    return F.expr(f"{sizes} and {differ}")


def wide_bits(words: Column) -> Column:
    """Each word turns over one of 64 * WIDE bits, so two lines differ in as many words as bits at least."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def part(k: int) -> Column:
        def turned(bits: Column, word: Column) -> Column:
            code = F.xxhash64(word)
            bit = F.call_function("shiftleft", one, code.bitwiseAND(F.lit(63)).cast("int"))
            mine = F.shiftrightunsigned(code, 6).bitwiseAND(F.lit(WIDE - 1)) == k
            return F.when(mine, bits.bitwiseXOR(bit)).otherwise(bits)

        return F.aggregate(words, zero, turned)

    return F.struct(F.size(words).alias("size"), *[part(k).alias(f"b{k}") for k in range(WIDE)])


def not_too_different(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The ``pairs`` whose bitmaps leave it open whether they are near."""
    bits = small(words.select("l1", "bits"))
    both = pairs.join(bits.select(F.col("l1").alias("x"), F.col("bits").alias("a")), "x")
    both = both.join(bits.select(F.col("l1").alias("y"), F.col("bits").alias("b")), "y")
    differ = " + ".join(f"bit_count(a.b{k} ^ b.b{k})" for k in range(WIDE))
    return both.where(f"{OF + NEAR} * ({differ}) <= a.size + b.size").select("x", "y")


def marked_lines(lines: DataFrame, known: DataFrame) -> DataFrame:
    """``lines`` without most of those that are not in ``known``, so that few texts are shuffled: 64 * MARKS bits tell."""
    word, bit = F.expr(f"shiftrightunsigned(l1, 6) & {MARKS - 1}"), F.expr("shiftleft(1L, cast(l1 & 63 as int))")
    marks = stage(known.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("marks")), "line-marks")
    return lines.join(F.broadcast(marks), word == F.col("word")).where(F.col("marks").bitwiseAND(bit) != 0).drop("word", "marks")


def matches(met: DataFrame, docs: DataFrame, firsts: DataFrame, tried: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The distinct pairs (x, y) of ``met`` not in ``tried``, and (l1) of the later line of those that are near."""
    pairs = met.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    if tried is not None:
        pairs = pairs.join(tried, ["x", "y"], "left_anti")
    pairs = stage(pairs, "line-pairs")
    asked = pairs.select(F.col("x").alias("l1")).union(pairs.select("y")).distinct()
    known = firsts.join(small(stage(asked, "line-keys")), "l1", "left_semi").groupBy("l1").agg(F.min("first").alias("first"))
    known = stage(known, "line-firsts")
    place = F.struct(F.col("first.d").alias("d"), F.col("first.n").alias("n"))
    texts = marked_lines(text_lines(docs), known).join(small(known), "l1").where(position() == place)
    words = texts.select("l1", "first", tokens_of(F.col("line")).alias("words")).dropDuplicates(["l1"])
    path = new_path(docs.sparkSession, "line-words")
    words = words.withColumn("codes", F.transform("words", lambda w: F.xxhash64(w)))
    words = stage(words.withColumn("bits", wide_bits(F.col("codes"))).drop("codes"), path=path)
    sides = [words.select(F.col("l1").alias(k), F.struct("first", "words").alias(n)) for k, n in (("x", "a"), ("y", "b"))]
    joined = stage(not_too_different(pairs, words), "line-pairs").join(sides[0], "x").join(sides[1], "y")
    both = F.size(F.array_intersect("a.words", "b.words"))
    near = joined.where((OF + NEAR) * both >= NEAR * (F.size("a.words") + F.size("b.words")))
    later = near.where("a.first <> b.first").select(F.expr("if(a.first < b.first, y, x)").alias("l1"))
    later = stage(later.distinct(), "beaten")
    drop(docs.sparkSession, path)
    return pairs, later


def shared_grams(lines: DataFrame, path: str | None = None) -> DataFrame:
    """(gram, l1): the rarest grams of each line that are also among those of another line."""
    of_gram = Window.partitionBy("gram").orderBy("l1")
    last = F.last("l1").over(of_gram.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = gram_rows(lines, rarity(lines)).withColumns({"before": F.lag("l1").over(of_gram), "last": last})
    rows = rows.where("if(before is null, last <> l1, before <> l1)")
    return stage(rows.select("gram", "l1"), "line-grams", path)


def beaten_lines(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(l1): lines that have an earlier near match. ``firsts``: (l1, l2, first, copies, size, bits) of each distinct line."""
    lines = text_lines(docs)
    count = firsts.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    hot = firsts.where(F.col("copies") > max(8, count // HOT_SHARE)).select("l1", "l2", "first")
    once = lines.join(small(hot), ["l1", "l2"], "left").where(F.col("first").isNull() | (F.col("first") == position()))
    # of the copies of a line, the first counts: it may be earlier than a line that all others are later than
    known = firsts.groupBy("l1").agg(F.min("first.d").alias("d"), *[F.first(c).alias(c) for c in ("size", "bits")])
    of_gram = Window.partitionBy("gram")
    before = of_gram.orderBy("size").rowsBetween(-FEW, -1)
    side = F.struct("d", "l1", "size", "bits")
    paths = [new_path(docs.sparkSession, "line-grams") for _ in range(3)]
    rows = stage(shared_grams(once, paths[0]).join(known, "l1"), path=paths[1])
    drop(docs.sparkSession, paths[0])
    rows = rows.withColumns(
        {
            "n": F.count(F.lit(1)).over(of_gram),
            "oldest": F.col("d") == F.min("d").over(of_gram),
            "others": F.collect_list(side).over(before),
        }
    )
    rows = rows.select("gram", side.alias("a"), "oldest", "n", F.expr(f"explode_outer(if(n <= {FEW} + 1, others, null))").alias("b"))
    rows = rows.where((F.col("n") > FEW + 1) | (F.expr("a.l1 <> b.l1") & can_be_near("a", "b")))
    other = [F.col("b.l1").alias("other"), F.col("b.d").alias("other_d")]
    rows = stage(rows.select("gram", "a.*", "oldest", *other), path=paths[2])
    drop(docs.sparkSession, paths[1])
    shared = stage(rows.where("other is null").drop("other", "other_d"), "line-grams")
    met = shared.select("gram", side.alias("a")).join(shared.where("oldest").select("gram", side.alias("b")), "gram")
    met = met.where(F.expr("a.l1 <> b.l1") & can_be_near("a", "b"))
    met = met.select(F.col("a.l1").alias("x"), F.col("b.l1").alias("y"))
    # of the pairs settled in place, each line is compared with the oldest first; lines of one text go both ways
    pairs = rows.where("other is not null").select("l1", "d", "other", "other_d")
    turned = pairs.select(F.col("other").alias("l1"), F.col("other_d").alias("d"), F.col("l1").alias("other"), F.col("d").alias("other_d"))
    pairs = stage(pairs.unionByName(turned).where("d >= other_d").distinct(), "line-pairs")
    drop(docs.sparkSession, paths[2])
    oldest = pairs.groupBy("l1").agg(F.min(F.struct("other_d", "other")).alias("o"))
    met = met.unionByName(oldest.select(F.col("l1").alias("x"), F.col("o.other").alias("y")))
    tried, beaten = matches(met, docs, firsts, None)

    left = shared.join(small(beaten), "l1", "left_anti").select("gram", side.alias("a"))
    met = left.join(shared.select("gram", side.alias("b")), "gram")
    met = met.where(F.expr("b.d <= a.d and a.l1 <> b.l1") & can_be_near("a", "b"))
    met = met.select(F.col("a.l1").alias("x"), F.col("b.l1").alias("y"))
    rest = pairs.join(small(beaten), "l1", "left_anti").select(F.col("l1").alias("x"), F.col("other").alias("y"))
    _, more = matches(met.unionByName(rest), docs, firsts, tried)
    return stage(beaten.unionByName(more).distinct(), "beaten")


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, removed): number and hash of the lines to remove of each document that has any."""
    lines = text_lines(docs).drop("line")
    firsts = measures(text_lines(docs)).groupBy("l1", "l2").agg(
        F.min(position()).alias("first"), F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("size", "bits")]
    )
    firsts = stage(firsts, "lines")
    beaten = beaten_lines(docs, firsts).withColumn("beaten", F.lit(True))
    judged = firsts.join(beaten, "l1", "left").where("beaten or copies > 1")
    judged = stage(judged.select("l1", "l2", "first", F.coalesce("beaten", F.lit(False)).alias("beaten")), "judged")
    gone = lines.join(small(judged), ["l1", "l2"]).where(F.col("beaten") | (position() > F.col("first")))
    return stage(
        gone.groupBy("doc_id").agg(F.collect_set(F.struct("number", "l1")).alias("removed")), "removed-lines"
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with its text cut, and n_lines, n_removed.

    A line (between line feeds) with words is removed if a line at an earlier place, in
    the order of (doc_id, line number), has a similarity of 3/4 or more to it, removed or not; ties count as similar.
    Copies after the first go with that. Blank lines stay. The other lines are joined again by line feeds; a text
    that loses all lines is empty. A null text stays null and has no lines. A null doc_id comes last. Lines at the same
    place (rows that repeat a doc_id) don't remove each other. All columns of ``docs`` are kept, whatever their names;
    an empty table gives no rows.
    """
    row = docs.select(F.struct("*").alias("row"))
    marked = removed_lines(docs.select("doc_id", "text"))
    few = marked.agg(F.coalesce(F.sum(F.size("removed")), F.lit(0))).first()[0] <= BROADCAST_LINES
    marked = marked.withColumnRenamed("doc_id", "id")
    joined = row.join(small(marked) if few else marked, F.col("row.doc_id").eqNullSafe(F.col("id")), "left")
    lines = F.split(F.col("row.text"), "\n", -1)

    def stays(line: Column, number: Column) -> Column:
        words = spaced(line)
        found = F.array_contains("removed", F.struct(number.alias("number"), F.xxhash64(words).alias("l1")))
        return ~(found & (F.size(tokens_of(words)) > 0))

    kept = F.when(F.col("removed").isNull(), lines).otherwise(F.filter(lines, stays))
    cut = joined.select("row", lines.alias("lines"), kept.alias("kept"))
    count = F.when(F.col("row.text").isNull(), 0).otherwise(F.size("lines")).cast("long")
    left = F.when(F.col("row.text").isNull(), 0).otherwise(F.size("kept")).cast("long")
    return cut.select(
        F.col("row")
        .withField("text", F.when(F.col("row.text").isNotNull(), F.array_join("kept", "\n")))
        .alias("row"),
        count.alias("n_lines"),
        (count - left).alias("n_removed"),
    )


def kept_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with cut texts and all their columns, without the rows that lost all their words."""
    emptied = (F.col("n_removed") > 0) & ~F.rlike(F.col("row.text"), F.lit(r"[^\x20\x09-\x0D]"))
    return dedup_lines(docs).where(~emptied).select("row.*")
