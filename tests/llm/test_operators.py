"""Each operator against its plain version on a small table with nulls, empty and long texts, ties and repeats."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from labelloom.llm import catalogue, jaccard, leaks, lines, quality, repeats, sentencepieces, suffixes
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_words string, row string, label int"


def made_documents() -> list[dict]:
    rng = random.Random(7)
    vocabulary = [f"w{rng.randrange(10**6)}é" for _ in range(500)] + ["The", "of", "AND", "a"] * 20

    def prose(count):
        return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", ",", "\n"]) for _ in range(count))

    passage = prose(70)
    base = prose(120).split(" ")
    texts = [prose(rng.randrange(25, 160)) for _ in range(30)]
    texts += [f"{prose(15)} {passage} {prose(12)}" for _ in range(4)] + [f"{passage} {passage}"]
    for k in range(6):  # near copies
        near = list(base)
        near[k * 9] = f"other{k}"
        texts.append(" ".join(near))
    texts += [" ".join(base).upper(), " ".join(base), " ".join(base)]
    texts += [None, "", " \n\t ", "one", "one", "a b c d", "a b c d e", " x y \x1cz\x85", "word " * 80]
    texts += [prose(9000), "### $$$ %%% &&& " * 12, "x\r\ny\x0bz\x0c" * 9]
    docs = [
        {"doc_id": i, "text": t, "lang": ("en", "de", None)[i % 3], "source": (None, "s")[i % 2]} for i, t in enumerate(texts)
    ]
    docs += [dict(docs[3]), dict(docs[3]), {**docs[4], "text": docs[5]["text"]}, {**docs[6], "doc_id": None}]
    docs += [{**docs[0], "doc_id": None, "text": None}]
    return docs


@pytest.fixture(scope="module")
def docs():
    return made_documents()


@pytest.fixture(scope="module")
def frame(spark, docs):
    rows = [(d["doc_id"], d["text"], d["lang"], d["source"], "clash", "clash", 1) for d in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def same(rows, wanted):
    assert sorted(map(tuple, rows), key=key) == sorted(map(tuple, wanted), key=key)


def test_quality(frame, empty, docs):
    got = quality.judged(frame).select("doc_id", *quality.COUNTS, "base_failed", "kept").collect()
    counts = [brute.base_counts(d["text"]) for d in docs]
    failed = [c[0] < 20 or 100 * c[4] > 30 * c[0] for c in counts]
    kept = brute.quality(docs)
    same(got, [(d["doc_id"], *c[:6], f, k) for d, c, f, k in zip(docs, counts, failed, kept)])
    rows = quality.kept_documents(frame)
    assert rows.columns == frame.columns
    same(rows.select("doc_id", "text").collect(), [(d["doc_id"], d["text"]) for d, k in zip(docs, kept) if k])
    assert quality.judged(empty).count() == quality.kept_documents(empty).count() == 0


def test_each_line_measure_fires(spark):
    rng = random.Random(8)
    line = lambda n, size=4: " ".join(f"{rng.randrange(10**9):09d}"[:size] + "x" for _ in range(n))
    texts = ["\n".join(line(9) for _ in range(8)) for _ in range(50)]
    passage = line(12)
    planted = {
        "dup_line_share": "\n".join(f"{line(9)}\nread more" for _ in range(8)),
        "repeat_share": "\n".join([line(40), passage, line(37), passage]),
        "stutter_share": line(30) + " so" * 7 + line(9) + " no" * 7 + line(9) + " do" * 7,
        "symbol_share": " ".join(f"{w} #" for w in line(60).split()),
        "word_length": line(60, 9).replace(" ", "yyyyyy "),
    }
    rows = [(k, t, "en", "s") for k, t in enumerate([*texts, *planted.values()])]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judged(frame).collect()}
    assert all(got[k].kept for k in range(50))
    for k, name in enumerate(planted, 50):
        assert name in got[k].failed and not got[k].base_failed, (name, got[k])
    assert quality.kept_documents(frame).count() == 50


def test_sketches_merge(spark):
    values = [random.Random(3).randrange(100_000) for _ in range(3000)]
    rows = spark.createDataFrame([(v, v % 3) for v in values], "v long, g int")
    sketch = rows.groupBy("g", F.lit("m").alias("measure"), quality.bucket(F.col("v")).alias("bucket")).count()
    merged = quality.quantiles(quality.merge(sketch.withColumnRenamed("count", "n"))).first()
    for share, got in ((1, merged.low), (5, merged.mid), (9, merged.high)):
        true = sorted(values)[-(-len(values) * share // 10) - 1]
        assert got <= true < got * (1 + 1 / 64) + 1


def test_lines(frame, empty, docs):
    cut = lines.dedup_lines(frame)
    wanted = brute.deduped_lines(docs)
    count = lambda t: 0 if t is None else len(t.split("\n"))
    same(
        cut.select("row.doc_id", "row.text", "n_lines").collect(),
        [(d["doc_id"], w, count(d["text"])) for d, w in zip(docs, wanted)],
    )
    kept = lines.kept_texts(frame)
    assert kept.columns == frame.columns
    left = [(d["doc_id"], w) for d, w in zip(docs, wanted) if w is None or w == d["text"] or brute.words(w)]
    same(kept.select("doc_id", "text").collect(), left)
    assert lines.dedup_lines(empty).count() == 0


def test_line_similarity_at_the_limit(spark):
    ten = "a b c d e f g h i j"
    rows = [(1, "a b c\n" + ten), (2, "a b c\na b c d e f g h i k"), (3, "a b c d e f\nj i h g f e d c b a")]
    # nine of eleven words in common, six of ten, all in another order
    got = lines.kept_texts(spark.createDataFrame(rows, "doc_id int, text string"))
    assert {r.doc_id: r.text for r in got.collect()} == {1: "a b c\n" + ten, 3: "a b c d e f"}


def test_lines_near_a_removed_line_with_copies(spark):
    """Line a is near b only, whose first place is before a and whose copies are behind it; b is near c. All their rare words
    are in many lines."""
    rng = random.Random(3)
    rare, usual = [f"t{k}" for k in range(5)], [f"y{k}" for k in range(200)]
    z = [f"z{k}" for k in range(15)]
    c, b, a = z[:11], z[:9] + z[11:13], z[:7] + z[11:15]
    own = [(1, c), (5, b), (50, a), *[(100 + k, b) for k in range(6)]]
    own += [(200 + k, rng.sample(usual, 11)) for k in range(60)]
    docs = [{"doc_id": i, "text": " ".join(rare + ws)} for i, ws in own]
    docs += [{"doc_id": 1000 + k, "text": "\n".join(usual + z)} for k in range(150)]
    rows = [(d["doc_id"], d["text"]) for d in reversed(docs)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.text for r in lines.dedup_lines(frame).select("row.*").collect()}
    assert got == {d["doc_id"]: t for d, t in zip(docs, brute.deduped_lines(docs))}
    assert got[1] and not got[5] and not got[50]


def test_short_lines(spark):
    texts = ["menu\n\nread more\na b c d", "more read\nmenu\nread\n \na b c", None, "a b c e\n\nd c b a\nmenu\nmenu"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.text for r in lines.dedup_lines(frame).select("row.*").collect()}
    # three of four words are near enough, two of three not
    assert got == {0: texts[0], 1: "read\n ", 2: None, 3: ""}
    assert {r.doc_id: r.text for r in lines.kept_texts(frame).collect()} == {0: texts[0], 1: "read\n ", 2: None}


@pytest.mark.parametrize("operator, size", [(repeats.seed_and_extend, 35), (suffixes.suffix_array, 50)])
def test_repeats(frame, empty, docs, operator, size):
    got = operator(frame).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    same(got, [(d["doc_id"], *r) for d, r in zip(docs, brute.repeats(docs, size))])
    assert sum(r.n_removed for r in got) > 600
    assert operator(empty).count() == 0


def test_repeats_that_differ_around_a_shared_anchor(spark):
    """Three texts share an anchor, and only two of them the words around it."""
    rng = random.Random(5)
    core = [f"c{k}" for k in range(30)]
    left, right = ([f"{s}{rng.randrange(10**9)}" for _ in range(20)] for s in "lr")
    texts = [left + core + ["x"] * 3, ["y"] + core + right, ["z"] * 9 + left[5:] + core + right[:3], core]
    rows = [{"doc_id": i, "text": " ".join(t)} for i, t in enumerate(texts)]
    frame = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id int, text string")
    for operator, size in ((repeats.seed_and_extend, 35), (repeats.seed_and_extend, 31), (suffixes.suffix_array, 32)):
        got = operator(frame, size).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
        same(got, [(r["doc_id"], *w) for r, w in zip(rows, brute.repeats(rows, size))])


def test_sentencepiece(frame, empty, docs):
    model = public_tokenizers.path(catalogue.PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    got = sentencepieces.token_digests(sentencepieces.encode_decode(frame, model)).collect()
    ids = [library.encode(d["text"] or "") for d in docs]
    wanted = [
        (d["doc_id"], len(i), brute.sha(",".join(map(str, i))), brute.sha(library.decode(i)), True) for d, i in zip(docs, ids)
    ]
    same(got, wanted)
    assert sentencepieces.encode_decode(empty, model).count() == 0


def test_heap_and_row_agendas_agree():
    merger = sentencepieces.Merger(open(public_tokenizers.path(catalogue.PIECES), "rb").read())
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("▁aeinrst日\t") for _ in range(rng.randrange(1, 40)))
        assert merger.merge(text) == merger.merge_short(text)
        assert merger.encode(text) == merger.library.encode(text)
    texts = ["".join(rng.choice("▁aeinrstAß漢😀\x01\t\n ") for _ in range(rng.randrange(200))) for _ in range(300)]
    assert [merger.encode(t) for t in texts] == merger.library.encode(texts)
    assert merger.agrees()


def test_a_disagreement_with_the_library_fails(spark, monkeypatch):
    merger = sentencepieces.Merger(open(public_tokenizers.path(catalogue.PIECES), "rb").read())
    merger["▁word"] = (5,)
    merger.fresh.append(("▁word", (5,)))
    assert not merger.agrees()


def test_jaccard(frame, empty, docs):
    got = jaccard.jaccard_components(frame).select("doc_id", "n_shingles", "component_id").collect()
    same(got, [(d["doc_id"], *c) for d, c in zip(docs, brute.component_ids(docs))])
    kept = jaccard.one_of_each(frame)
    assert kept.columns == frame.columns
    wanted = brute.one_of_each(docs)
    assert kept.count() == len(wanted)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(
        d["doc_id"] for d in wanted if d["doc_id"] is not None
    )
    assert jaccard.jaccard_components(empty).count() == jaccard.one_of_each(empty).count() == 0


def test_links_between_families(spark):
    """Chains whose ends are not near, and a large family, stay connected."""
    base = [f"t{k}" for k in range(200)]
    chain = [" ".join(f"s{j}" if j < 12 * k else w for j, w in enumerate(base)) for k in range(8)]
    family = [" ".join(f"f{k}" if j == 3 * k else f"b{j}" for j in range(150)) for k in range(40)]
    rows = list(enumerate(chain + family))
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    wanted = brute.component_ids([{"doc_id": i, "text": t} for i, t in rows])
    got = jaccard.jaccard_components(frame).select("doc_id", "n_shingles", "component_id").collect()
    same(got, [(i, *w) for (i, _), w in zip(rows, wanted)])


def test_links_inside_a_group(spark, monkeypatch):
    """Near texts with equal prefixes, in one partition and without a shingle of other groups. Ranks are flat, as on large data."""
    monkeypatch.setattr(jaccard, "bucket_counts", lambda rows: np.zeros(jaccard.BUCKETS, np.int64))
    rng = random.Random(11)

    def prefix(text):
        found = jaccard.shingles(text.encode())
        return len(found), tuple(found[: jaccard.prefix_length(len(found))])

    def family(*places):
        """A text and others, each with one word more changed, all with the same prefix."""
        while True:
            texts = [[f"u{rng.randrange(10**9)}" for _ in range(64)]]
            for at in places:
                texts.append([*texts[-1][:at], f"v{rng.randrange(10**9)}", *texts[-1][at + 1 :]])
            texts = [" ".join(t) for t in texts]
            if len({prefix(t) for t in texts}) == 1:
                return texts

    others = [" ".join(f"o{rng.randrange(10**9)}" for _ in range(50)) for _ in range(100)]
    rows = list(enumerate(family(63) + family(20, 40) + others))  # the ends of the second are not near
    frame = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)
    got = jaccard.jaccard_components(frame).select("doc_id", "n_shingles", "component_id").collect()
    wanted = brute.component_ids([{"doc_id": i, "text": t} for i, t in rows])
    assert [w[1] for w in wanted[:5]] == [0, 0, 2, 2, 2]
    same(got, [(i, *w) for (i, _), w in zip(rows, wanted)])
    assert jaccard.one_of_each(frame).count() == 102


def made_benchmark(docs):
    rng = random.Random(2)
    items = [(k, " ".join(f"q{rng.randrange(10**6)}" for _ in range(n))) for k, n in enumerate((8, 15, 21, 40, 59, 3))]
    return items + [(90, None), (91, ""), (4, items[4][1])]


def planted(docs, items, rng):
    out = []
    for k in range(60):
        item, text = items[k % 5]
        ws = text.split()
        for _ in range(rng.randrange(len(ws) // 5 + 3)):
            at, kind = rng.randrange(len(ws)), rng.randrange(3)
            ws[at : at + 1] = ([f"e{rng.random()}".replace(".", "")], [ws[at], "more"], [])[kind]
        around = docs[k % 20]["text"].split(" ")
        out.append({"doc_id": 1000 + k, "text": " ".join(around[:30] + ws + around[30:60])})
    return out


def test_leaks(spark, frame, empty, docs):
    items = made_benchmark(docs)
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id int, text string, doc_id string")
    own = [*docs, *planted(docs, items, random.Random(9)), {"doc_id": 5000, "text": items[1][1].upper() + "!"}]
    more = spark.createDataFrame([(d["doc_id"], d["text"]) for d in own], "doc_id long, text string")
    wanted = brute.leaks(own, dict(items).items())
    got = {(r.doc_id, r.item_id): r.distance for r in leaks.leaks(more, benchmark).collect()}
    assert got.items() <= wanted.items()
    assert len(got) >= 0.95 * len(wanted) > 20
    assert {k for k, v in wanted.items() if v == 0} <= got.keys()
    left = leaks.without_leaks(more, benchmark)
    gone = {d for d, _ in got}
    assert left.columns == more.columns and left.count() == sum(d["doc_id"] not in gone for d in own)
    assert leaks.leaks(empty, benchmark).count() == 0
    assert leaks.leaks(frame, benchmark.limit(0)).count() == 0
    assert leaks.without_leaks(frame, benchmark.limit(0)).count() == len(docs)


def test_long_short_and_stuttering_items():
    """All are found: long items at the limit of edits, items of under eight words, items of one word said again."""
    rng = random.Random(6)
    word = lambda: f"i{rng.randrange(10**9)}"
    sizes = (400, 7, 5, 3, 1)
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate(sizes)] + [(5, "ho " * 9), (6, "!")]
    texts, wanted = [], set()
    for k in range(40):
        ws = items[0][1].split()
        for kind in range(80):
            at = rng.randrange(len(ws))
            ws[at : at + 1] = ([word()], [ws[at], word()], [])[kind % 3]
        texts.append([word() for _ in range(5)] + ws + [word() for _ in range(5)])
        wanted.add((k, 0))
    for item, text in items[1:6]:
        ws = text.split()
        if item in (1, 2):
            ws[3] = "other"
        wanted.add((len(texts), item))
        texts.append(["x", *ws, "y"])
        wanted.add((len(texts), item))
        texts.append(ws)
        near = [*ws[:-1], "z"] if item == 3 else []
        texts.append(near)
    got = {(t, item): edits for t, item, _, _, edits in leaks.Matcher(items).find(texts)}
    assert got.keys() == wanted


def test_pipeline(spark, docs, tmp_path):
    items = made_benchmark(docs)
    own = [*docs, *[{**d, "lang": "en", "source": "s"} for d in planted(docs, items, random.Random(4))]]
    rows = [(d["doc_id"], d["text"], d["lang"], d["source"], 0) for d in own]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = [d for d, k in zip(own, brute.quality(own)) if k]
    cut = [{**d, "text": t} for d, t in zip(kept, brute.deduped_lines(kept)) if t == d["text"] or brute.words(t)]
    single = brute.one_of_each(cut)
    found = {d for d, _ in brute.leaks(single, dict(items).items())}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(catalogue.PIECES))
    clean = [d for d in single if d["doc_id"] not in found]
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    same(
        [(r.doc_id, r.ids_sha256) for r in got],
        [(d["doc_id"], brute.sha(",".join(map(str, library.encode(d["text"]))))) for d in clean],
    )
    assert 10 < len(got) < len(own) and len(corpus_pipeline.STAGES) == 5


def test_draws_meet_groups_of_like_size(spark):
    """A very common shingle: in each draw, groups of any size find partners, however many of another size there are."""
    sizes = [40 + k % 3 for k in range(50)] + [4000 + k % 3 for k in range(2000)]
    rows = [(7, g, size, 0, g, g) for g, size in enumerate(sizes)]
    shared = spark.createDataFrame(rows, "token long, g long, size int, position int, low long, high long")
    groups = spark.createDataFrame([(g, g, 1) for g in range(len(sizes))], "g long, rep long, n long")
    met = [set(jaccard.drawn_pairs(shared, groups, draw).collect()) for draw in range(3)]
    for pairs in met:
        assert len([g for g, _ in pairs if g < 50]) >= 40 and len([g for g, _ in pairs if g >= 50]) >= 1900
        assert len(pairs) <= len(sizes)
    assert met[0] != met[1] != met[2]


def test_wide_bitmaps_rule_out_long_lines(spark):
    """Most pairs of long lines are ruled out before their words meet; near pairs and those at the limit stay."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    texts = [rng.sample(vocabulary, 200) for _ in range(20)]
    texts += [t[:cut] + [f"n{k}" for k in range(200 - cut)] for t, cut in zip(texts, (199, 190, 180, 172, 171, 150, 100))]
    words = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "l1 long, words array<string>")
    words = words.withColumn("bits", lines.wide_bits(F.col("words")))
    every = [(x, y) for x in range(len(texts)) for y in range(x)]
    pairs = spark.createDataFrame(every, "x long, y long")
    got = {(r.x, r.y) for r in lines.not_too_different(pairs, words).collect()}
    sets = [set(t) for t in texts]
    near = {(x, y) for x, y in every if 7 * len(sets[x] & sets[y]) >= 3 * (len(sets[x]) + len(sets[y]))}
    assert len(near) == 4 and near <= got and len(got) <= 10


def test_lines_of_usual_words_do_not_meet(spark):
    """Unlike lines share most of their words with others, one by one; nearly all that goes on is lines that are near."""
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [rng.sample(vocabulary, rng.randint(2, 40)) for _ in range(600)]
    near = [t[: len(t) - len(t) // 4] for t in texts[:30]] + [t + [f"n{k}" for k in range(len(t) // 3)] for t in texts[30:60]]
    near += [rng.sample(t, len(t)) + ["x", "y"] for t in texts[60:90]]
    near += [[w if rng.random() > 0.13 else f"z{w}" for w in t] for t in texts[90:150]]
    rows = list(enumerate(dict.fromkeys(" ".join(t) for t in texts + near)))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    every, found = lines.text_lines(frame), lines.shared_grams(lines.text_lines(frame))
    ids = {r.l1: r.doc_id for r in every.collect()}
    met = {}
    for r in found.collect():
        met.setdefault(r.gram, []).append(ids[r.l1])
    pairs = {(x, y) for group in met.values() for x in group for y in group if x < y}
    sets = {k: set(t.split(" ")) for k, t in rows}
    alike = {(x, y) for x in sets for y in sets if x < y and 7 * len(sets[x] & sets[y]) >= 3 * (len(sets[x]) + len(sets[y]))}
    assert len(alike) > 90 and alike <= pairs and len(pairs) < 20 * len(rows)
    got = {r.doc_id: r.text for r in lines.dedup_lines(frame).select("row.*").collect()}
    docs = [{"doc_id": k, "text": t} for k, t in rows]
    assert got == {d["doc_id"]: t for d, t in zip(docs, brute.deduped_lines(docs))}


def test_texts_of_lines_that_are_not_asked_for_are_left_out(spark):
    frame = spark.createDataFrame([(k, f"line {k}\nrow {k}") for k in range(500)], "doc_id long, text string")
    every = lines.text_lines(frame)
    known = every.where("doc_id % 50 = 0").select("l1")
    left = lines.marked_lines(every, known)
    assert left.columns == every.columns and 20 <= left.count() <= 30
    assert left.where("doc_id % 50 = 0").count() == 20
