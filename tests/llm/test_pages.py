"""Pages: main text, archives, and verdicts over the link graph."""

import hashlib
import random

import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from labelloom.llm import linkgraph, mainhtml, warc

SCHEMA = "page_id long, url string, html string, text string, path string, host string"

PAGE = """<!DOCTYPE html><html><head><title>Head</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div>
<div class="post post-%d"><h1>Title &amp; more</h1><p>First   one<br>with <b>bold &eacute;</b> text &lt;p&gt;.
<p>Second one that is long enough to count as the text of the page.<ul><li>item one<li>item two</ul>
<form><input name=q><button>Send</button></form><script>if (a < b) {"</p>"}</script>
<table><tr><td>cell</td><td>cell 2</td></tr></table><p class="share">Share it</p></div>
<aside>Related</aside><div id="comments"><p>A reader says a lot of things here, many more than the article does.</p></div>
<footer>&copy; Site</footer></body></html>"""
TEXT = "Title & more\nFirst one with bold é text <p>.\nSecond one that is long enough to count as the text of the page."
TEXT += "\nitem one\nitem two\ncell\ncell 2"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


def test_main_text(spark):
    rows = [(k, f"http://A.example/{k}", PAGE % k) for k in range(3)]
    rows += [(3, "http://a.example/short", '<div class="post post-9"><p>Only this'), (4, None, None), (5, "", "")]
    rows += [(6, "http://b.example/", "no markup &amp; none"), (6, "http://b.example/", "no markup &amp; none")]
    rows += [(7, "http://c.example/", "<nav>only</nav><script>x"), (8, "x://y/", "</div></p><b>broken <i>but</p> there<!-- x")]
    rows += [(None, "http://a.example/", PAGE % 12), (9, "http://d.example", "<p>" + "long " * 50_000)]
    got = mainhtml.main_text(pages(spark, rows)).collect()
    texts = {(r.page_id, r.url): r.text for r in got}
    assert len(got) == len(rows)
    assert [texts[k, f"http://A.example/{k}"] for k in range(3)] == [TEXT] * 3 and texts[None, "http://a.example/"] == TEXT
    assert texts[3, "http://a.example/short"] == "Only this"
    assert texts[4, None] == texts[5, ""] == texts[7, "http://c.example/"] == ""
    assert texts[6, "http://b.example/"] == "no markup & none" and texts[8, "x://y/"] == "broken but\nthere"
    assert len(texts[9, "http://d.example"]) == 5 * 50_000 - 1
    assert mainhtml.main_text(pages(spark, [])).count() == 0


def test_hosts_agree_on_a_path(spark):
    """One page whose largest container is another one still follows its host."""
    usual = "<body><div class=story><p>%s</p></div><div class=extra><p>few words</p></div></body>"
    odd = "<body><div class=story><p>the text</p></div><div class=extra><p>" + "many words " * 9 + "</p></div></body>"
    rows = [(k, "http://h/", usual % ("words of the text " * 9)) for k in range(5)] + [(9, "http://h/", odd)]
    top = mainhtml.consensus(pages(spark, rows)).collect()
    assert [(r.host, r.path) for r in top] == [("h", "/body/div.story")]
    assert {r.page_id: r.text for r in mainhtml.main_text(pages(spark, rows)).collect()}[9] == "the text"


def test_title_lead_and_sections_stay(spark):
    long = "words of the story that go on " * 20
    body = f"<div class=body><p>{long}</p></div>"
    links = "<div class=more><p><a href=/a>Another story</a></p><p><a href=/b>And another one</a></p></div>"
    layouts = {
        "post": (f"<div class=post><h1>Title</h1><p>Lead</p>{body}</div>", f"Title\nLead\n{long}"),
        "wrapped": (f"<div class=post><div class=top><h1>Title</h1></div>{body}</div>{links}", f"Title\n{long}"),
        "main": (
            f"<main><p>Intro</p><article><p>{long}</p></article><section><p>{long}1</p></section></main>",
            f"Intro\n{long}\n{long}1",
        ),
        "links": (f"<div class=page>{body}{links}</div>", long),
        "columns": (f"<p>Direct</p>{body}<div class=extra>Column</div>", long),
        "svg": (f"<div class=post><svg width='1'/><math/><svg a=b /><h1>Title</h1>{body}</div>", f"Title\n{long}"),
        "value": ("<div><p>Before<svg a=b/>drawn</svg> after</p></div>", "Before after"),
    }
    rows = [(k, f"http://{n}/", f"<html><body>{h}</body></html>") for k, (n, (h, _)) in enumerate(layouts.items())]
    got = {r.url.split("/")[2]: r.text for r in mainhtml.main_text(pages(spark, rows)).collect()}
    tidy = lambda t: "\n".join(" ".join(x.split()) for x in t.split("\n"))
    for name, (_, text) in layouts.items():
        assert got[name] == tidy(text), name


def test_archives(spark, tmp_path):
    rng = random.Random(1)
    same = "<p>same</p>"
    rows = [(k, f"http://h/{k}", "".join(rng.choice("abc é") for _ in range(k * 40))) for k in range(60)]
    rows += [(k, "http://h/s", same) for k in (70, 99, 80)] + [(99, "http://h/s", same), (None, "a b\n\"", same)]
    rows += [(100, None, None), (101, "", ""), (None, None, "alone"), (200, "http://h/long", "x" * 3_000_000)]
    index = warc.write_archives(pages(spark, rows).repartition(3), f"file://{tmp_path}/warc", frame_bytes=4096)
    got = warc.read_archives(index).collect()
    digest = lambda t: warc.digest_of((t or "").encode())
    last = {}
    for page, _, html in rows:
        last[html or ""] = max(last.get(html or "", -1), -1 if page is None else page)
    wanted = []
    for page, _, html in rows:
        top = last[html or ""] if last[html or ""] >= 0 else None
        to = None if page == top else top
        size = len((html or "").encode())
        wanted.append((page, size, digest(html), "response" if to is None else "revisit", to))
    key = lambda r: str(tuple(r))
    rows_got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(rows_got, key=key) == sorted(wanted, key=key)
    assert warc.read_archives(warc.write_archives(pages(spark, []), f"{tmp_path}/none")).count() == 0

    entry = index.where("page_id = 42").first()  # one record by its offsets alone
    fs, path = pa.fs.FileSystem.from_uri(entry.bundle)
    with fs.open_input_file(path) as file:
        file.seek(entry.frame_offset)
        frame = zstandard.ZstdDecompressor().decompress(file.read(entry.frame_bytes))
        table = warc.seek_table(file)
    record = frame[entry.record_offset : entry.record_offset + entry.record_bytes]
    assert record.startswith(b"WARC/1.1\r\n") and record.endswith(rows[42][2].encode() + b"\r\n\r\n")
    assert len(table) > 1 and table[entry.frame][0] == entry.frame_offset
    with open(path, "rb") as file:  # any Zstandard reader gets the whole archive
        plain = zstandard.ZstdDecompressor().stream_reader(file.read(), read_across_frames=True).read()
    assert plain.count(b"WARC/1.1\r\n") == index.where(F.col("bundle") == entry.bundle).count()


RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"))


def test_rules(spark):
    urls = {
        "http://Shop.COM/a": ("com/", "allow"),
        "http://example.com/en/x?y": ("example.com/en/", "block"),
        "http://a.www.example.com/en/": ("www.example.com/en/", "allow"),
        "http://www.example.com/en": ("com/", "allow"),
        "http://notexample.com/en/": ("com/", "allow"),
        "http://com": (None, "allow"),
        "http://x.net/es/1#a": ("net/es/", "block"),
        "http://x.net/de/": (None, "allow"),
        "x.net/es/": (None, "allow"),
        "": (None, "allow"),
        None: (None, "allow"),
        "http://com:80/": (None, "allow"),
        "a://b://c.com/": (None, "allow"),
    }
    rows = [(k, u, None) for k, u in enumerate(urls)] * 2
    got = linkgraph.judged(pages(spark, rows), linkgraph.rule_table(spark, RULES)).collect()
    assert len(got) == 2 * len(urls)
    assert {(r.page_id, r.rule, r.verdict) for r in got} == {(k, *v) for k, v in enumerate(urls.values())}
    one = next(r for r in got if r.page_id == 1)
    assert (one.host, one.path) == ("example.com", "/en/x")
    assert linkgraph.judged(pages(spark, []), linkgraph.rule_table(spark, RULES)).count() == 0


def plain_rank(links, seeds, rounds):
    """The same sums with plain dictionaries."""
    out = {}
    for a, _, n in links:
        out[a] = out.get(a, 0) + n
    total = sum(seeds.values())
    start = {h: w * 10**6 // total * 10**6 for h, w in seeds.items()}
    scores = dict(start)
    for _ in range(rounds):
        new = {h: m * 15 // 100 for h, m in start.items()}
        for a, b, n in links:
            if a in scores:
                new[b] = new.get(b, 0) + scores[a] * (n * 10**6 // out[a]) // 10**6 * 85 // 100
        scores = new
    return scores


def test_propagation(spark):
    link = lambda *hosts: " ".join(f'<a href="https://{h}/p">x</a>' for h in hosts)
    rows = [
        (1, "http://good.com/", link("Friend.org", "good.com", "pal.org")),
        (2, "http://friend.org/", link("pal.org") + "<a href=//pal.org/2>y</a>"),
        (3, "http://bad.net/es/", link("pal.org")),
        (4, "http://farm.org/", link("bad.net", "friend.org")),
        (5, "http://far.org/", link("farm.org")),
        (6, "http://pal.org/", "<a href='/es/'>"),
        (7, "http://lone.org/", None),
    ]
    got = linkgraph.judged(pages(spark, rows), linkgraph.rule_table(spark, RULES)).collect()
    links = [("good.com", "friend.org", 1), ("good.com", "pal.org", 1), ("friend.org", "pal.org", 1), ("bad.net", "pal.org", 1)]
    links += [("farm.org", "bad.net", 1), ("farm.org", "friend.org", 1), ("far.org", "farm.org", 1)]
    trust = plain_rank(links, {"good.com": 1}, linkgraph.ITERATIONS)
    distrust = plain_rank([(b, a, n) for a, b, n in links], {"bad.net": 1}, linkgraph.ITERATIONS)
    for r in got:
        assert (r.trust, r.distrust) == (trust.get(r.host, 0), distrust.get(r.host, 0)), r
    verdicts = {r.host: r.verdict for r in got}
    blocked = {h for h, v in verdicts.items() if v == "block"}
    assert blocked == {"bad.net", "farm.org", "far.org"}


def test_small_hosts_in_a_large_graph(spark):
    """Seeds of over a million pages in all, a host with over a million page-links, and a ring that settles slowly."""
    n = 3_000_000
    links = [("small.org", "hub.org", 1), ("hub.org", "rare.org", 1), ("hub.org", "big.org", n)]
    links += [(f"r{k}", f"r{(k + 1) % 30}", 1) for k in range(30)]
    seeds = {"small.org": 1, "hub.org": n, "r0": n}
    frames = (
        spark.createDataFrame(links, "source string, target string, pages long"),
        spark.createDataFrame(list(seeds.items()), "host string, weight long"),
    )
    got = {r.host: r.score for r in linkgraph.propagated(*frames).collect()}
    total = sum(seeds.values())
    share = {h: linkgraph.SCALE * w / total for h, w in seeds.items()}
    small = share["small.org"] * 0.15
    hub = share["hub.org"] * 0.15 + small * 0.85
    wanted = {"small.org": small, "hub.org": hub, "rare.org": hub * 0.85 / (n + 1), "big.org": hub * 0.85 * n / (n + 1)}
    wanted |= {f"r{k}": share["r0"] * 0.15 * 0.85**k / (1 - 0.85**30) for k in range(30)}
    assert got.keys() == wanted.keys()
    assert all(abs(got[h] - v) < linkgraph.LEAST_DISTRUST for h, v in wanted.items())
    assert abs(got["small.org"] - small) < 2 and abs(got["rare.org"] - wanted["rare.org"]) < 2


def test_digest_is_sha1_in_base32():
    import base64

    assert warc.digest_of(b"") == base64.b32encode(hashlib.sha1(b"").digest()).decode() and len(warc.digest_of(b"x")) == 32


@pytest.mark.parametrize(
    ("inside", "text"),
    [
        ('<article data-id="banner-12"><p>{}</p></article>', "{}"),
        ('<article data-role="search"><p>{}</p></article>', "{}"),
        ("<article><p>the value <math><mi>x</mi><mo>=</mo><mn>3</mn></math> holds. {}</p></article>", "the value x=3 holds. {}"),
        ('<article><p>{}</p><a href="x>more</a></article>', "{}\nmore"),
    ],
)
def test_names_formulas_and_open_quotes(spark, inside, text):
    prose = "Long running prose that has many words in it, none of them a link. " * 8
    page = f"<html><body><nav><a href='/'>home</a></nav>{inside.format(prose)}</body></html>"
    df = spark.createDataFrame([(1, "http://a.com/x", page)], "page_id long, url string, html string")
    assert mainhtml.main_text(df).first().text == text.format(prose.strip())


def test_archives_are_read_by_several_tasks(spark):
    rows = [(k, f"http://a.com/{k}", f"<p>{k} " + f"{k * 7919 % 1000:04d} " * 500) for k in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    read = warc.read_archives(warc.write_archives(df, frame_bytes=20_000))
    tasks = {r.task for r in read.select(F.spark_partition_id().alias("task")).collect()}
    assert len(tasks) > 1 and read.count() == 200
