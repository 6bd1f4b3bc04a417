"""Main text of pages by markup and by repeats; archives written and read back."""

import glob
import gzip
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pulsegrain.llm import extract, warc
from pulsegrain.llm.common import shared_path

PAGES = "page_id bigint, url string, html string"


def words(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randrange(1000)) for _ in range(n))


@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain &amp; text &eacute; &#x41;&#66; &am", "plain & text é AB &am"),
    ("<p>a<p>b <b>c\n\t d</b><br>e<div>f</div>g", "a\nb c d e\nf\ng"),
    ("<nav>n</nav><main><h1>T</h1><p>x</p><aside>s</aside><form>f<button>b</button></form></main><footer>z</footer>", "T\nx"),
    ("<article><header><h1>T</h1></header><p>x</p><section class='comments'><p>c</p></section></article><header>site</header>", "T\nx"),
    ("<div class=\"ad\">a</div><article>x<script>var a='</p><p>no';</script><style>p{}</style><!-- c -->y</article>", "xy"),
    ("<article><p>x<span hidden>h</span> y<span style='display: none'>z</span></article>", "x y"),
    ("<article>a</b></article></div></p>b<", "a\nb<"), ("<ul><li>a<li>b<ul><li>c</ul></ul>", "a\nb\nc"),
    ("<ARTICLE>A<DIV CLASS='Cookie-Notice'>no</DIV>B</ARTICLE>", "A\nB"), ("<p title='a>b'>x</p><a href=\"y", "x"),
    ("<div id=sidebar>s</div><div role=navigation>n</div>rest", "rest"), ("x<!-- never closed <p>y", "x"),
])
def test_blocks_by_markup(html, text):
    assert extract.main_texts([html])[0][0] == text


def brute_covered(tokens, pages, least):
    runs = {}
    for i in range(len(tokens) - least + 1):
        if pages[i] == pages[i + least - 1]:
            runs.setdefault(tuple(tokens[i:i + least]), []).append(i)
    out = np.zeros(len(tokens), bool)
    for starts in runs.values():
        if len({pages[i] for i in starts}) > 1:
            for i in starts:
                out[i:i + least] = True
    return out


@pytest.mark.parametrize("seed", range(25))
def test_suffix_array_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(0, 300))
    tokens, pages = rng.integers(0, 4, n), np.sort(rng.integers(0, 6, n))
    least = int(rng.integers(1, 9))
    assert (extract.covered(tokens, pages, least) == brute_covered(tokens.tolist(), pages.tolist(), least)).all()


def test_templates_without_names_are_found_by_repeats():
    rng = random.Random(2)
    menu, imprint = words(rng, 12), words(rng, 20)
    bodies = [[words(rng, 30), words(rng, 15)] for _ in range(6)]
    pages = [f"<div>{menu}</div><div><p>{a}</p><p>{b}</p></div><div>{imprint}</div>" for a, b in bodies]
    pages.append(pages[0])  # a copy must not make the first page's own text boilerplate
    assert [t for t, _ in extract.main_texts(pages)] == ["\n".join(b) for b in [*bodies, bodies[0]]]


def test_repeats_inside_articles_stay():
    licence = "this passage of many words is in every article of the site and stays in all of them"
    got = extract.main_texts([f"<article><p>own {k}</p><p>{licence}</p></article><div>{licence}</div>" for k in range(3)])
    assert [t for t, _ in got] == [f"own {k}\n{licence}" for k in range(3)]


def test_extraction_of_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "http://a.b/x", "<p>x"), (3, "no url", "<p>" + "w " * 200_000), (4, "http://HOT.x:80/", ""), (5, "", "&lt;p&gt;")]
    rows += [(100 + i, "http://u@hot.x/p", f"<div>menu of the hot host with quite a few words</div><p>text {i} of page {i}</p>") for i in range(60)]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 as host", "2 as shard", "3 as shards")
    got = extract.extract(df, shard_chars=1500).collect()
    assert Counter((r.page_id, r.url) for r in got) == Counter((p, u) for p, u, _ in rows)
    by = {r.page_id: r for r in got}
    assert by[1].text == "" and by[None].text == "x" and by[5].text == "<p>" and by[3].n_chars == 2 * 200_000 - 1
    assert all(by[100 + i].text == f"text {i} of page {i}" for i in range(60))
    assert extract.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_shards_of_a_host_do_not_change_its_repeats(spark):
    rng = random.Random(8)
    menu, pairs = words(rng, 12), [words(rng, 20) for _ in range(40)]
    rows = [(k, "http://hot.x/p", f"<nav>{menu}</nav><p>{words(rng, 15)}</p><p>{pairs[k % 40]}</p><article>own {k}</article>") for k in range(80)]
    rows += [(100 + k, "http://hot.x/q", rows[k][2]) for k in range(20)]
    rows += [(200 + k, "http://hot.x/q", f"<p>{pairs[0]}</p>") for k in range(4)] + [(300, "http://cold.x/", rows[0][2])]
    df = spark.createDataFrame(rows, PAGES)
    one, many = (sorted(map(tuple, extract.extract(df, shard_chars=size).collect()), key=str) for size in (2**22, 1000))
    assert one == many and all(pairs[r[0] % 40] not in r[2] for r in many if r[0] < 80)


ROWS = [(5, "http://a/1", "x" * 100), (3, "http://a/ü\n2", "x" * 100), (9, None, "x" * 100), (1, "u", "x" * 99), (2, "u", "x" * 99), (3, "http://a/ü\n2", "x" * 100),
        (4, "e", None), (6, "e", ""), (None, "n", "x" * 100), (7, "long", "".join(chr(32 + k * k % 90) for k in range(400_000)))]


def test_archives(spark):
    df = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "1 as payload", "2 as digest", "3 as first", "4 as record_type")
    path = shared_path(spark, "test-warc")
    warc.write_archives(df, path)
    want = Counter()
    for page_id, _, html in ROWS:
        data = (html or "").encode()
        revisit = len(data) == 100 and page_id is not None and page_id > 3
        want[page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None] += 1
    for size in (37, 1000, 2**23):
        got = warc.read_archives(spark, path, range_bytes=size).collect()
        assert Counter(tuple(r)[:5] for r in got) == want
    assert {r.page_id: bytes(r.payload).decode() for r in got if r.page_id in (1, 7)} == {1: "x" * 99, 7: ROWS[-1][2]}
    # Any reader of gzip can read the files: they are members without a gap.
    whole = b"".join(gzip.decompress(open(f, "rb").read()) for f in glob.glob(f"{path.removeprefix('file:')}/part-*") if open(f, "rb").read(1))
    assert whole.count(b"WARC/1.1\r\n") == len(ROWS)


def test_members_of_sixteen_mebibytes_and_false_magic():
    import io

    rng = random.Random(1)
    big = bytes(rng.randrange(256) for _ in range(1000)) * 17_000
    parts = [warc._member(warc.record(k, "u", data, hashlib.sha256(data).hexdigest(), "response", None)) for k, data in enumerate([big, b"a", warc.MAGIC * 50])]
    assert parts[0][-1] != 0
    file = b"junk" + warc.MAGIC + b"junk" + b"".join(p + (warc._EMPTY if p[-1] else b"") for p in parts)
    found = []
    for start in range(0, len(file), 1000):
        for member in warc.members(warc._Window(io.BytesIO(file)), start, min(len(file), start + 1000)):
            found += [warc.decode(*r)[0] for r in warc.records(member)]
    assert found == [0, 1, 2]


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0
