import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegraph.llm import html_text, packing, queries, warc


@pytest.fixture(scope="module")
def path():
    pytest.importorskip("public_tokenizers")
    return queries.tokenizer_path()


def test_word_ids_are_the_tokenizers(path):
    from tokenizers import Tokenizer

    t, w = Tokenizer.from_file(path), packing.WordIds(path)
    texts = ["It's a <|ENDOFTEXT|> x<|endoftext|>y, Σας É. é. don't, a.. b,. 3. 'S. \x1cq\x85z\xa0k ΑΣ. İ. ́x á. i̇. ½. x‍. हिन्दी। 漢字, ok.", "", " \n", "word. Word, WORD"]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in w.texts([s.encode() for s in texts])] == [t.encode(s, add_special_tokens=False).ids for s in texts]


def test_pieces_and_packing(spark, docs, path):
    from tokenizers import Tokenizer

    t, r = Tokenizer.from_file(path), random.Random(4)
    rows = [(i, " ".join(r.choices(["alpha", "beta", "x1", "gamma."], k=r.choice([0, 1, 5, 40, 200]))), None) for i in range(400)]
    rows += [(400, None, None), (401, "alpha " * 300, None), (7, "again", None), (None, "beta", None)]
    out = packing.pack_documents(docs(rows), path, length=128, open_bins=8, packer_rows=60, fan_in=3).collect()
    want, got, bins = [], [], {}
    for d, x, _ in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids + [1]
        want += [(d, k // 128, k, len(ids[k : k + 128]), zlib.crc32(np.array(ids[k : k + 128], "<u4").tobytes())) for k in range(0, len(ids), 128)]
    for p in out:
        got.append((p.doc_id, p.piece, p.start, p.length, p.ids_crc32))
        assert zlib.crc32(p.ids) == p.ids_crc32
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sorted(got, key=str) == sorted(want, key=str)
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 128
    assert len(bins) <= 1.03 * sum(p.length for p in out) / 128 + 2


def test_packer_is_best_fit_and_closes_the_fullest():
    p = packing.Packer(10, 2)
    for i, n in enumerate([6, 7, 3, 4]):
        p.add(i, n)
    assert p.bins == [[0, 3], [1, 2]] and p.n_open == 0
    p = packing.Packer(10, 2)
    for i, n in enumerate([6, 9, 8]):
        p.add(i, n)
    assert [len(x) for x in p.bins] == [1, 1, 1] and p.open() == [0, 2]


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_packing_small_tables(spark, path, rows):
    out = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()
    assert [(r.doc_id, r.piece, r.length, r.offset) for r in out] == [(None, 0, 1, 0)] * len(rows)


def page(i, body):
    return warc.page_record(i, f"http://x/{i} y", body, __import__("hashlib").sha256(body).hexdigest(), None)


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage(compressed):
    raw = [page(i, bytes([65 + i]) * (50 + 300 * i)) for i in range(6)]
    parts = [warc.member(x) for x in raw] if compressed else raw
    whole = b"".join(parts)
    assert [x.kind for x in warc.read_archive(whole)] == ["response"] * 6
    broken = bytearray(whole)
    at = sum(map(len, parts[:2])) + len(parts[2]) // 2
    broken[at] ^= 0xFF
    got = list(warc.read_archive(bytes(broken)))
    gaps = [x for x in got if isinstance(x, warc.Gap)]
    assert len(got) - len(gaps) == 5 and len(gaps) == 1
    assert (gaps[0].offset, gaps[0].length) == (sum(map(len, parts[:2])), len(parts[2]))
    got = list(warc.read_archive(b"junk" + whole[: -len(parts[5]) // 2]))
    assert [type(x).__name__ for x in got] == ["Gap"] + ["Record"] * 5 + ["Gap"]
    assert list(warc.read_archive(b"")) == []


def test_an_archive_compressed_as_one():
    raw = [page(i, bytes([65 + i]) * (50 + 300 * i)) for i in range(6)]
    whole = b"".join(raw)
    got = list(warc.read_archive(warc.member(whole)))
    assert [x.kind for x in got] == ["response"] * 6 and [x.block.endswith(bytes([65 + i])) for i, x in enumerate(got)] == [True] * 6
    broken = bytearray(whole)  # one record within is damaged: the others are read
    broken[len(raw[0]) + len(raw[1]) // 2] ^= 0xFF
    got = list(warc.read_archive(warc.member(bytes(broken)) + warc.member(raw[5])))
    assert [type(x).__name__ for x in got] == ["Record", "Gap", *["Record"] * 5]
    assert got[1].length == len(raw[1]) and "within the member" in got[1].reason
    tail = list(warc.read_archive(warc.member(raw[0] + b"tail")))
    assert [type(x).__name__ for x in tail] == ["Record", "Gap"] and tail[1].length == 4
    rng = np.random.default_rng(2)
    noisy = [page(i, rng.integers(0, 256, 20_000, np.uint8).tobytes()) for i in range(6)]
    cut = warc.member(b"".join(noisy))
    got = list(warc.read_archive(cut[: len(cut) * 7 // 10]))  # broken off: what came whole before that is kept
    assert [type(x).__name__ for x in got[:4]] == ["Record"] * 4 and isinstance(got[-1], warc.Gap)


def test_many_damaged_members_cost_no_more_than_their_bytes():
    import time

    one = warc.member(page(1, b"x" * 400))
    bad = bytearray(one)
    bad[len(bad) // 2] ^= 0xFF
    began = time.time()
    got = list(warc.read_archive(bytes(bad) * 8_000 + one))
    assert time.time() - began < 5 and [type(x).__name__ for x in got] == ["Gap", "Record"] and got[0].length == 8_000 * len(bad)
    lines = b"WARC/1.1\r\nA: b\r\n" * 20_000  # headers that never end
    began = time.time()
    assert [type(x).__name__ for x in warc.read_archive(lines)] == ["Gap"]
    assert time.time() - began < 60


def test_long_members_end_with_a_zero_byte():
    big = warc.member(bytes(17 << 20), 1)
    assert big[-1] == 0 and next(iter([warc._inflate(memoryview(big), 0)]))[0] == bytes(17 << 20)


def test_round_trip_of_odd_pages(spark, tmp_path):
    same, small = "<p>" + "é" * 80, "tiny"
    rows = [(5, "u", same), (3, None, same), (9, "a\r\nb", same), (9, "v", same), (4, "u", small), (6, "u", small), (7, "u", None), (8, "u", ""), (None, "u", same), (2, "u", "WARC/1.1\r\n\x1f\r\n\r\n\x00" * 9)]
    out = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w")).collect()
    got = {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in out}
    assert len(out) == len(rows)
    assert got == {(3, 163, "response", None), (5, 163, "revisit", 3), (9, 163, "revisit", 3), (4, 4, "response", None), (6, 4, "response", None), (7, 0, "response", None), (8, 0, "response", None), (None, 163, "response", None), (2, 9 * 16, "response", None)}
    import gzip
    import hashlib

    assert {r.payload_digest for r in out if r.page_id == 5} == {hashlib.sha256(same.encode()).hexdigest()}
    files = list((tmp_path / "w").glob("part-*"))
    assert files and all(gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") for f in files)
    for f in files[:1]:  # damage one archive; the rest of it is still read
        b = bytearray(f.read_bytes())
        b[len(b) // 2] ^= 0xFF
        f.write_bytes(b)
        f.with_name("." + f.name + ".crc").unlink(missing_ok=True)
    assert warc.quarantine(warc.read(spark, str(tmp_path / "w"))).count() == 1


def test_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(none, str(tmp_path / "n")).collect() == [] and html_text.extract(none).collect() == []


def test_tree_marginals_match_enumeration():
    import itertools

    r = np.random.default_rng(1)
    parent, depth, group = np.array([-1, 0, 0, 1, 1, 2]), np.array([0, 1, 1, 2, 2, 2]), np.array([0, 1, 2, 1, 0, 2])
    score, pair = r.normal(size=6), r.normal(size=(3, 2, 2))
    total, on = 0.0, np.zeros(6)
    for y in itertools.product((0, 1), repeat=6):
        w = np.exp(sum(score[i] * y[i] for i in range(6)) + sum(pair[group[i], y[parent[i]], y[i]] for i in range(1, 6)))
        total += w
        on += w * np.array(y)
    assert np.allclose(html_text.messages(score, pair, parent, group, depth)[0], on / total)


def test_unseen_layouts():
    w, pair = html_text.train()
    pages = html_text.labelled_pages(200, seed=99)
    got = html_text.main_texts([h for h, _ in pages], w, pair)
    assert sum(a == b for a, (_, b) in zip(got, pages)) >= 190


def test_page_oddities(spark):
    html = "<html><body><nav><a href=/>Home</a></nav><div class=ad>Buy now</div><article><h1>T &amp; U&copy</h1><p><b>One\n two<br>three<p>a &lt;b&gt; c</p><script>var x='</p>';</script><!-- gone --></article><div id='comments'><p>Nice post, reader.</p></div><footer>&copy; x</footer></body></html>"
    rows = [(1, "u", html), (2, None, None), (3, "u", ""), (4, "u", "<article><p>cut he"), (5, "u", "<article><h1>Title</h1><p>whole text here, and more.</p><p>second</p><foo"), (1, "u", html)]
    got = sorted((r.page_id, r.text, r.n_chars) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    text = "T & U©\nOne two three\na <b> c"
    assert got == [(1, text, len(text)), (1, text, len(text)), (2, "", 0), (3, "", 0), (4, "cut he", 6), (5, "Title\nwhole text here, and more.\nsecond", 39)]


LONG = ("A plain sentence of a story that goes on. It has another one, and a third that follows. " * 4).strip()


@pytest.mark.parametrize("body", [
    f"<div>{LONG}</div><div>{LONG}</div>", f"<div><p>{LONG}</p><p>{LONG}</p></div>", f"<p>{LONG}</p><p>{LONG}</p>", f"<div><div>{LONG}</div></div><div>{LONG}</div>",
f"<section><p>{LONG}</p></section><section><p>{LONG}</p></section>", f"<center><p>{LONG}</p><p>{LONG}</p></center>",
])
def test_pages_that_say_little_of_themselves(body):
    w, pair = html_text.train()
    nav = "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>About us</a></li></ul></nav>"
    assert html_text.main_texts([f"<html><body>{nav}{body}<footer>&copy; x</footer></body></html>"], w, pair) == [f"{LONG}\n{LONG}"]


def test_headers_of_articles_and_slashes():
    w, pair = html_text.train()
    article = f"<html><body><header class=site><p>Site</p></header><article><header><h1>Title of it all</h1></header><p>{LONG}</p></article></body></html>"
    assert html_text.main_texts([article], w, pair) == [f"Title of it all\n{LONG}"]
    more = f"<article><h1>Title</h1><p>{LONG}</p><div class='more'><p>{LONG} {LONG}</p></div></article>"  # much text, whatever its class says
    assert html_text.main_texts([more], w, pair) == [f"Title\n{LONG}\n{LONG} {LONG}"]
    page = "<html><body><article><p>" + LONG + "</p>{}<p>" + LONG + "</p></article></body></html>"
    hidden = ['<script src="a.js" />var a=1;</script>', "<style/>p{}</style>", "<template/>x</template>", "<svg><title/><desc/><script/></svg>", "<svg/><script src=/x/>y</script>", "<math><annotation/></math>"]
    for h in hidden:
        assert html_text.main_texts([page.format(h)], w, pair) == [f"{LONG}\n{LONG}"], h


def test_deep_pages_in_proportion():
    import time

    w, pair = html_text.train()
    took = []
    for n in (20_000, 80_000):
        began = time.time()
        html_text.main_texts(["<div>" * n + LONG], w, pair)
        took.append(time.time() - began)
    assert took[1] < 10 * took[0] + 1


def test_raw_text_elements_end_at_their_own_tag():
    w, pair = html_text.train()
    page = "<html><head>{}</head><body><article><h1>Title</h1><p>whole text here, and more.</p>{}<p>second one, after it.</p></article>{}</body></html>"
    text = "Title\nwhole text here, and more.\nsecond one, after it."
    raw = [
        "<script>for(i=0;i<n;i++){f(i);}</script>", "<script>if(a<b){s='it';t=\"don't\"}</script >", "<SCRIPT>x<y';</Script\n>", "<script><!-- old browsers\nf();</script>",
        "<script>s='</scripts>'+'<p>no</p>';</script>", "<style>a<b'{}</style>", "<noscript><img alt=it's<p></noscript>", "<textarea>1 <b' 2</textarea>", "<iframe>a <i\" b</iframe>", "<svg><style>a<b'</style></svg>", "<script><!-- </script>",
    ]
    for r in raw:
        assert html_text.main_texts([page.format(r, "", ""), page.format("", r, ""), page.format("", "", r), page.format(r, r, r)], w, pair) == [text] * 4, r
    assert html_text.main_texts([page.format("<title>a <b' c</title>", "", "")], w, pair) == [text]
    assert html_text.main_texts([page.format("", "", "<script>never ends, i<n")], w, pair) == [text]


def _said(source):
    return [t for _, t, _ in html_text.Page(source).runs]


def test_quotes_that_are_never_closed():
    assert _said('<article><p title="a>Unclosed text</p><p class="b">More</p></article>') == ["Unclosed text", "More"]
    assert _said("<p alt='it>odd<b>x</b></p><p>z</p>") == ["oddx", "z"]
    assert _said("<p title='a > b <c>'>ok</p><p data-x=\"<b>hi</b>\">v</p><a href='/?q='>w</a>") == ["ok", "v", "w"]
    assert len(_said("<p title=\"x>some text " * 20_000)) == 20_000
    assert len(_said('<p a="xxxxxxxxxx' + ">t</p>" * 20_000)) == 20_000
    _said("<p title='x>some text \" " * 5_000 + "<b " * 5_000)


def test_formulas_and_drawings_are_text():
    assert _said("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><p><svg><desc>no</desc><text>label</text></svg></p>") == ["so x=2 holds", "label"]
    assert _said("<p>a<script>no()</script><template>no</template><textarea>no</textarea><noscript>no</noscript>b</p>") == ["ab"]


def test_long_pages_and_clashing_columns(spark):
    page = "<html><body><article>" + "".join(f"<p>Sentence number {i} of a very long article, which goes on and on.</p>" for i in range(20_000)) + "</article></body></html>"
    d = spark.createDataFrame([(1, "u", page, "mine", 0)], "page_id long, url string, html string, text string, n_chars int")
    [r] = html_text.extract(d).collect()
    assert r.n_chars == len(r.text) and r.text.count("\n") == 19_999 and r.text.endswith("goes on and on.")


def test_very_long_texts_are_packed(spark, path):
    from tokenizers import Tokenizer

    text = " ".join(f"word{i % 5000}" for i in range(200_000))
    d = spark.createDataFrame([(1, text, 9, "x"), (2, "short", 9, "x")], "doc_id long, text string, piece int, ids string")
    got = sorted(packing.pack_documents(d, path).collect(), key=lambda r: (r.doc_id, r.piece))
    want = [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 1]
    assert np.frombuffer(b"".join(r.ids for r in got if r.doc_id == 1), "<u4").tolist() == want
    assert all(r.length == 4096 for r in got if r.doc_id == 1 and r.piece < len(want) // 4096)


def test_archives_are_bounded_in_bytes(spark, tmp_path):
    import hashlib
    import os

    r = random.Random(3)
    pages = [(i, f"http://x/{i}", "".join(r.choices("abcdefgh", k=4_000))) for i in range(60)]
    d = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"payload": F.lit(1), "digest": F.lit("x"), "value": F.lit(b"y")}).coalesce(1)
    warc.write(d, str(tmp_path / "a"), records=20, most=10_000)
    sizes = [os.path.getsize(tmp_path / "a" / n) for n in os.listdir(tmp_path / "a") if n.startswith("part-")]
    assert len(sizes) > 6 and max(sizes) < 15_000
    got = warc.read(spark, str(tmp_path / "a"))
    assert warc.quarantine(got).count() == 0
    assert sorted(hashlib.sha256(x.payload).hexdigest() for x in got.where("kind = 'response'").collect()) == sorted(hashlib.sha256(h.encode()).hexdigest() for _, _, h in pages)


HAND_LABELLED = [
    (
        """<!doctype html><html lang=en><head><meta charset=utf-8><title>Bread - Blog</title><style>p{color:red}</style><script>for(i=0;i<n;i++){f('</p>')}</script></head>
<body class="home"><div id="wrapper"><div class="site-header"><a href="/">My kitchen</a><p class="tagline">Notes on food</p></div>
<ul class="menu"><li><a href="/a">Home</a></li><li><a href="/b">Recipes</a></li><li><a href="/c">About me</a></li></ul>
<div class="post-content"><h1>How to bake bread</h1><p title="first>Flour, water, salt and time are all that a good loaf needs; everything else is habit.</p>
<p>Mix <math><mi>a</mi><mo>=</mo><mn>500</mn></math> grams of flour with water. Let it rest for an hour, then fold it.</p><ol><li>Heat the oven to its highest mark.</li><li>Bake the loaf for forty minutes.</li></ol>
<blockquote>Good bread is slow bread, as my grandmother used to say.</blockquote></div>
<div class="share-buttons"><a href="#">Tweet</a> <a href="#">Share</a></div>
<div id="comments"><h3>2 comments</h3><div class="comment"><p>Great recipe, thank you very much for it!</p></div><div class="comment"><p>Mine did not rise at all.</p></div></div>
<div class="sidebar"><h3>Popular</h3><ul><li><a href="/1">Ten soups</a></li><li><a href="/2">Cheese</a></li></ul></div><div class="footer">&copy; 2020 My kitchen. All rights reserved.</div></div></body></html>""",
        """How to bake bread
Flour, water, salt and time are all that a good loaf needs; everything else is habit.
Mix a=500 grams of flour with water. Let it rest for an hour, then fold it.
Heat the oven to its highest mark.
Bake the loaf for forty minutes.
Good bread is slow bread, as my grandmother used to say.""",
    ),
    (
        """<html><body><header><nav><a href=/>News</a><a href=/w>World</a><a href=/s>Sport</a></nav></header><main><article><h1>River rises after storm</h1>
<p>The river rose by two metres overnight, officials said on Monday, and several roads were closed.</p><aside class="related"><h2>Related</h2><ul><li><a href=/x>Storm warning issued</a></li></ul></aside>
<p>&ldquo;We have not seen this in years&rdquo;, said the mayor. <br>Schools stay shut until Wednesday.</p><div class="ad-slot">Advertisement: buy a boat today</div><h2>What happens next</h2><p>More rain is expected.</p></article></main>
<div class="newsletter"><p>Sign up for our newsletter.</p><form><input name=mail><button>Subscribe</button></form></div><footer><p>Contact us. Terms of use.</p></footer></body></html>""",
        """River rises after storm
The river rose by two metres overnight, officials said on Monday, and several roads were closed.
“We have not seen this in years”, said the mayor. Schools stay shut until Wednesday.
What happens next
More rain is expected.""",
    ),
    (
        """<html><body><div class="topbar"><form action=/find><input name=q><button>Search</button></form></div><div class="cookie-banner">This site uses cookies. <a href=#>Accept</a></div>
<div class="layout"><div class="toc"><ul><li><a href="#i">Install</a></li><li><a href="#u">Use</a></li></ul></div><section class="content"><h1>The sort tool</h1><p>This tool sorts lines of text. It reads a file and writes the lines in order.</p><h2>Install</h2><pre>make
make install</pre><h2>Use</h2><p>Give the name of a file as the first argument.</p><table><tr><th>Option</th><th>Meaning</th></tr><tr><td>-r</td><td>reverse the order</td></tr></table></section></div><div class="bottom">Built with care.</div></body></html>""",
        """The sort tool
This tool sorts lines of text. It reads a file and writes the lines in order.
Install
make make install
Use
Give the name of a file as the first argument.
Option
Meaning
-r
reverse the order""",
    ),
]


def test_hand_labelled_pages():
    """Pages written by hand in layouts of their own, with an unclosed quote, a formula, a script's odd text and a table."""
    w, pair = html_text.train()
    assert html_text.main_texts([h for h, _ in HAND_LABELLED], w, pair) == [t for _, t in HAND_LABELLED]
