import hashlib
import random
from collections import Counter

import pytest

from affinis.llm import html_blocks, warc
from affinis.session import scratch_dir

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head>
<body class="home article"><header id="top"><h1>Site</h1><form action="x"><input><button>Go now</button></form></header>
<nav><ul><li><a href="/a">Alpha</a></li><li><a href='/b>c'>Beta</a></li></ul></nav>
<div class="cookie-notice">We use cookies to improve all of your visits to this fine site every day.</div>
<aside>Side remarks of considerable length that are not what a reader came for at all.</aside>
<main><article><header><h1>Head &amp; line</h1></header><p>First <b>bo</b>ld   para&shy;graph&nbsp;here.<p>Short.
<!-- <p>gone</p> --><div class="ad">Buy these things now, they are cheap and very good.</div>
<ul><li>item <a href="#">one</a></li><li>two</li></ul><blockquote>A &lt;quote&gt; &#x41;&#66;</blockquote>
<section class="comments"><h3>Comments</h3><p>I liked this article a lot, thanks for writing all of it down here.</p></section>
</article></main><footer><p>&copy; 2020 A company with a long name and an address in some city.</p></footer></body></html>"""
TEXT = "Head & line First bold para­graph here. Short. item one two A <quote> AB"


@pytest.fixture(scope="module")
def tree():
    return html_blocks.train()


def test_page(tree):
    assert html_blocks.main_text(PAGE, tree) == TEXT


def test_pages_without_article_elements(tree):
    body = " ".join(["Some words of real prose that goes on for quite a while."] * 4)
    page = f"<div><a href=1>Home</a></div><div><a href=2>News</a></div><div><p>{body}</p><p>{body}</p></div><div class=footer>end of page</div>"
    assert html_blocks.main_text(page, tree) == f"{body} {body}"


def test_tree_fits_its_table_and_generalises(tree):
    right = total = 0
    for k, held in enumerate(html_blocks.LABELLED):
        other = html_blocks.train([p for j, p in enumerate(html_blocks.LABELLED) if j != k])
        found = html_blocks.predict(other, html_blocks.features([("", *b[:3]) for b in held]))
        right += sum(bool(f) == bool(b[3]) for f, b in zip(found, held))
        total += len(held)
    assert right / total > 0.85


def test_marked_parts_decide_on_article_pages(tree):
    draw = random.Random(5)
    for _ in range(400):
        page = []
        for _ in range(draw.randint(1, 9)):
            n = draw.choice([1, 2, 5, 12, 40, 200, 3000])
            page.append(("", draw.choice(["article", "other"]), n, draw.choice([0, 0, n // 2, n])))
        if any(b[1] == "article" for b in page):
            found = html_blocks.predict(tree, html_blocks.features(page))
            assert [bool(f) for f in found] == [b[1] == "article" for b in page]


def test_embedded_elements_take_nothing_after_them(tree):
    body = " ".join(["Some words of real prose that goes on for quite a while."] * 3)
    for part, left in (
        ('<svg class="i"/>', ""), ("<svg><title>No</title><style/><path/></svg>", ""), ("<svg><svg/>no<svg>no</svg>no</svg>", ""),
        ("<video-js id=x></video-js>", ""), ("<title-bar>Yes</title-bar>", "Yes "), ("<object-x/>", ""), ("<video src=a>", ""),
        ('<iframe src="a>b" />', ""), ("<iframe srcdoc='<p>no</p>'>no</iframe>", ""), ("<select><option>no</select>", ""),
        ("<object data=a>no<object data=b>no</object></object>", ""), ("<video src=a><video src=b>no</video>", ""),
        ("<!-- <svg> --><svg>no</svg><script>'</svg>'</script>", ""), ("<SVG><g>no</SVG >", ""), ("<noscript>no</noscript><canvas>", ""),
    ):
        page = f"<article><p>{body}</p>{part}<p>Second {body}</p></article><nav><svg></svg></nav>"
        assert html_blocks.main_text(page, tree) == f"{body} {left}Second {body}", part
    assert [b[0] for b in html_blocks.page_blocks('<p>One</p><svg class="i"/><p>Two words here</p>')] == ["One", "Two words here"]
    assert len(html_blocks.page_blocks("<p>word<video>" * 20000)) == 20000


def test_names_and_attributes_that_mark_no_part(tree):
    body = " ".join(["Some words of real prose that goes on for quite a while."] * 3)
    for attributes in (
        'class="overflow-hidden"', 'class="md:hidden"', 'title="the hidden truth"', "aria-hidden=false", 'data-x="display:none"', "hidden=until-found",
        'class="content has-sidebar"', 'class="post comments-open"', 'class="no-cookies"', 'id="content" class="sidebar"', 'data-id="menu"',
        'style="display: block; color: red"', 'class="with-header"', 'class="content-wrapper sidebar-left"',
    ):
        for tag in ("div", "section"):
            page = f"<{tag} {attributes}><p>{body}</p><p>{body}</p></{tag}><p>A few words after it</p>"
            assert html_blocks.main_text(page, tree).startswith(f"{body} {body}"), attributes
        assert html_blocks.main_text(f"<article {attributes}><p>{body}</p></article>", tree) == body, attributes
        assert html_blocks.main_text(f"<div {attributes}><article><p>{body}</p></article></div>", tree) == body, attributes


def test_names_and_attributes_that_mark_other_parts(tree):
    body = " ".join(["Some words of real prose that goes on for quite a while."] * 3)
    for attributes in (
        "hidden", 'hidden=""', 'HIDDEN class="content"', 'style="color:red; display : none"', 'class="sidebar"', "class=sidebar-left", 'id="comments"',
        'class="x1 related-posts"', 'class="main-navigation"', 'role="navigation" class="content"', 'class="site-footer"', 'class="ad-1"', 'class="widget widget_text"',
    ):
        page = f"<article><p>{body}</p><div {attributes}><p>Gone {body}</p></div></article>"
        assert html_blocks.main_text(page, tree) == body, attributes


def test_odd_pages(spark, tree):
    rows = [
        (1, None, None, "x"), (2, "u", "", "x"), (None, "u", "<p", "x"), (3, "u", "plain < text", "x"), (3, "u", "plain < text", "x"),
        (4, "u", "<article>" + "<p>word " * 50000, "x"), (5, "u", "<div>" * 3000 + "</article></p>", "x"), (6, "u", "<a href=\"" * 2000, "x"),
        (7, "u", "<script>never closed <article>no", "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_blocks.extract(pages, tree)
    out = found.collect()
    assert found.columns == ["page_id", "url", "text", "n_chars"] and len(out) == len(rows)
    by = {r.page_id: r for r in out}
    assert by[1].text == by[2].text == by[7].text == "" and by[4].text.count("word") == 50000
    assert all(r.n_chars == len(r.text) for r in out)
    assert html_blocks.extract(pages.limit(0), tree).collect() == []


def big(c):
    return c * 1200


ROWS = [
    (1, "http://a/1", big("x")), (2, None, big("x")), (3, "http://a/3\nX", big("é")), (4, "u", None), (5, "u", ""), (6, "u", "small"),
    (7, "u", "small"), (8, "u", big("x")), (8, "u", big("x")), (9, "u", "z" * 999), (10, "u", "z" * 999), (None, "u", big("é")), (11, "u", "r\r\n\r\n" * 400),
]


def test_records_round_trip(spark):
    pages = spark.createDataFrame([(*r, "d") for r in ROWS], "page_id long, url string, html string, digest string")
    winner = {}
    for i, _, t in ROWS:
        if t and len(t.encode()) >= 1000:
            winner[t] = max(winner.get(t, -1), -1 if i is None else i)
    expected = Counter()
    for i, _, t in ROWS:
        b = (t or "").encode()
        again = t in winner and (i is None or i < winner[t])
        expected[i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", winner[t] if again else None] += 1
    found = warc.warc_round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(map(tuple, found.collect())) == expected
    assert warc.warc_round_trip(pages.limit(0)).collect() == []


def test_one_record_by_its_identifier(spark):
    pages = spark.createDataFrame(ROWS[:8], "page_id long, url string, html string")
    folder = scratch_dir(spark, "warc")
    index = warc.write_bundles(pages, folder, frame_bytes=2000, bundle_bytes=100)
    assert index.select("bundle").distinct().count() > 1
    wanted = warc.record_id(8, hashlib.sha1(big("x").encode()).hexdigest())
    row = index.where(index.record_id == wanted).first()
    store, root = warc._store(folder)
    (data,) = warc.fetch(store, root, row.bundle, {row.frame: [(row.at, row.length)]})
    fields, block = warc.parse(data)
    assert fields["WARC-Record-ID"] == wanted and block.endswith(b"\r\n\r\n" + big("x").encode())


def test_a_bundle_is_plain_zstandard(spark):
    import zstandard

    pages = spark.createDataFrame(ROWS[:4], "page_id long, url string, html string").coalesce(1)
    folder = scratch_dir(spark, "warc")
    index = warc.write_bundles(pages, folder, frame_bytes=100)
    store, root = warc._store(folder)
    for name in {r.bundle for r in index.collect()}:
        with store.open_input_file(f"{root}/{name}") as f:
            text = zstandard.ZstdDecompressor().stream_reader(f.read(), read_across_frames=True).read()
        assert text.count(b"WARC/1.1\r\n") == index.where(index.bundle == name).count()


@pytest.mark.parametrize("main, rest", [([240], []), ([40, 50, 60], []), ([80, 60], ["Imprint"]), ([90, 60], ["All rights reserved"])])
def test_last_block_of_pages_without_an_article(main, rest):
    texts = [" ".join(f"w{k}" for k in range(n)) for n in main]
    page = "<html><body>" + "".join(f"<p>{t}</p>" for t in texts + rest) + "</body></html>"
    assert html_blocks.main_text(page, html_blocks.train()) == " ".join(texts)


def test_a_long_block_with_some_links_stays():
    linked, text = " ".join(["link"] * 20), " ".join(["word"] * 140)
    page = f"<body><p>{text}</p><p>{text} <a href=x>{linked}</a></p><p>{text}</p><p>End here now</p></body>"
    assert html_blocks.main_text(page, html_blocks.train()).split().count("link") == 20
