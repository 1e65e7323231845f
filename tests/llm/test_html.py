"""Wrappers inferred from pages, and the texts they give."""

import html
import json
import random
import re

import pytest

from lawgrain.llm import queries, wrappers as W


def article(page):
    """Main text of the driver's pages, which all have one `article` of h1 and p."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner)
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_every_page_of_the_table(spark, data):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in queries.op11_html_extraction(spark, data).collect()}
    assert got.keys() == pages.keys()
    for i, page in pages.items():
        assert got[i]["text"] == article(page["html"])
        assert got[i]["n_chars"] == len(got[i]["text"]) and got[i]["url"] == page["url"]


def expression(page):
    return json.loads(W.expression(page)[0])


def test_repeats_and_options_become_one_expression():
    one = "<ul><li>a<li>b</ul><p>x</p>"
    two = "<ul><li>a<li><b>c</b><p>d</p></ul><h2>t</h2><p>y<p>z"
    whole = json.loads(W.merged([W.expression(p)[0] for p in (one, two)]))
    slot = ["#", False, False, []]
    item = ["li", True, False, [slot, ["p", False, True, [slot]]]]
    assert whole == [["ul", False, False, [item]], ["h2", False, True, [slot]], ["p", True, False, [slot]]]


def test_groups_of_two_and_three_tags():
    page = "<h2>a</h2><p>b</p><h2>c</h2><p>d</p>"
    (group,) = expression(page)
    assert group[0] == "(h2 , p)" and group[1]
    both = json.loads(W.merged([W.expression(page)[0], W.expression("<h2>a</h2><p>b</p>")[0]]))
    assert both == [group]


def random_page(rng, depth=0):
    tags = ["div class=a", "div class=b", "p", "ul", "h2", "section"]
    out = []
    for _ in range(rng.randint(0, 5 - depth)):
        tag = rng.choice(tags)
        name, _, rest = tag.partition(" ")
        inner = f"w{rng.randint(0, 9)}" if name in ("p", "h2") or depth > 2 else random_page(rng, depth + 1)
        out.append(f"<{tag}>{inner}</{name}>" * rng.choice((1, 1, 2, 3)))
    return "".join(out)


@pytest.mark.parametrize("seed", range(40))
def test_a_wrapper_has_every_page_it_was_made_of(seed):
    rng = random.Random(seed)
    shapes = [W.expression(random_page(rng))[0] for _ in range(12)]
    halves = [W.merged(shapes[:6]), W.merged(shapes[6:])]
    whole = json.loads(W.merged(halves))
    paths = {tuple(i for i, _ in p) for p in W.slots_of(whole)}
    for shape in shapes:
        places = list(W.matched(json.loads(shape), whole))
        assert len(places) == len(list(W.slots_of(json.loads(shape))))
        assert set(places) <= paths


HOST = [
    (1, "<body><div class=menu><a href=x>Home</a></div><div id=c1><h1>One</h1><p>First text is here.</p><p>More</p>"
        "<div class='user comments'><p>Nice article I think, and long enough.</p></div></div><div class=z>Copyright us</div>"),
    (2, "<body><div class=menu><a href=x>Home</a></div><div id=c2><h1>Two</h1><p>Second text &amp; a <b>bold</b>er one<br>x."
        "</div><div class=z>Copyright us</div>"),
    (3, "<body><div class=menu><a href=x>Home</a></div><div id=c3><h1>Three</h1><p>Third, with a list</p><ul><li>q<li>r</ul>"
        "<form>Your mail</form><script>var t='</p>'</script></div><div class=z>Copyright us</div>"),
]


def test_pages_without_an_article_tag(spark, rows):
    pages = spark.createDataFrame([(i, "http://h.example/x", h) for i, h in HOST], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in W.extract(pages).collect()}
    assert got == {
        1: "One\nFirst text is here.\nMore",
        2: "Two\nSecond text & a bolder one x.",
        3: "Three\nThird, with a list\nq\nr",
    }


def test_odd_pages(spark):
    deep = "<div>" * 500 + "<article>deep" + "</div>" * 500
    long = "<article>" + "<p>word &lt;b&gt; word" * 30_000 + "</article>"
    pages = [
        ("a", None, None, 1),
        ("b", "no host", "", 1),
        (None, "http://u:p@H.example:80/1", "<article><header>Head</header><p>kept <i>in</i>line</p><nav>menu</nav></article>", 1),
        ("d", "http://h.example/2", "<article>text<!-- no --> on <a href='", 1),
        ("d", "http://h.example/2", "<article>text<!-- no --> on <a href='", 1),
        ("e", "http://h.example/3", deep, 1),
        ("f", "http://h.example/3", long, 1),
        ("g", "http://h.example/4", "1 < 2 <article>a &am b &copy; &#65;&nbsp;c\n\n d<article class=comment>me too</article></article>", 1),
    ]
    frame = spark.createDataFrame(pages, "page_id string, url string, html string, host int")
    got = [(r["page_id"], r["text"]) for r in W.extract(frame).collect()]
    assert len(got) == 8
    texts = {}
    for i, text in got:
        texts.setdefault(i, []).append(text)
    assert texts["a"] == [""] and texts["b"] == [""]
    assert texts[None] == ["Head\nkept inline"]
    assert texts["d"] == ["text on"] * 2
    assert texts["f"][0] == "\n".join(["word <b> word"] * 30_000)
    assert texts["g"] == ["a &am b © A c d"]
    assert W.extract(frame.where("false")).count() == 0


def test_a_large_host_is_aligned_in_a_tree(spark):
    """More distinct expressions than one task aligns."""
    rng = random.Random(5)
    pages = []
    for i in range(400):
        aside = "".join(f"<{t}>x</{t}>" for t in rng.sample(["div", "section", "ul", "h3", "h4", "table", "figure"], 5))
        pages.append((i, "http://h.example/", f"<body>{aside}<article><p>Text {i}</article><footer>f</footer>"))
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    assert len({W.expression(h)[0] for _, _, h in pages}) > 2 * W.FAN
    got = {r["page_id"]: r["text"] for r in W.extract(frame).collect()}
    assert got == {i: f"Text {i}" for i in range(400)}
