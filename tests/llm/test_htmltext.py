"""Main text of pages: against the articles of the given pages, and page by page."""

from __future__ import annotations

import html
import math
import random
import re
import time

import pytest

from sparkprep.llm import htmltext
from sparkprep.llm.htmltext import extract, extract_text

SF = "/root/testdata/sf0.01"


def article(page):
    """The text between the article tags, block by block."""
    body = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    blocks = re.split(r"</?(?:p|h1)>", body)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return " ".join(t for t in texts if t)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in extract_text(pages).collect()}
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    assert got == want


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        (" \n", ""),
        ("plain words only", "plain words only"),
        ("<p>a &lt;b&gt; &#233;&nbsp;c<p>d", "a <b> é c d"),
        ("<p>un<b>bro</b>ken<br>line</p>", "unbroken line"),
        ("<script>if (a < b) '</p>';</script><p>Text stays, all of it.</p><style>x{}</style>", "Text stays, all of it."),
        ("<!-- <p>no</p> --><p>Yes, this.</p><!-- open", "Yes, this."),
        ("<p title='a > b'>Quoted marks, here.</p>", "Quoted marks, here."),
        ("<article><p>Open to the end, and on", "Open to the end, and on"),
        ("<p>1 < 2 and more, so.</p>", "1 < 2 and more, so."),
    ],
)
def test_small_pages(page, text):
    assert extract(page) == text


LONG = "This is a sentence of the article, with commas, and some more words. " * 5


def test_surroundings_go_and_lists_stay():
    page = f"""<html><head><title>T</title></head><body><header><h1>Site</h1></header>
    <nav><a href=/>Home</a></nav><div id="cookie-notice">We use cookies. Accept?</div>
    <article><header><h1>Title of it</h1></header><p>{LONG}</p><ul><li>One</li><li>Two</li></ul>
    <form><label>Name</label><input></form><div class="ad">Buy now, really.</div><p>End.</p>
    <section class="comments"><p>First! Great post, thanks.</p></section></article>
    <aside><p>{LONG}</p></aside><footer>&copy; us</footer></body></html>"""
    assert extract(page) == f"Title of it {LONG.strip()} One Two End."


def test_unmarked_page_by_ratios():
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(20))
    page = f"""<body><div class="top"><ul>{links}</ul></div><div class="x"><h2>Heading here</h2>
    <p>{LONG}</p><p>{LONG}</p><p>Short one.</p></div><div class="low"><span>imprint</span></div></body>"""
    assert extract(page) == f"Heading here {LONG.strip()} {LONG.strip()} Short one."


def test_long_page_is_whole():
    page = "<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"
    assert extract(page) == " ".join([LONG.strip()] * 5000)


def test_odd_tables(spark):
    rows = [(None, None, 1), (1, "<p>a, b.", 2), (1, "<p>a, b.", 2), (2, "", 3)]
    df = spark.createDataFrame(rows, "page_id bigint, html string, text int")
    out = extract_text(df)
    assert out.columns == ["page_id", "text"]
    got = sorted(((r["page_id"], r["text"]) for r in out.collect()), key=repr)
    assert got == sorted([(None, ""), (1, "a, b."), (1, "a, b."), (2, "")], key=repr)
    assert extract_text(df.limit(0)).count() == 0


ARTICLE = f"<h1>Title of it</h1><p>{LONG}</p><p>{LONG}</p>"
TEXT = f"Title of it {LONG.strip()} {LONG.strip()}"


@pytest.mark.parametrize(
    "before, after",
    [
        ('<form id="aspnetForm">', "</form>"),
        ('<article class="post comments-open">', "</article>"),
        ('<div class="page sidebar-right"><article>', "</article></div>"),
        ('<div id="legal-text">', "</div>"),
        ('<form id="f"><div class="popup"><main>', "</main></div></form>"),
        ("<div>", "</div>"),
    ],
)
def test_wrapped_pages(before, after):
    """A wrapper that looks like none of the content does not take it along; what is around goes."""
    menu = "<nav><ul><li><a href=/>Home</a><li><a href=/b>Other</a></ul></nav>"
    assert extract(f"<body>{before}{menu}{ARTICLE}{after}<footer>About us, and so on.</footer></body>") == TEXT


def test_thresholds_inside_the_content():
    """An unnamed short block of a generic element goes, long ones and lists stay."""
    page = f"<article><h1>Title of it</h1><p>{LONG}</p><div class=x7f>Subscribe now</div><p>{LONG}</p></article>"
    assert extract(page) == TEXT
    items = "".join(f"<li>item {i}</li>" for i in range(30))
    assert extract(f"<article><p>{LONG}</p><ul>{items}</ul></article>").endswith("item 29")
    assert extract(f"<article><div>{LONG}</div><div>So.</div></article>") == f"{LONG.strip()} So."


def test_teasers_and_menus_go():
    teaser = f"<aside><article><h2>More</h2><p>{LONG}</p></article></aside>"
    assert extract(f"<body><article>{ARTICLE}{ARTICLE}</article>{teaser}</body>") == f"{TEXT} {TEXT}"
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(20))
    assert extract(f"<body><ul>{links}</ul>{ARTICLE}</body>") == TEXT


@pytest.mark.parametrize(
    "piece",
    ["<a ", "<a '", '<a "\'', "<!", "<!--", "<?", "</", "<div>x", "<b>x", "<b>x</i>", "</section>x", "<div>x</section>",
     "<i><p><b>x</i>", "<h1></h1><b>", "<script>", "<div class='a", "<li>x", "<p>x<table>", "<form>x", "&#", "<a b='>"],
)
def test_broken_pages_take_linear_time(piece):
    start = time.process_time()
    for tail in ("", ">", "'>", "\">", "<p>End."):
        text = extract(piece * 20_000 + tail)
    assert time.process_time() - start < 20
    assert isinstance(text, str)


def test_deep_page_is_whole():
    deep = 3000
    page = "<div>" * deep + f"<p>{LONG}</p>" + "</div>" * deep + "<nav>Home</nav>"
    assert extract(page) == LONG.strip()


def brute_scores(blocks):
    """Scores from path strings by their definition, for pages without marks, suspects and links."""
    paths = [b[0] for b in blocks]
    total = sum(len(t) for _, t in blocks)

    def below(prefix):
        return sum(len(t) for p, t in blocks if p.startswith(prefix + "/"))

    every = {p[: i] for p in paths for i in range(len(p) + 1) if i == len(p) or p[i] == "/"} | {""}
    held = max((p for p in every if below(p) > total / 2), key=lambda p: p.count("/") if p else -1)
    within = [p == held or p.startswith(held + "/") for p in paths]

    def ratio(of):
        by_path = {p: [of(t) for q, t in blocks if q == p] for p in paths}
        means = [sum(by_path[p]) / len(by_path[p]) for p in paths]
        out = []
        for i, m in enumerate(means):
            near = [means[j] if 0 <= j < len(means) and within[j] == within[i] else m for j in (i - 1, i + 1)]
            plain = paths[i].split("/")[-1].split(".")[0] in htmltext.GENERIC
            out.append(m if plain else (near[0] + 2 * m + near[1]) / 4)
        return out

    length, marks = ratio(len), ratio(lambda t: sum(t.count(c) for c in ".,;:!?"))
    scores = {}
    for p in paths:
        weight = 0.25 if p.split("/")[-1].split(".")[0] in htmltext.GENERIC else 1.0
        at = [i for i, q in enumerate(paths) if q == p]
        one = [math.log1p(length[i]) * (1 + math.log1p(marks[i])) * weight * (1 if within[i] else 0.01) for i in at]
        scores[p] = sum(one) / len(one)
    return scores


def test_scores_by_brute_force():
    rng = random.Random(7)
    for _ in range(150):
        blocks, parts = [], []

        def grow(path, depth):
            for _ in range(rng.randint(1, 4)):
                tag = rng.choice(["div", "section", "p", "h2", "pre"] if depth < 4 else ["p", "h2"])
                name = rng.choice(["", "one", "two"])
                step = f"{path}/{tag}.{name}" if name else f"{path}/{tag}"
                parts.append(f"<{tag} class={name}>" if name else f"<{tag}>")
                if tag in ("div", "section") and rng.random() < 0.8:
                    grow(step, depth + 1)
                else:
                    words = [rng.choice(["word", "some,", "text.", "longer-words", "x"]) for _ in range(rng.randint(1, 30))]
                    parts.append(" ".join(words))
                    blocks.append((step, " ".join(words)))
                parts.append(f"</{tag}>")

        grow("", 0)
        want = brute_scores(blocks)
        best = max(want.values())
        kept = [t for p, t in blocks if want[p] >= 0.05 * best]
        if any(abs(v - 0.05 * best) < 1e-9 for v in want.values()):
            continue
        assert extract("".join(parts)) == " ".join(kept)
