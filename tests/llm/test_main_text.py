"""Main text of pages put together from parts, so that the text to find is known."""

import random
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest

from tiffinlens.llm import htmltext

PARTS = [f"Sentence number {i} of the article goes on for a while, as they do." for i in range(8)]
ARTICLE = "<h1>Head</h1>" + "".join(f"<p>{p}" for p in PARTS)
TEXT = "\n\n".join(["Head", *PARTS])
SAID = "I think message {} says a great deal about this, much more than one would want to read."
MESSAGES = "".join(f"<div class=msg><p>{SAID.format(i)}</div>" for i in range(12))
SIGNED = "".join(f"<div class=msg><div>Reader {i}</div><p>{SAID.format(i)}</div>" for i in range(12))


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<body><nav>n</nav><div id='social-history'>{ARTICLE}</div></body>", TEXT),
        (f"<body><article><p class='share-price'>Up</p>{ARTICLE}</article></body>", "Up\n\n" + TEXT),
        (f"{ARTICLE}<div class=x>tiny box</div>", TEXT + "\n\ntiny box"),
        (f"{ARTICLE}<div class=ad>tiny box</div>", TEXT),
        (f"<body><article>{ARTICLE}</article><section class='discussion'>{MESSAGES}</section></body>", TEXT),
        (f"<body><article>{ARTICLE}<section class='talk'>{SIGNED}</section></article></body>", TEXT),
        (f"<body><div class=post>{ARTICLE}</div><div class='reader-comments'>{MESSAGES}</div></body>", TEXT),
        (f"<body><article><header><h1>Top</h1><p>by X</header>{ARTICLE}</article></body>", "Top\n\n" + TEXT),
        (f"<body><div class=page><div class='article-header'><h2>Top</h2>by X</div>{ARTICLE}</div></body>", "Top\n\n" + TEXT),
        (f"<body><header><h1>Site</h1></header><article>{ARTICLE}</article></body>", TEXT),
        (f"<body><form id=f><div class=post>{ARTICLE}</div></form></body>", TEXT),
        (f"<body><div class=post>{ARTICLE}</div><form>name it all</form></body>", TEXT),
        (f"<body><div class=widget>{ARTICLE}</div></body>", TEXT),
        ("<body><div class='cookie-notice'>We use them.</div></body>", ""),
        ("<body><div class=comments>" + MESSAGES + "</div></body>", ""),
        ("", ""),
    ],
)
def test_names_are_weighed(html, text):
    assert htmltext.main_text(html, None) == text


def test_parts_of_an_article_are_no_discussion():
    part = "<section class=part><h2>Part</h2>" + "".join(f"<p>{p}" for p in PARTS) + "</section>"
    got = htmltext.main_text(f"<body><article><h1>Head</h1>{part * 4}</article></body>", None)
    assert got == "\n\n".join(["Head", *["\n\n".join(["Part", *PARTS])] * 4])
    part = "<div class=part>" + "".join(f"<p>{p}" for p in PARTS) + "</div>"
    got = htmltext.main_text(f"<body><div class=post><h1>Head</h1><p>Lead</p>{part * 4}</div></body>", None)
    assert got == "\n\n".join(["Head", "Lead", *PARTS * 4])


def test_pages_without_a_body_are_extracted_on_their_own(spark):
    rows = [(i, "http://h/", f"{ARTICLE}<div class=x>box</div>") for i in range(3)]
    rows += [(3, "http://h/", f"<body><nav>n</nav><article>{ARTICLE}</article><div class=x>box</div></body>"), (4, "http://h/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in htmltext.extracted(pages).collect()}
    assert got == {0: TEXT + "\n\nbox", 1: TEXT + "\n\nbox", 2: TEXT + "\n\nbox", 3: TEXT, 4: ""}


def words(rng, least, most):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(least, most)))


def built(rng):
    """A page and its text: parts of a frame in any order around an article of one of several shapes."""
    paragraphs = [words(rng, 15, 60) for _ in range(rng.randint(3, 12))]
    head = words(rng, 2, 6)
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    cut = rng.randint(1, len(paragraphs) - 1)
    halves = ["".join(f"<p>{p}</p>" for p in some) for some in (paragraphs[:cut], paragraphs[cut:])]
    article = rng.choice([
        f"<article><h1>{head}</h1>{body}</article>",
        f"<article><header><h1>{head}</h1><span>by me</span></header>{body}</article>",
        f"<main><div class=story><h1>{head}</h1><div class=a>{halves[0]}</div><div class=b>{halves[1]}</div></div></main>",
        f"<div class=post><h1>{head}</h1>{halves[0]}<aside>{words(rng, 5, 30)}</aside>{halves[1]}</div>",
        f"<div id=search-history><h1>{head}</h1>{body}</div>",
    ])
    talk = "".join(f"<div class=m{i}><p>{words(rng, 1, 2)}</p><p>{words(rng, 10, 40)}.</p></div>" for i in range(rng.randint(4, 15)))
    before = ["<nav><a href=x>one</a></nav>", "<header><h2>site</h2></header>", f"<div class='ad top'>{words(rng, 3, 12)}</div>"]
    after = [
        f"<div class=comments>{talk}</div>",
        f"<section class=thread>{talk}</section>",
        f"<footer>{words(rng, 3, 20)}</footer>",
        f"<form>{words(rng, 3, 12)}<button>go</button></form>",
        f"<div id=sidebar>{words(rng, 3, 20)}</div>",
    ]
    frame = [rng.sample(some, rng.randint(0, len(some))) for some in (before, after)]
    html = f"<html><head><title>t</title></head><body>{''.join(frame[0])}{article}{''.join(frame[1])}</body></html>"
    return html, "\n\n".join([head, *paragraphs])


@pytest.mark.parametrize("seed", range(60))
def test_built_pages(seed):
    html, text = built(random.Random(seed))
    assert htmltext.main_text(html, None) == text


class Plain(HTMLParser):
    """The blocks inside the article element, read by another parser."""

    ENDS = frozenset("p h1 h2 h3 article".split())

    def __init__(self):
        super().__init__()
        self.inside, self.parts, self.blocks = 0, [], []

    def end(self):
        text = " ".join("".join(self.parts).split())
        self.blocks += [text] if text else []
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in self.ENDS:
            self.end()
        if tag == "br":
            self.parts.append(" ")
        self.inside += tag == "article"

    def handle_endtag(self, tag):
        if tag in self.ENDS:
            self.end()
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside:
            self.parts.append(data)


def test_given_pages_against_another_parser():
    for html in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist():
        plain = Plain()
        plain.feed(html)
        assert htmltext.main_text(html, None) == "\n\n".join(plain.blocks)
