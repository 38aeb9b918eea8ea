"""Main text against pages built from known parts."""

import html
import random

import pytest

from llm_data import shipped  # noqa: F401
from tickward.llm.template import extract, host_of, main_text

WORDS = "river stone lamp cloud paper seven green window road bird".split()


def page(rng, host, paragraphs, cut=0):
    body = "".join(f"<p>{html.escape(p)}</p>" for p in paragraphs)
    nav = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in rng.sample(WORDS, rng.randint(2, 6)))
    text = (
        f"<!DOCTYPE html><html><head><title>{host}</title><script>var t='</p>';</script><style>p{{}}</style></head><body><nav><ul>{nav}</ul></nav>"
        f'<div class="cookie-notice">We use cookies</div><div class="body"><div class="story"><h2>{rng.choice(WORDS)} head</h2>{body}</div>'
        f'<div id="comments"><p>{rng.choice(WORDS)} nice one</p></div></div><aside>{rng.choice(WORDS)}</aside><footer>&copy; {host}</footer></body></html>'
    )
    return text[: len(text) - cut]


def rows(spark, pages):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in pages], "page_id long, url string, html string, token string, host string")


def test_article_alone_is_kept(spark):
    rng = random.Random(1)
    pages, want = [], {}
    for i in range(40):
        paragraphs = [" ".join(rng.choices(WORDS, k=rng.randint(5, 30))) + " & more" for _ in range(rng.randint(1, 5))]
        paragraphs.append("A sentence that half of all articles share.") if i % 2 else None
        pages.append((i, f"https://www.{'a' if i < 30 else 'b'}.example.org/{i}", page(rng, "h", paragraphs)))
        want[i] = paragraphs
    got = {r["page_id"]: r["text"] for r in extract(rows(spark, pages)).collect()}
    for i, paragraphs in want.items():
        blocks = got[i].split("\n\n")
        assert blocks[1:] == paragraphs and blocks[0].endswith(" head")


def test_fixed_text_inside_the_article_goes(spark):
    rng = random.Random(2)
    pages = [(i, "http://x.example.com/", page(rng, "x", [" ".join(rng.choices(WORDS, k=40)), "Read more in our archive."])) for i in range(30)]
    got = [r["text"] for r in extract(rows(spark, pages)).collect()]
    assert all("archive" not in text and len(text.split()) >= 40 for text in got)
    few = [r["text"] for r in extract(rows(spark, pages[:10])).collect()]
    assert all("archive" in text for text in few)


def test_headings_stay_where_every_page_has_one_paragraph(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(WORDS, k=60)) for _ in range(12)]
    pages = [(i, "http://one.example.com/", f"<html><body><nav><a>m</a></nav><article><h1>Head {i}</h1><div><p>{t}</p></div></article></body></html>") for i, t in enumerate(texts)]
    got = {r["page_id"]: r["text"] for r in extract(rows(spark, pages)).collect()}
    assert got == {i: f"Head {i}\n\n{t}" for i, t in enumerate(texts)}


def test_copies_keep_their_text(spark):
    pages = [(i, "http://c.example.com/", "<html><body><nav>menu</nav><article><h1>Title</h1><p>The same text.</p></article></body></html>") for i in range(50)]
    assert {r["text"] for r in extract(rows(spark, pages)).collect()} == {"Title\n\nThe same text."}


def test_odd_pages(spark):
    long = "<p>" + "word " * 50_000 + "</p>"
    pages = [
        (1, None, None),
        (2, "", ""),
        (3, "no url", "plain &amp; text\n only"),
        (3, "no url", "plain &amp; text\n only"),
        (None, "http://a/", "<article><p>cut off in a ta"),
        (5, "http://a/", "<article><p>one<br>two <b>three<p>four</p></article><footer>f"),
        (6, "http://a/", long),
        (7, "http://a/", "<div" * 3000),
        (8, "http://a/", "<article><p>5 < 6 &lt;b&gt; <!-- <p>no</p> --> yes</p><textarea>t</textarea></article><"),
    ]
    got = sorted(((r["page_id"], r["text"]) for r in extract(rows(spark, pages)).collect()), key=lambda r: (r[0] or 0, r[1]))
    assert got[0] == (None, "cut off in a ta") and got[1] == (1, "") and got[2] == (2, "")
    assert got[3] == got[4] == (3, "plain & text only")
    assert got[5] == (5, "one two three\n\nfour")
    assert len(got[6][1].split()) == 50_000
    assert got[8] == (8, "5 < 6 <b> yes")
    assert extract(rows(spark, []).where("false")).collect() == []


def test_hosts(spark):
    urls = ["https://User@Www.A.org:80/x", "ftp://b.c", "nothing", None]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select(host_of("u")).collect()
    assert [r[0] for r in got] == ["www.a.org", "b.c", "", ""]


def test_deep_nesting_does_not_matter():
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


@pytest.mark.parametrize("depth", [10, 199, 200, 450])
def test_what_is_set_aside_is_so_at_any_depth(depth):
    page = "<html><body>" + "<div>" * depth + "<p>Kept.</p><nav><a>Menu</a></nav><div class='advert'><p>Buy</p></div><p>Kept too.</p>" + "</div>" * depth + "<footer>Foot</footer><p>Last.</p></body></html>"
    assert main_text(page) == "Kept.\n\nKept too.\n\nLast."
