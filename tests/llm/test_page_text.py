"""Main text of generated pages whose truth is known, odd markup, and the parts of the method on their own."""

import html
import random
import re

import numpy as np
import pytest

from cohortline.llm import page_text as pt

SCHEMA = "page_id long, url string, html string, text string, n_chars long, content_path string, __html string"


def sentence(rng, n=None):
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n or rng.randint(5, 30))]
    return " ".join(w + rng.choice(["", "", "", ",", " &", " <b", " é"]) for w in words).capitalize() + rng.choice(".!?")


def code(rng, n=None):
    return html.escape(sentence(rng, n), quote=False)


def article(rng):
    blocks = [("h1", sentence(rng, 6))]
    for _ in range(rng.randint(2, 12)):
        blocks.append((rng.choice(["p", "p", "p", "p", "h2", "li", "blockquote", "pre"]), sentence(rng)))
    body = ""
    for tag, text in blocks:
        words = html.escape(text, quote=False).split(" ")
        k = rng.randrange(len(words))
        words[k] = rng.choice(["<b>%s</b>", "<a href='/x?a=1&b=2'>%s</a>", "<em class=x>%s</em>", "%s", "%s<!-- ad > -->", "%s\n\t "]) % words[k]
        line = " ".join(words)
        closed = "" if tag == "p" and rng.random() < 0.3 else f"</{tag}>"
        body += f"<ul><li>{line}</ul>" if tag == "li" else f"<{tag}>{line}{closed}\n"
    return body, " ".join(" ".join(t.split()) for _, t in blocks)


def page(rng, kind):
    body, truth = article(rng)
    links = "".join(f"<li><a href='/{k}'>{code(rng, 2)}</a></li>" for k in range(rng.randint(3, 9)))
    noise = [f"<nav><ul>{links}</ul></nav>", f"<div class=\"main-menu\"><ul>{links}</ul></div>", f"<header><h1>{code(rng, 3)}</h1></header>",
             f"<script>var x = '<p>{code(rng)}</p>';</script>", f"<div class='ad-box'><p>{code(rng)}</p></div>",
             f"<aside>{code(rng)}</aside>", f"<div id=cookie-consent><p>{code(rng)}</p><button>OK</button></div>",
             f"<form action=/s><label>{code(rng, 3)}</label><input name=q><textarea>{code(rng)}</textarea></form>",
             "<style>p > a {margin: 0}</style>", f"<div style='display: none'>{code(rng)}</div>", "<!-- <p>gone</p> -->"]
    after = [f"<footer><p>&copy; {code(rng)}</p></footer>", f"<div class='sidebar'><p>{code(rng)}</p></div>",
             "<section id='comments'>" + "".join(f"<div class='comment'><p>{code(rng)} {code(rng)}</p></div>" for _ in range(rng.randint(1, 9)))
             + "</section>", f"<div class='related-posts'><ul>{links}</ul></div>"]
    rng.shuffle(noise)
    rng.shuffle(after)
    inner = {"article": f"<article>{body}</article>", "main": f"<main class=content>{body}</main>",
             "divs": f"<div id=wrap class='with sidebar'><div class=post><div class=entry>{body}</div></div></div>"}[kind]
    start = f"<!DOCTYPE html><html><head><title>{code(rng, 4)}</title></head><body class='has-comments'>"
    end = rng.choice(["</body></html>", "", "</body"])
    return start + "".join(noise[:rng.randint(0, 8)]) + inner + "".join(after[:rng.randint(0, 4)]) + end, truth


@pytest.mark.parametrize("kind", ["article", "main", "divs"])
def test_generated_pages(kind):
    rng = random.Random(kind)
    for _ in range(150):
        source, truth = page(rng, kind)
        assert pt.extract(source)[0] == truth, source


CASES = [
    ("", ""), ("plain  text\n here", "plain text here"), ("a &amp; b &lt;i&gt; &am &#233;&nbsp;x 1 < 2 <3", "a & b <i> &am é x 1 < 2 <3"),
    ("<p>one<p>two", "one two"), ("<p>a<br>b<b>c</b>d<p>e", "a bcd e"), ("<p>x</p><!-- cut", "x"), ("<p>x</p><di", "x"),
    ("<p title='a > b' class=c>in</p>", "in"), ("<p title=it's>in</p><p>on</p>", "in on"), ("<p a=\"open>in</p><p>on</p>", "in on"),
    ("<script>if (a < b) '</p>'</script ><p>x</p><STYLE>y</STYLE>", "x"), ("<script>never ends <p>x</p>", ""), ("</p></div>x</b>", "x"),
    ("<b><p>one</b> two</p>three", "one two three"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("<nav>menu</nav>", ""), ("<article><p><b>A.<br><p>B.</p></article><footer>f</footer>", "A. B."),
    ("<div class=ad>" + "long advert, " * 50 + "</div><article><p>Hi.</p></article>", "Hi."),
    ("<article>x<span class=ad>buy</span>y <span hidden>z</span></article>", "x y"), ("\x00<p>😀</p>".encode("utf-16", "surrogatepass").decode("utf-16"), "\x00 \U0001f600"),
]


@pytest.mark.parametrize("source,text", CASES)
def test_odd_markup(source, text):
    assert pt.extract(source)[0] == text


def test_long_and_deep_pages_take_time_in_proportion():
    import time
    for unit in ("<div>x", "<b>y", "<p>word, ", "</span>", "<!--", "<a href=\"", "&amp;", "<", "<ul><li><a href=x>z</a>", "<script>"):
        times = []
        for n in (30_000, 120_000):
            began = time.thread_time()
            pt.extract(unit * n)
            times.append(time.thread_time() - began)
        assert times[1] < 12 * times[0] + 1, unit


def test_pages_of_a_table(spark):
    rng = random.Random(1)
    rows = [(k, f"http://h/{k}", *page(rng, "article")) for k in range(30)]
    rows += [(100, None, None, ""), (None, "u", "", ""), (101, "v", "<article>" + "<p>Long, text.</p>" * 400_000, " ".join(["Long, text."] * 400_000))]
    rows += rows[:3]
    df = spark.createDataFrame([(i, u, h, "t", 9, "c", "h") for i, u, h, _ in rows], SCHEMA)
    got = pt.extract_pages(df)
    assert got.columns == ["page_id", "url", "text", "n_chars", "content_path"]
    assert sorted(map(str, ((r[0], r[1], r[2], r[3]) for r in got.collect()))) == sorted(str((i, u, t, len(t))) for i, u, _, t in rows)
    assert pt.extract_pages(df.limit(0)).collect() == []


def test_threshold_and_smoothing():
    x = np.array([1.0, 1.1, 1.2, 8.0, 9.0])
    assert 1.2 < pt.threshold(x, np.ones(5)) <= 8
    assert pt.threshold(np.ones(3), np.ones(3)) == -np.inf
    assert np.allclose(pt.smoothed(np.full(9, 2.0)), 2.0)
    spread = pt.smoothed(np.array([0.0, 0, 0, 9, 0, 0, 0]))
    assert spread.argmax() == 3 and spread[2] > spread[1] > 0 and re.match("^", "")
