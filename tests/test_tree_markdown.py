"""Random documents, written as HTML by one set of rules and as Markdown by another."""

import random
import re

import pytest

from folio.functions.tree_markdown import page_markdown
from folio.plans.markdown_cases import PARTS


@pytest.mark.parametrize(("html", "made"), PARTS)
def test_parts(html, made):
    html, made = (t.replace("@N", "5").replace("@U", "http://u/a_b") for t in (html, made))
    assert page_markdown(html) == made + "\n"


def words(rnd):
    out_h, out_m = [], []
    for _ in range(rnd.randint(1, 4)):
        w = rnd.choice(["alpha", "be_ta", "_u", "g*", "7", "x<y", "a&b", "[z]", "naïve", "`q`"])
        h = w.replace("&", "&amp;").replace("<", "&lt;")
        m = re.sub(r"([*`\[\]<]|^_)", r"\\\1", w)
        kind = rnd.choice(["", "", "strong", "em", "a", "code"])
        plain = w if "`" not in w else w.replace("`", "")
        out_h.append({"": h, "strong": f"<b>{h}</b>", "em": f"<em> {h} </em>", "a": f"<a href=u/1>{h}</a>", "code": f"<code>{plain.replace('&', '&amp;').replace('<', '&lt;')}</code>"}[kind])
        out_m.append({"": m, "strong": f"**{m}**", "em": f"*{m}*", "a": f"[{m}](u/1)", "code": f"`{plain}`"}[kind])
    return "word " + rnd.choice([" ", "\n "]).join(out_h), "word " + " ".join(out_m)


def block(rnd, depth):
    """(HTML, lines of Markdown) of one block."""
    kind = rnd.choice(["p", "h", "ul", "ol", "quote", "pre", "hr"] if depth < 4 else ["p", "h"])
    if kind == "p":
        h, m = words(rnd)
        return f"<p>{h}</p>", [m]
    if kind == "h":
        h, m = words(rnd)
        n = rnd.randint(1, 6)
        return f"<h{n}>{h}</h{n}>", [f"{'#' * n} {m}"]
    if kind == "hr":
        return "<hr>", ["---"]
    if kind == "pre":
        return "<pre>\na &lt; b\n\n *c*\n</pre>", ["```", "a < b", "", " *c*", "```"]
    if kind == "quote":
        h, lines = several(rnd, depth + 1)
        return f"<blockquote>{h}</blockquote>", [f"> {x}" if x else ">" for x in lines]
    html, out = "", []
    for k in range(rnd.randint(1, 3)):
        h, lines = several(rnd, depth + 1)
        mark = "- " if kind == "ul" else f"{k + 1}. "
        html += f"<li>{h}" + rnd.choice(["", "</li>", "</li>\n"])
        out += [""] * bool(out) + [(mark if i == 0 else " " * len(mark)) + x if x else "" for i, x in enumerate(lines)]
    return f"<{kind}>{html}</{kind}>", out


def several(rnd, depth):
    """Blocks of which the first is a paragraph, so that lists are loose."""
    h, m = words(rnd)
    html, lines = f"<p>{h}</p>", [m]
    for _ in range(rnd.randint(0, 2)):
        h, more = block(rnd, depth)
        html += h
        lines += ["", *more]
    return html, lines


def test_random_documents():
    rnd = random.Random(8)
    for _ in range(800):
        html, lines = several(rnd, 0)
        assert page_markdown(html) == "\n".join(lines) + "\n", html


def test_awkward_pages():
    assert [page_markdown(t) for t in ("", " \n", "<p> </p>", "<b></b><ul></ul><blockquote></blockquote><h1> </h1>", "<!-- x -->")] == [""] * 5
    deep = page_markdown("x" + "<div>" * 3000 + "y<b>" * 2000 + "<ul><li>" * 300 + "z")
    assert deep.startswith("x") and "z" in deep
    wide = page_markdown("<table><tr><td rowspan=2>" + "<i>" * 3000 + "q")
    assert "q" in wide
    assert page_markdown("<ul>stray<li>a</ul>") == "- stray\n- a\n"
    assert page_markdown("<p>a<br><br>b<br></p>") == "a  \n  \nb\n"
