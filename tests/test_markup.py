"""Broken markup: the tree that the standard's rules make of it."""

import random

import pytest

from folio.functions.markup import Node, Tree, tokens
from folio.operators.tables import read_grid
from folio.plans.table_cases import BROKEN

TAGS = "table tr td th tbody thead tfoot caption col colgroup b i a p div ul li span select option button h1 form input script style br object dl dd".split()


@pytest.mark.parametrize(("markup", "made"), [c[1:] for c in BROKEN])
def test_every_case_keeps_its_texts(markup, made):
    grid = read_grid(markup[: markup.lower().index("</table") + 9])
    cells = "".join(c for row in grid for c in row)
    for sign in ("@A", "@B", "@C"):
        assert (sign in cells) == (sign in made)


def test_any_markup_gives_a_tree():
    rnd = random.Random(1)
    for _ in range(4000):
        parts = [rnd.choice([f"<{rnd.choice(TAGS)}>", f"</{rnd.choice(TAGS)}>", rnd.choice(["x", "y ", " ", "<", "&lt;", "<!--c-->", "<td rowspan=2>", "</", '<a href="q">', "<b "])]) for _ in range(rnd.randint(1, 25))]
        tree = Tree("<table>" + "".join(parts) + "</table>")
        for x in tree.root.walk():
            if isinstance(x, Node):
                assert sum(c is x for c in x.parent.children) == 1
                assert not any(isinstance(a, str) and isinstance(b, str) for a, b in zip(x.children, x.children[1:], strict=False))
                if x.name == "tr":
                    assert x.parent.name in ("tbody", "thead", "tfoot")
                if x.name in ("td", "th"):
                    assert x.parent.name == "tr"


def test_well_formed_text_stays_in_order():
    rnd = random.Random(2)
    for _ in range(200):
        words = [f"w{rnd.randint(0, 99)}" for _ in range(12)]
        rows = ["".join(f"<td><i>{w}</i></td>" for w in words[k : k + 3]) for k in range(0, 12, 3)]
        assert read_grid("<table>" + "".join(f"<tr>{r}</tr>" for r in rows) + "</table>") == [words[k : k + 3] for k in range(0, 12, 3)]


def test_tokens():
    assert [t[:2] for t in tokens("a<b >c</b><!-->d<?x>e</>f< g<!doctype q>h")] == [("text", "a"), ("start", "b"), ("text", "c"), ("end", "b"), ("comment", ""), ("text", "d"), ("comment", ""), ("text", "ef< gh")]
    assert list(tokens("<td A=1 a=2 b='x>y' c=\"&amp;\" d/>z")) == [("start", "td", {"a": "1", "b": "x>y", "c": "&", "d": ""}), ("text", "z", {})]
    assert [t[:2] for t in tokens("<script>a<b</i></SCRIPT >c")] == [("start", "script"), ("text", "a<b</i>"), ("end", "script"), ("text", "c")]
    assert list(tokens("<td title='open")) == []
