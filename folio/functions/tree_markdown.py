"""HTML as Markdown by its tree: nested lists and quotes, code, tables, emphasis, links, with signs escaped that Markdown would read.

The tree is that of the HTML standard's rules, so unclosed and misnested tags mean what browsers make of them. Blocks are lists
of lines; what contains a block sets signs before its lines. Tables without spans or blocks in their cells become pipe
tables, others stay HTML, to be rebuilt by the table operators. It does not aim at any other converter's exact output.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.markup import BLOCKS, CELLS, HEADINGS, ITEMS, Node, Tree

DROPPED = frozenset("script style head title template noscript colgroup col".split())
LISTS = frozenset(("ul", "ol"))
BLOCK = (BLOCKS | frozenset("pre listing blockquote hr table form body html tbody thead tfoot tr caption td th".split()) | ITEMS.keys()) - {"dialog"}
SIGNS = {"strong": "**", "b": "**", "em": "*", "i": "*", "del": "~~", "s": "~~", "strike": "~~"}
CODE = frozenset("code tt kbd samp".split())
#: Open elements below which what is deeper is taken as text, so that no document is too deep.
DEPTH = 100

#: Signs with a meaning; an underscore within a word has none.
_SIGN = re.compile(r"[\\`*\[\]<]|(?<![^\W_])_|_(?![^\W_])|~~|&(?=#?\w+;)")
_START = re.compile(r"(#{1,6}(?=\s|$)|[-+](?=\s|$)|>|=+$|-+$|~~~)|(\d{1,9})([.)])(?=\s|$)")


def escaped(text: str) -> str:
    return _SIGN.sub(lambda m: "".join("\\" + c for c in m[0]), text)


def _line_start(line: str) -> str:
    return _START.sub(lambda m: "\\" + m[1] if m[1] else f"{m[2]}\\{m[3]}", line, count=1) if _START.match(line) else line


def _code(text: str) -> str:
    runs = [len(r) for r in re.findall(r"`+", text)]
    fence = "`" * next(n for n in range(1, len(runs) + 2) if n not in runs)
    edge = " " if text.startswith("`") or text.endswith("`") else ""
    return f"{fence}{edge}{text}{edge}{fence}"


def _address(url: str) -> str:
    return f"<{url}>" if re.search(r"[\s()]", url) else url


def _strings(node: Node) -> str:
    return "".join(x for x in node.walk() if isinstance(x, str))


def inline(items: Iterable[Node | str], signs: tuple[str, ...] = (), depth: int = 0) -> str:
    """Running text of items that hold no blocks. White space is one blank; a newline stands for a line break."""
    out = []
    for x in items:
        if isinstance(x, str):
            out.append(escaped(re.sub(r"[ \t\n\f\r]+", " ", x)))
        elif x.name == "br":
            out.append("\n")
        elif x.name == "img":
            out.append(f"![{escaped(x.attrs.get('alt', ''))}]({_address(x.attrs['src'])})" if x.attrs.get("src") else "")
        elif x.name in CODE:
            text = re.sub(r"\s+", " ", _strings(x))
            out.append(_code(text) if text.strip() else text)
        elif x.name in DROPPED or not x.name:
            continue
        elif depth > DEPTH:
            out.append(escaped(_strings(x)))
        else:
            sign = SIGNS.get(x.name)
            text = inline(x.children, (*signs, sign) if sign else signs, depth + 1)
            if x.name == "a" and x.attrs.get("href") and text.strip():
                text = _around(text, "[", f"]({_address(x.attrs['href'])})")
            elif sign and sign not in signs and text.strip():
                text = _around(text, sign, sign)
            out.append(text)
    return re.sub(r" *\n *", "\n", re.sub(r" +", " ", "".join(out)))


def _around(text: str, before: str, after: str) -> str:
    """Signs right at the words; blanks at the ends go outside."""
    words = text.strip()
    start = text.index(words)
    return text[:start] + before + words + after + text[start + len(words) :]


def _is_block(x: Node | str) -> bool:
    return isinstance(x, Node) and (x.name in BLOCK or any(isinstance(y, Node) and y.name in BLOCK for y in x.walk()))


def _indented(text: str, first: str, rest: str) -> str:
    return "\n".join((first if i == 0 else rest) + line if line else (first if i == 0 else rest).rstrip() for i, line in enumerate(text.split("\n")))


def _items(x: Node, depth: int) -> str:
    """A list. Its items stand close if none of them has paragraphs or other blocks than lists beside its text."""
    entries = [[c] if isinstance(c, Node) and c.name == "li" else None for c in x.children if isinstance(c, Node) and c.name or isinstance(c, str) and c.strip()]
    found = [c for c in x.children if isinstance(c, Node) and c.name == "li"]
    if len(entries) != len(found):  # what stands between items belongs to the one before
        groups: list[list[Node | str]] = []
        for c in x.children:
            if isinstance(c, Node) and c.name == "li":
                groups.append(list(c.children))
            elif isinstance(c, Node) or c.strip():
                groups.append([]) if not groups else None
                groups[-1].append(c)
    else:
        groups = [c.children for c in found]
    close = not any(isinstance(c, Node) and _is_block(c) and c.name not in LISTS for g in groups for c in g)
    start = x.attrs.get("start", "1")
    number = int(start) if x.name == "ol" and start.isdigit() and len(start) < 9 else 1
    out = []
    for k, g in enumerate(groups):
        mark = f"{number + k}. " if x.name == "ol" else "- "
        out.append(_indented(("\n" if close else "\n\n").join(blocks(g, depth + 1)), mark, " " * len(mark)))
    return ("\n" if close else "\n\n").join(out)


def _table(x: Node, depth: int) -> list[str]:
    rows = [[c for c in r.children if isinstance(c, Node) and c.name in CELLS] for part in x.children if isinstance(part, Node) for r in ([part] if part.name == "tr" else part.children) if isinstance(r, Node) and r.name == "tr"]
    flat = [c for r in rows for c in r]
    captions = [c for c in x.children if isinstance(c, Node) and c.name == "caption"]
    plain = flat and not any(c.attrs.get("rowspan", "1") != "1" or c.attrs.get("colspan", "1") != "1" or any(map(_is_block, c.children)) for c in flat)
    before = [b for c in captions for b in blocks(c.children, depth + 1)]
    if not plain:
        return before + [markup(x, captions)]
    width = max(map(len, rows))
    text = [[inline(c.children).strip().replace("\n", "<br>").replace("|", "\\|") for c in r] + [""] * (width - len(r)) for r in rows]
    lines = [f"| {' | '.join(r)} |" for r in text]
    return before + ["\n".join([lines[0], f"| {' | '.join(['---'] * width)} |", *lines[1:]])]


def markup(x: Node | str, but: Iterable[Node] = (), depth: int = 0) -> str:
    """HTML again, a table's parts on lines of their own."""
    if isinstance(x, str):
        return html.escape(re.sub(r"\s+", " ", x), quote=False)
    if x in but or not x.name or x.name in ("script", "style"):
        return ""
    if depth > 2 * DEPTH:
        return html.escape(_strings(x), quote=False)
    attrs = "".join(f' {k}="{html.escape(v)}"' for k, v in x.attrs.items())
    if x.name in ("br", "img", "hr", "col", "input", "wbr"):
        return f"<{x.name}{attrs}>"
    end = "\n" if x.name in ("table", "thead", "tbody", "tfoot", "tr") else ""
    parts = [c for c in x.children if c not in but and not (end and isinstance(c, str) and not c.strip())]
    return f"<{x.name}{attrs}>{end}" + "".join(markup(c, but, depth + 1) + (end if end and not (isinstance(c, Node) and c.name in ("thead", "tbody", "tfoot", "tr")) else "") for c in parts) + f"</{x.name}>" + (end if x.name != "table" else "")


def _pre(x: Node) -> str:
    text = _strings(x)
    text = text.removeprefix("\n").rstrip("\n")
    inner = next((c for c in x.children if isinstance(c, Node) and c.name == "code"), x)
    named = re.search(r"(?:^|\s)(?:language|lang)-(\S+)", inner.attrs.get("class", "") + " " + x.attrs.get("class", ""))
    fence = "`" * max(3, *(len(r) + 1 for r in re.findall(r"`+", text)), 0)
    return f"{fence}{named[1] if named else ''}\n{text}\n{fence}"


def blocks(items: Iterable[Node | str], depth: int = 0) -> list[str]:
    """The blocks of items; what runs between them is a paragraph."""
    out, run = [], []

    def paragraph() -> None:
        text = inline(run).strip()
        run.clear()
        if text:
            out.append("  \n".join(map(_line_start, text.split("\n"))))

    for x in items:
        if not _is_block(x):
            run.append(x)
            continue
        paragraph()
        if x.name in DROPPED:
            continue
        if depth > DEPTH:
            run.append(_strings(x))
        elif x.name in HEADINGS:
            text = re.sub(r"\s+", " ", inline(x.children)).strip()
            out += [f"{'#' * int(x.name[1])} {text}"] if text else []
        elif x.name in LISTS:
            text = _items(x, depth)
            out += [text] if text else []
        elif x.name == "blockquote":
            inner = "\n\n".join(blocks(x.children, depth + 1))
            out += [_indented(inner, "> ", "> ")] if inner else []
        elif x.name in ("pre", "listing"):
            out.append(_pre(x))
        elif x.name == "hr":
            out.append("---")
        elif x.name == "table":
            out += _table(x, depth)
        else:
            out += blocks(x.children, depth + 1)
    paragraph()
    return out


def page_markdown(text: str) -> str:
    """A page or a piece of one as Markdown, with a newline at its end if it has any text."""
    made = "\n\n".join(blocks(Tree(text).root.children))
    return made + "\n" if made else ""


@F.pandas_udf(T.StringType())
def tree_to_markdown(pages: pd.Series) -> pd.Series:
    """page_markdown() of a column; null stays null."""
    return pages.map(lambda t: None if t is None else page_markdown(t))
