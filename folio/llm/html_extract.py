"""Main text of web pages by two-pass block rules.

A page becomes a list of blocks (runs of text between block-level tags) with their length,
the share of their text in links, their share of stop words, and where they stand.
First pass: every block is judged by link density, then by length and stop-word density; short
ones and those between the bounds stay undecided. Where a page has hardly any word of the lists (other languages, other
scripts) length alone decides; characters of scripts without blanks between words count for three. Tags shift the
judgement: blocks of page furniture (by element, role or class, or after the heading of readers' comments) are out, and in an
article or main element only a list of links stays out by its density, other blocks there become undecided.
Second pass: an undecided block takes the label of its nearest decided neighbours in its region
(the article or main elements, or the rest): the label that both sides share, else the nearer side's, else the one
before; a heading takes the label of what follows it. In an article lists of links do not speak
for their neighbours, and where nothing is decided the blocks are in; elsewhere they are out then, unless no
block of the page is in: a page of a few short lines is these lines.

A name marks furniture if, but for words of place and kind (GENERIC), nothing but words of furniture is in it: site-footer and
cookie-notice do, notice-board does not.
Names like no-sidebar or has-header tell of a layout and mark nothing; those like
sidebar-left mark nothing either, but many links put their blocks out. An article or main
element in marked wrappers is no furniture, unless it stands in an element of FIRM or in
another article or main element; an article element in a list of comments or teasers
(ASIDE_NAMES) stays furniture. A form or a marked wrapper with over half of the page's text
is judged by its blocks, if none outside of it is in.

Defined results: a null or empty page has an empty text. Broken markup is read as far as it
goes: an unclosed comment, script or style runs to the end; unknown references stay as
they are. Every row gives a row; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from folio.llm.batches import lean

#: Elements that begin and end blocks.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is no text of the page.
SILENT = frozenset("head title noscript template svg iframe object select button textarea canvas audio video map datalist".split())
#: Elements of page furniture.
FURNITURE = frozenset("nav header footer aside form menu dialog".split())
#: Words of class, id and role names that mark furniture, and those that say nothing beside them.
FURNITURE_WORDS = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert advertisement advertising banner sponsor sponsored promo cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup login search share sharing social related recommended breadcrumb breadcrumbs pagination pager comment comments disqus respond contentinfo complementary".split()
)
GENERIC = frozenset(
    "a all area article articles bar block body bottom box btn button buttons center col column container content count dialog entry fixed foot form global group head holder icon icons id info inner item items js left link links list local main media mini mobile module more nav news of outer page pages panel post posts primary region right row secondary section site slot small sticky stories story the thread title top ul unit us user view wide widget widgets wp wrap wrapper".split()
)
#: Names of a layout, with or without the furniture that they name.
LAYOUT_NAMES = re.compile(r"^(?:no|has|with|without)[-_]")
SIDE_NAMES = re.compile(r"[-_](?:left|right)$")
#: Furniture whatever it holds, and names of lists of others' articles.
FIRM = frozenset("nav aside footer menu dialog".split())
ASIDE_NAMES = re.compile(r"(?:^|[^a-z])(?:ad|ads|advert|advertisement|advertising|sponsor|sponsored|promo|related|recommended|comment|comments|disqus|respond)(?:$|[^a-z])")
#: Furniture elements in one another are told apart down to this depth; deeper ones are part of theirs.
DEPTH = 64
HEADING = re.compile("h[1-6]$")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Frequent words of the languages that are told apart from furniture.
STOP = frozenset(
    "the of and to in a is that it was for on with as be by at this from or are an not which have but"
    " le la les de des un une et est que qui dans pour sur pas au par plus avec ne se ce il elle"
    " der die das und ist in den von zu mit sich auf für ein eine nicht dem im des es als auch an"
    " el los las del y en que por con una su para al lo como más o se no".split()
)
TOKEN = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(?:!|\?)[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|[^<]+|<", re.S)
RAW_END = {k: re.compile(rf"</{k}(?=[\s/>])[^>]*>?", re.I) for k in ("script", "style", "xmp", "noembed", "noframes", "textarea", "title")}
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Headings over what readers have written.
REPLIES = re.compile(r"(?:\d+\s+)?(?:(?:reader |readers' |user )?comments?|responses|leave a (?:reply|comment)|(?:leser)?kommentare?|commentaires?(?: des lecteurs)?|comentarios?|комментарии|コメント)(?:\s*\(?\d+\)?)?\s*:?", re.I)
#: Characters of scripts that set no blanks between words.
DENSE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")
GOOD, BAD, UNSURE = 1, -1, 0
SHORT, LONG = 70, 200
LINKS, STOP_LOW, STOP_HIGH = 0.33, 0.12, 0.25
#: Below this share of stop words in all text that is not linked a page is in none of the languages.
STRANGE = 0.06


def marks_furniture(name: str) -> bool:
    words = [w for w in re.split("[^a-z]+", name) if w]
    return any(w in FURNITURE_WORDS for w in words) and all(w in FURNITURE_WORDS or w in GENERIC for w in words)


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    # open furniture elements by number, None before any text
    roots: tuple[int, ...] | None = None
    furniture: bool = False
    doubtful: bool = False
    article: bool = False
    item: bool = False
    # level, 0 for none
    heading: int = 0
    text: str = ""
    # whether the page is in a language with a list of stop words
    known: bool = True


@dataclass
class Root:
    """A furniture element: its name, if it is named as a list of others' articles, the length of its text."""

    name: str
    aside: bool
    chars: int = 0


def _close_implied(stack: list[tuple], name: str) -> None:
    """A block element ends an open paragraph, and a list item the open item of its list."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k][0] == "p" or stack[k][0] == name == "li":
            del stack[k:]
            return
        if stack[k][0] in BLOCK or stack[k][0] in SILENT:
            return


def blocks(page: str) -> list[Block]:
    """The page's blocks that hold text, in order."""
    out: list[Block] = []
    now: Block | None = None
    # open elements: name, furniture elements around by number, article, silent, list item, doubtful
    stack: list[tuple[str, tuple[int, ...], bool, bool, bool, bool]] = [("", (), False, False, False, False)]
    roots: list[Root] = []
    link, at, end = 0, 0, len(page)
    while at < end:
        m = TOKEN.match(page, at)
        at = m.end()
        name = m[2]
        if name is None:
            t = m[0]
            if t[0] == "<" and len(t) > 1:
                continue
            _, around, article, silent, item, doubtful = stack[-1]
            if silent:
                continue
            if now is None:
                now = Block(article=article, item=item, doubtful=doubtful, heading=max((int(s[0][1]) for s in stack[-3:] if HEADING.match(s[0])), default=0))
                out.append(now)
            now.parts.append(t)
            if not t.isspace():
                # inline furniture inside a paragraph is part of it
                now.roots = around if now.roots is None else tuple(r for r in now.roots if r in around)
            if link:
                now.linked += len(t.strip())
            continue
        name = name.lower()
        if not m[1] and name in RAW_END:
            stop = RAW_END[name].search(page, at)
            at = stop.end() if stop else end
            if name in BLOCK:
                now = None
            continue
        if name == "a":
            link = 0 if m[1] else 1
            continue
        if name == "br":
            if now is not None:
                now.parts.append(" ")
            continue
        if name in BLOCK:
            now = None
            if not m[1]:
                _close_implied(stack, name)
        if name in VOID:
            continue
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    # the end of an inline element leaves open blocks open
                    inline = name not in BLOCK and name not in SILENT and any(s[0] in BLOCK for s in stack[k + 1 :])
                    del stack[k : k + 1 if inline else None]
                    break
            continue
        if m[3].endswith("/") or name in ("html", "body"):
            continue
        _, around, article, silent, item, doubtful = stack[-1]
        names = [x for g in NAMES.findall(m[3]) for x in " ".join(g).lower().split()]
        names = [x for x in names if not LAYOUT_NAMES.search(x)]
        own = name in ("article", "main")
        if own:
            if not article and around and not any(s[0] in FIRM for s in stack) and (name == "main" or not any(roots[r].aside for r in around)):
                around = ()
            article, doubtful = True, False
        if HEADING.match(name) and article:
            # an article's heading is its own, even in its header
            around = tuple(r for r in around if roots[r].name != "header")
        marks = [] if own else [x for x in names if marks_furniture(x)]
        sure = [x for x in marks if not SIDE_NAMES.search(x)]
        if (name in FURNITURE or sure) and len(around) < DEPTH:
            around = (*around, len(roots))
            roots.append(Root(name, any(map(ASIDE_NAMES.search, sure))))
        stack.append((name, around, article, silent or name in SILENT, item or name == "li", doubtful or bool(marks)))
    for b in out:
        b.text = " ".join(html.unescape("".join(b.parts)).split())
    out = [b for b in out if b.text]
    words = [w for b in out if not b.linked for w in _words(b.text)]
    known = sum(w in STOP for w in words) >= STRANGE * len(words)
    for b in out:
        b.known = known
    _mark_furniture(out, roots)
    _mark_replies(out)
    return out


def _words(text: str) -> list[str]:
    return [w.strip(".,;:!?\"'()") for w in text.lower().split()]


def _mark_replies(found: list[Block]) -> None:
    """What follows a heading of readers' comments in its region, up to a heading of its level, is furniture, and so is that heading."""
    under: dict[bool, int] = {}
    for i, b in enumerate(found):
        if b.heading and b.heading <= under.get(b.article, 0):
            del under[b.article]
        if i and b.heading and b.article not in under and REPLIES.fullmatch(b.text):
            under[b.article] = b.heading
        b.furniture = b.furniture or b.article in under


def _mark_furniture(found: list[Block], roots: list[Root]) -> None:
    """A block in a furniture element is furniture, unless that element is no more than a wrapper of the page."""
    for b in found:
        b.furniture = bool(b.roots)
        for r in b.roots or ():
            roots[r].chars += len(b.text)
    half = sum(len(b.text) for b in found) / 2
    wide = {r for r, x in enumerate(roots) if x.chars > half and x.name not in FIRM}
    # wrappers of over half of the text lie in one another: from the outermost on
    for r in sorted(wide):
        if not any(r not in (b.roots or ()) and first_pass(b) >= (UNSURE if b.article else GOOD) for b in found):
            for b in found:
                if b.roots and r in b.roots:
                    b.roots = tuple(x for x in b.roots if x != r)
                    b.furniture, b.doubtful = bool(b.roots), True


def density(b: Block) -> int:
    """By the share of links, then by length and the share of stop words."""
    n = len(b.text)
    links = b.linked / n
    if links > LINKS:
        return BAD
    n += 2 * len(DENSE.findall(b.text))
    if n < SHORT:
        return BAD if links else UNSURE
    if not b.known:
        return GOOD if n >= LONG else UNSURE
    words = _words(b.text)
    stop = sum(w in STOP for w in words) / len(words)
    if stop >= STOP_HIGH or stop >= STOP_LOW and n >= LONG:
        return GOOD
    return UNSURE if stop >= STOP_LOW else BAD


def first_pass(b: Block) -> int:
    label = density(b)
    if b.furniture:
        return BAD
    if b.article and label == BAD:
        links = b.linked / len(b.text)
        return BAD if b.item and links > 0.9 or b.doubtful and links > LINKS else UNSURE
    return label


def second_pass(labels: list[int], headings: list[bool] | None = None, article: bool = False, alone: bool | None = None) -> list[int]:
    """A region's labels, the undecided ones from the nearest decided ones; in an article, and where it is alone, only good ones speak, and without any the undecided are in; else out."""
    n = len(labels)
    alone = article if alone is None else alone
    heard = [GOOD if x == GOOD else UNSURE if alone else x for x in labels]
    before, after = [-1] * n, [n] * n
    for i in range(n):
        before[i] = i if heard[i] else (before[i - 1] if i else -1)
    for i in range(n - 1, -1, -1):
        after[i] = i if heard[i] else (after[i + 1] if i + 1 < n else n)
    out = []
    for i, x in enumerate(labels):
        if not x:
            a, b = before[i], after[i]
            if a < 0 and b == n:
                x = GOOD if alone else BAD
            elif a < 0 or b < n and (headings is not None and headings[i] or b - i < i - a):
                x = heard[b]
            else:
                x = heard[a]
        out.append(x)
    return out


def extract(page: str | None) -> str:
    """The page's main text: its blocks, one a line."""
    found = blocks(page or "")
    labels = [first_pass(b) for b in found]
    for article in (True, False):
        some = [i for i, b in enumerate(found) if b.article == article]
        # a page on which nothing is in so far is what it says in short, but for what a form or a marked wrapper says
        alone = article or GOOD not in labels
        if alone and not article:
            for i in some:
                labels[i] = BAD if found[i].doubtful else labels[i]
        for i, x in zip(some, second_pass([labels[i] for i in some], [found[i].heading > 0 for i in some], article, alone), strict=True):
            labels[i] = x
    return "\n".join(b.text for b, x in zip(found, labels, strict=True) if x == GOOD)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars of every page. Narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            texts = [extract(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return pages.select(id_col, url_col, html_col).mapInArrow(run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")
