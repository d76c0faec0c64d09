"""Cleaned HTML as Markdown by native pattern columns.

This is a plain converter for headings, paragraphs, line breaks, emphasis, links, images,
rules and flat lists. Tables stay as HTML, to be rebuilt by the table operators. It does
not aim at any other converter's exact output.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_markdown(html: Column) -> Column:
    steps = [
        (r"(?is)<head\b.*?</head\s*>", ""),
        (r"[ \t\r\n]+", " "),
        (r"(?i)<br\s*/?>", "\n"),
        (r"(?i)<hr\s*/?>", "\n\n---\n\n"),
        (r"(?i)</?(?:strong|b)>", "**"),
        (r"(?i)</?(?:em|i)>", "*"),
        (r'(?i)<img\s+src="([^"]*)">', "![]($1)"),
        (r'(?i)<a\s+href="([^"]*)">(.*?)</a>', "[$2]($1)"),
        (r"(?i)</?a>", ""),
        *((rf"(?i)\s*<h{n}>\s*(.*?)\s*</h{n}>\s*", f"\n\n{'#' * n} $1\n\n") for n in range(1, 7)),
        (r"(?i)\s*<li>\s*", "\n- "),
        (r"(?i)\s*</li>", ""),
        (r"(?i)\s*</?(?:p|div|ul|ol|body|html|article|section|nav|footer|header|main)\b[^>]*>\s*", "\n\n"),
        (r"(?i)<!doctype[^>]*>", ""),
        (r"[ \t]+\n", "\n"),
        (r"\n{3,}", "\n\n"),
    ]
    for pattern, into in steps:
        html = F.regexp_replace(html, pattern, into)
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        html = F.replace(html, F.lit(name), F.lit(sign))
    return html
