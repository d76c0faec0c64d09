"""HTML clean-up as native regular-expression columns; none of them shuffles or leaves the JVM.

Rules that depend on an attribute take two passes: the first marks a tag that has the
attribute with a control character, the second empties the tags without a mark.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.text import collapse_blank, strip

#: Structural elements whose attributes go.
STRUCTURAL = ("div", "p", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "colgroup", "col", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li")
#: Extensions of images that are copied.
IMAGE_EXTENSIONS = (".png", ".jpg", ".jpeg", ".gif", ".webp", ".svg")
_MARK = "\u0001"


def strip_blocks(html: Column) -> Column:
    """Without style and script elements and comments."""
    for pattern in (r"(?is)<style\b.*?</style>", r"(?is)<script\b.*?</script>", r"(?s)<!--.*?-->"):
        html = F.regexp_replace(html, pattern, "")
    return html


def drop_namespaced(html: Column) -> Column:
    """Without the tags (not the contents) of the office namespaces v, o and w."""
    return F.regexp_replace(html, r"(?i)</?[vow]:[^>]*>", "")


def unwrap_spans(html: Column) -> Column:
    return F.regexp_replace(html, r"(?iu)<span\b[^>]*>|</span\s*>", "")


def strip_attributes(html: Column) -> Column:
    """Structural tags without attributes, in the case they were written in. Takes cell spans away too: expand tables first."""
    return F.regexp_replace(html, rf"(?i)<({'|'.join(STRUCTURAL)})\b[^>]*>", "<$1>")


def _keep_attribute(html: Column, tag: str, attribute: str) -> Column:
    marked = F.regexp_replace(html, rf'(?i)<{tag}\b[^>]*?{attribute}\s*=\s*"([^">]+)"[^>]*>', f'<{_MARK}{tag} {attribute}="$1">')
    return F.replace(F.regexp_replace(marked, rf"(?i)<{tag}\b[^>]*>", f"<{tag}>"), F.lit(_MARK), F.lit(""))


def keep_href(html: Column) -> Column:
    """Anchors with their first double-quoted href only."""
    return _keep_attribute(html, "a", "href")


def keep_src(html: Column) -> Column:
    """Images with their first double-quoted src only."""
    return _keep_attribute(html, "img", "src")


def clean(html: Column) -> Column:
    """All of the above, in their order."""
    return keep_href(keep_src(strip_attributes(unwrap_spans(drop_namespaced(strip_blocks(html))))))


def images_to_markdown(text: Column) -> Column:
    """Images with a double-quoted src in Markdown's form; of several src attributes the last counts."""
    return F.regexp_replace(text, r'(?i)<img\b[^>]*\bsrc\s*=\s*"([^"]+)"[^>]*>', "![]($1)")


def normalise_markdown(text: Column) -> Column:
    """LF line ends, no empty lines at the start, at most two empty lines in a row."""
    return collapse_blank(F.regexp_replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), r"\A\n+", ""))


def drop_div_lines(text: Column) -> Column:
    """Without the lines that hold nothing but a div tag."""
    kept = F.filter(F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), "\n"), lambda x: ~x.rlike(r"(?iU)^[\s\x1c-\x1f]*</?div>[\s\x1c-\x1f]*\z"))
    return F.array_join(kept, "\n")


def tidy_markdown(text: Column) -> Column:
    """Markdown that still has HTML in it, made readable: no div lines, column groups and paragraph tags, bare tables, Markdown images."""
    text = drop_div_lines(text)
    for pattern, into in ((r"(?is)<colgroup\b.*?</colgroup\s*>", ""), (r"(?i)<col\b[^>]*>", ""), (r"(?i)<table\b[^>]*>", "<table>")):
        text = F.regexp_replace(text, pattern, into)
    text = F.regexp_replace(images_to_markdown(text), r"(?i)<p\b[^>]*>|</p\s*>", "")
    return F.concat(strip(collapse_blank(text)), F.lit("\n"))


def charset(content: Column) -> Column:
    """The charset that the first 4096 bytes declare without quotes, as a codec's name; utf-8 by default."""
    head = F.decode(F.substring(content, 1, 4096), "ISO-8859-1")
    name = F.lower(F.regexp_extract(head, r"(?i)charset\s*=\s*([A-Za-z0-9_\-]+)", 1))
    return F.when(name.isin("gb2312", "gb_2312-80"), "gbk").when(name == "", "utf-8").otherwise(name)


def skip_path(path: Column) -> Column:
    """Whether a path under the source tree is no page: empty, in a template folder, a header of a .files folder, or a project file."""
    parts = F.split(F.lower(path), "/")
    name, parent = F.element_at(parts, -1), F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit(""))
    in_template = F.element_at(parts, 1).isin("template", "template2")
    return (path == "") | in_template | ((name == "header.htm") & parent.endswith(".files")) | name.rlike(r"\.(hhc|hhk|wcp)\z")


def nav_asset(src: Column) -> Column:
    return F.lower(F.replace(src, F.lit("\\"), F.lit("/"))).rlike(r"(\A|/)template2?/")


def external(src: Column) -> Column:
    plain = F.replace(src, F.lit("\\"), F.lit("/"))
    return plain.rlike(r"(?i)\A(https?:)?//") | plain.startswith("data:")


def image_path(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]*)\z", 1)).isin(*IMAGE_EXTENSIONS)
