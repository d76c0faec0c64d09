"""A query over pages that are built from parts by a template; the Markdown that it must give is built from the same parts by another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions.tree_markdown import tree_to_markdown
from folio.plans.catalog import query, table

#: (HTML, its Markdown) of a page's parts; @N is the page's number, @U its address.
PARTS = [
    ("<h2>Page @N <i>of</i>  @U</h2>", "## Page @N *of* @U"),
    ("<p>See <b> all @N </b>and <a href='@U'>this\n page</a>,<br># 1_2 * 3 `x` [y] &lt;b&gt;", "See **all @N** and [this page](@U),  \n\\# 1_2 \\* 3 \\`x\\` \\[y\\] \\<b>"),
    ("<ul><li>one<ul><li>deep @N<ol><li>x<li>y</ol><li>er</ul>\n<li><p>two</ul>", "- one\n\n  - deep @N\n    1. x\n    2. y\n  - er\n\n- two"),
    ("<ul><li>one<ul><li>deep @N<ol start=9><li>x<li>y</ol></ul><li><em>two</em></ul>", "- one\n  - deep @N\n    9. x\n    10. y\n- *two*"),
    ("<blockquote><p>said @N<blockquote>before</blockquote><ul><li>a<li>b</ul></blockquote>", "> said @N\n>\n> > before\n>\n> - a\n> - b"),
    ('<pre><code class="x language-py">if a &lt; @N:\n  *x*\n\n  ```\n</code></pre>', "````py\nif a < @N:\n  *x*\n\n  ```\n````"),
    ("<table><tr><th>k|1<th>v<tr><td>@N<br>b<td><code>a|`b</code><tr><td>c</table>", "| k\\|1 | v |\n| --- | --- |\n| @N<br>b | ``a\\|`b`` |\n| c |  |"),
    ("<table><caption>cap @N</caption><tr><td rowspan=2>x &amp; y<td>@N<tr><td><b>z</b></table>", 'cap @N\n\n<table>\n<tbody>\n<tr>\n<td rowspan="2">x &amp; y</td>\n<td>@N</td>\n</tr>\n<tr>\n<td><b>z</b></td>\n</tr>\n</tbody>\n</table>'),
    ("<hr><div>- @N<div># in</div>@N. tail <del>gone</del> <img src='a b.png' alt='@N'></div>", "---\n\n\\- @N\n\n\\# in\n\n@N\\. tail ~~gone~~ ![@N](<a b.png>)"),
    ("<p><b>broken <i>@N</b> tags</i><p><p>end<script>x</script>", "**broken *@N*** *tags*\n\nend"),
]


def _parts_sql() -> str:
    """A page takes the parts from its number on, in turn: half of them."""
    listed = ", ".join("'" + md.replace("'", "''") + "'" for _, md in PARTS)
    return f"list_transform(range({len(PARTS) // 2}), lambda i: [{listed}][1 + (page_id + i * 3) % {len(PARTS)}])"


@query(f"SELECT page_id, replace(replace(array_to_string({_parts_sql()}, chr(10) || chr(10)), '@N', CAST(page_id AS VARCHAR)), '@U', url) || chr(10) AS text FROM pages")
def html_tree_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.array(*(F.lit(h) for h, _ in PARTS))
    chosen = F.transform(F.sequence(F.lit(0), F.lit(len(PARTS) // 2 - 1)), lambda i: F.element_at(parts, (1 + (F.col("page_id") + i * 3) % len(PARTS)).cast("int")))
    html = F.replace(F.replace(F.array_join(chosen, "\n"), F.lit("@N"), F.col("page_id").cast("string")), F.lit("@U"), F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", tree_to_markdown(F.concat(F.lit("<!doctype html><html><head><title>t</title></head><body>"), html)).alias("text"))
