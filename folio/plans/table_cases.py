"""Queries over broken table markup, made from pages: what browsers' rules make of it was worked out by hand for each case."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators import tables
from folio.plans.catalog import literal, longs, query, table

RULE = "| --- | --- |\n"
#: (case, markup, its pipe table); @A, @B and @C stand for texts of a page.
BROKEN = [
    (1, "<table><td>@A<td>@B<tr><td>@C<td>1</table>", f"| @A | @B |\n{RULE}| @C | 1 |\n"),
    (2, "<table>@C<tr><td>@A</td>@C<td>@B</td></tr></table>", f"| @A | @B |\n{RULE}"),
    (3, "<table><tr><td><b>@A<td>@B</b>@C</tr></table>", f"| @A | @B@C |\n{RULE}"),
    (4, "<table><tr><td>@A < 1 &amp; 2</i>@C</th>3<td>@B</table>", f"| @A < 1 & 2@C3 | @B |\n{RULE}"),
    (5, "<table><tr><td>@A<table><tr><td>@B</td>@C</tr></table></td></tr></table>", f"**@B**\n\n| @A@C<br>@B | @B |\n{RULE}</td></tr></table>"),
    (6, "<table><caption>@C<col><thead><th>@A<th>1<tbody><td>@B<td>2</table>", f"| @A | 1 |\n{RULE}| @B | 2 |\n"),
    (7, "<table><tr><td><p>@A<p>1<td><ul><li>@B<li>2</ul>@C</table>", f"| @A<br>1 | @B<br>2<br>@C |\n{RULE}"),
    (8, "<table><tr><td>@A<!-- x -->@B<td>1</br>2</p>3</table>", f"| @A<br>@B | 1<br>2<br>3 |\n{RULE}"),
    (9, "<table><tr><td><select><option>@A<option>@B<td>@C</table>", f"| @A<br>@B | @C |\n{RULE}"),
    (10, "<table><tr><td><b>@A<p>1</b>@B</p>2<td>@C</table>", f"| @A<br>1<br>@B<br>2 | @C |\n{RULE}"),
    (11, "<table><tr><td><p><b>@A</p>@B</b>@C<td>1</table>", f"| @A<br>@B<br>@C | 1 |\n{RULE}"),
    (12, "<table><tr><td title='1>2' rowspan=\"2\">@A<td colspan=x>@B</tr><tr><td>@C</table>", f"| @A | @B |\n{RULE}| @A | @C |\n"),
    (13, "<table><tr><td><a href=1>@A<a href=2>@B</a>@C<td>1</table>", f"| @A<br>@B<br>@C | 1 |\n{RULE}"),
    (14, "<table><tr><td>@A<td>@B</tr><table><tr><td>@C</table>", f"| @A | @B |\n{RULE}"),
    (15, "<table><div><tr><td>@A</div>1<td><form>@B</form>@C</table>", f"| @A1 | @B<br>@C |\n{RULE}"),
    (16, "<table><tr><td><script>if (1<2) x</script>@A<td>@B</table>", f"| if (1<2) x<br>@A | @B |\n{RULE}"),
    (17, "<table><tfoot><tr><td>@A<td>1</tfoot></tbody><tr><td>@B<td>2</tr></table>", f"| @A | 1 |\n{RULE}| @B | 2 |\n"),
    (18, '<table><tr><td>@A<td>@B<td class="x>@C</table>', f"| @A | @B |\n{RULE}"),
    (19, "<table><tr><td><span>@A</tr><tr><td>@B</span>1<td>@C</table>", f"**@A**\n\n| @B1 | @C |\n{RULE}"),
    (20, "<TABLE BORDER><TR><TH ROWSPAN=02>@A<TH>@B<TR><TD>@C</TABLE >", f"| @A | @B |\n{RULE}| @A | @C |\n"),
    (21, "<table><caption><b>@A<tr><td>@B<td>@C</table>", f"| @B | @C |\n{RULE}"),
    (22, "<table><b><tr><td>@A<td>@B</b></table>", f"| @A | @B |\n{RULE}"),
    (23, "<table><tr><td><h2>@A<h3>1</h4>2<td><dl><dt>@B<dd>@C</dl></table>", f"| @A<br>1<br>2 | @B<br>@C |\n{RULE}"),
    (24, "<table><tr><td><button>@A<button>1</button>2<td><textarea><b>@B</textarea></table>", f"| @A<br>1<br>2 | <b>@B |\n{RULE}"),
]
TEXTS = {"@A": "'a ' || page_id", "@B": "url", "@C": "'c' || page_id"}


def _texts_sql(text: str) -> str:
    for sign, value in TEXTS.items():
        text = f"replace({text}, '{sign}', {value})"
    return text


@query(
    f"""SELECT page_id, case_id, 'x ' || {_texts_sql("made")} || ' y' AS text, CAST(1 AS BIGINT) AS tables_found, CAST(1 AS BIGINT) AS tables_converted
    FROM pages, ({literal([(i, made) for i, _, made in BROKEN], "case_id", "made")})"""
)
def table_broken_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = F.array(*(F.struct(F.lit(i).cast("long").alias("case_id"), F.lit(markup).alias("markup")) for i, markup, _ in BROKEN))
    rows = table(spark, sf_dir, "pages").select("page_id", "url", F.inline(cases))
    text = F.col("markup")
    for sign, value in TEXTS.items():
        text = F.replace(text, F.lit(sign), F.expr(value))
    made = rows.select("page_id", "case_id", F.concat(F.lit("x "), text, F.lit(" y")).alias("text"))
    return longs(tables.replace_tables(made), "tables_found", "tables_converted")
