"""The query catalogue: each query with DuckDB SQL for the same rows. Inputs that the driver's tables lack are built from them, alike on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import html
from folio.functions import markdown as md
from folio.functions import text as tx
from folio.functions.charset import decode_as
from folio.functions.convert import to_markdown
from folio.operators import assets, checklist, contents, documents, repair, tables
from folio.plans import jobs
from folio.sources import files, scratch, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: White space of Unicode as a pattern class for the SQL side, whose \s is ASCII's.
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal(rows: list[tuple], *names: str) -> str:
    """SQL of a literal relation."""

    def value(x: object) -> str:
        return "NULL" if x is None else "'" + x.replace("'", "''") + "'" if isinstance(x, str) else f"CAST({x} AS BIGINT)"

    return " UNION ALL ".join("SELECT " + ", ".join(f"{value(v)} AS {n}" for v, n in zip(r, names, strict=True)) for r in rows)


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def per_nation(spark: SparkSession, sf_dir: str, rows: list[tuple], *names: str) -> DataFrame:
    """Each of a few crafted rows for each nation, whose key comes first and whose name stands for every @ in them."""
    value = lambda v: F.lit(v) if not isinstance(v, str) else F.replace(F.lit(v), F.lit("@"), F.col("n_name"))
    cases = F.array(*(F.struct(*(value(v).alias(n) for v, n in zip(r, names, strict=True))) for r in rows))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), F.inline(cases))


def per_nation_sql(rows: list[tuple], *names: str) -> str:
    columns = ", ".join(f"replace({n}, '@', n_name) AS {n}" if any(isinstance(r[i], str) for r in rows) else n for i, n in enumerate(names))
    return f"SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, {columns} FROM nation, ({literal(rows, *names)})"


def work_folder(spark: SparkSession) -> str:
    """A new folder for the files that a query writes and reads back; it goes with the driver's process."""
    return scratch.folder(spark, "files")


# --- HTML clean-up

STRIP_SQL = r"regexp_replace(regexp_replace(regexp_replace({}, '(?is)<style\b.*?</style>', '', 'g'), '(?is)<script\b.*?</script>', '', 'g'), '(?s)<!--.*?-->', '', 'g')"
ATTRS_SQL = r"regexp_replace({}, '(?i)<(" + "|".join(html.STRUCTURAL) + r")\b[^>]*>', '<\1>', 'g')"


def keep_sql(text: str, tag: str, attribute: str) -> str:
    marked = rf"""regexp_replace({text}, '(?i)<{tag}\b[^>]*?{attribute}\s*=\s*"([^">]+)"[^>]*>', '<' || chr(1) || '{tag} {attribute}="\1">', 'g')"""
    return rf"replace(regexp_replace({marked}, '(?i)<{tag}\b[^>]*>', '<{tag}>', 'g'), chr(1), '')"


@query(f"SELECT page_id, {STRIP_SQL.format('html')} AS html FROM pages")
def html_strip_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html.strip_blocks(F.col("html")).alias("html"))


@query(f"SELECT page_id, {ATTRS_SQL.format('html')} AS html FROM pages")
def html_strip_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html.strip_attributes(F.col("html")).alias("html"))


@query(f"SELECT page_id, {keep_sql('html', 'a', 'href')} AS html FROM pages")
def html_anchor_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html.keep_href(F.col("html")).alias("html"))


@query(r"""SELECT n_nationkey, regexp_replace(regexp_replace('<SPAN class="n">' || n_name || '</span ><o:p>' || n_regionkey || '</o:p><v:shape id=1/><w>', '(?i)</?[vow]:[^>]*>', '', 'g'), '(?i)<span\b[^>]*>|</span\s*>', '', 'g') AS html FROM nation""")
def html_unwrap_span_drop_vml(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.concat(F.lit('<SPAN class="n">'), "n_name", F.lit("</span ><o:p>"), F.col("n_regionkey").cast("string"), F.lit("</o:p><v:shape id=1/><w>"))
    return table(spark, sf_dir, "nation").select("n_nationkey", html.unwrap_spans(html.drop_namespaced(made)).alias("html"))


IMG_SQL = """'<p><img width="5" src="img/' || n_name || '.png" data-src="b.gif"> and <IMG alt="x"> <img src=''q''></p>'"""


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.concat(F.lit('<p><img width="5" src="img/'), "n_name", F.lit('.png" data-src="b.gif"> and <IMG alt="x"> <img src=\'q\'></p>'))
    return table(spark, sf_dir, "nation").select("n_nationkey", made.alias("html"))


@query(f"SELECT n_nationkey, {keep_sql(IMG_SQL, 'img', 'src')} AS html FROM nation")
def html_img_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images(spark, sf_dir).select("n_nationkey", html.keep_src(F.col("html")).alias("html"))


@query(rf"""SELECT n_nationkey, regexp_replace({IMG_SQL}, '(?i)<img\b[^>]*\bsrc\s*=\s*"([^"]+)"[^>]*>', '![](\1)', 'g') AS text FROM nation""")
def html_img_to_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images(spark, sf_dir).select("n_nationkey", html.images_to_markdown(F.col("html")).alias("text"))


@query("SELECT page_id, " + keep_sql(keep_sql(ATTRS_SQL.format(r"regexp_replace(regexp_replace(" + STRIP_SQL.format("html") + r", '(?i)</?[vow]:[^>]*>', '', 'g'), '(?i)<span\b[^>]*>|</span\s*>', '', 'g')"), "img", "src"), "a", "href") + " AS html FROM pages")
def html_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html.clean(F.col("html")).alias("html"))


CLEAN_SQL = keep_sql(keep_sql(ATTRS_SQL.format(r"regexp_replace(regexp_replace(" + STRIP_SQL.format("html") + r", '(?i)</?[vow]:[^>]*>', '', 'g'), '(?i)<span\b[^>]*>|</span\s*>', '', 'g')"), "img", "src"), "a", "href")
#: White space as the engine's patterns take it; the SQL side's class has no vertical tab.
SP = r"[\s\x{0b}]"


def chain_sql(text: str, steps: list[tuple[str, str]]) -> str:
    for pattern, into in steps:
        into = " || ".join(f"'{x}'" for x in [into.replace("'", "''")]).replace("\n", "' || chr(10) || '")
        text = f"regexp_replace({text}, '{pattern}', {into}, 'g')"
    return text


MARKDOWN_STEPS = [
    (r"(?is)<head\b.*?</head\s*>", ""),
    (r"[ \t\r\n]+", " "),
    (rf"(?i)<br{SP}*/?>", "\n"),
    (rf"(?i)<hr{SP}*/?>", "\n\n---\n\n"),
    (r"(?i)</?(?:strong|b)>", "**"),
    (r"(?i)</?(?:em|i)>", "*"),
    (rf'(?i)<img{SP}+src="([^"]*)">', r"![](\1)"),
    (rf'(?i)<a{SP}+href="([^"]*)">(.*?)</a>', r"[\2](\1)"),
    (r"(?i)</?a>", ""),
    *((rf"(?i){SP}*<h{n}>{SP}*(.*?){SP}*</h{n}>{SP}*", f"\n\n{'#' * n} \\1\n\n") for n in range(1, 7)),
    (rf"(?i){SP}*<li>{SP}*", "\n- "),
    (rf"(?i){SP}*</li>", ""),
    (rf"(?i){SP}*</?(?:p|div|ul|ol|body|html|article|section|nav|footer|header|main)\b[^>]*>{SP}*", "\n\n"),
    (r"(?i)<!doctype[^>]*>", ""),
    (r"[ \t]+\n", "\n"),
    (r"\n{3,}", "\n\n"),
]
MARKDOWN_SQL = chain_sql(CLEAN_SQL, MARKDOWN_STEPS)
for _name, _sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
    MARKDOWN_SQL = f"replace({MARKDOWN_SQL}, '{_name}', '{_sign}')"
MARKDOWN_SQL = rf"regexp_replace(regexp_replace(replace({MARKDOWN_SQL}, chr(13) || chr(10), chr(10)), '^\n+', ''), '\n{{4,}}', repeat(chr(10), 3), 'g')"
TIDIED_SQL = chain_sql(
    rf"array_to_string(list_filter(string_split(md, chr(10)), lambda x: NOT regexp_matches(x, '(?i)^{WS}*</?div>{WS}*$')), chr(10))",
    [(r"(?is)<colgroup\b.*?</colgroup\s*>", ""), (r"(?i)<col\b[^>]*>", ""), (r"(?i)<table\b[^>]*>", "<table>"), (r'(?i)<img\b[^>]*\bsrc\s*=\s*"([^"]+)"[^>]*>', r"![](\1)"), (r"(?i)<p\b[^>]*>|</p\s*>", ""), (r"\n{4,}", "\n\n\n"), (f"^{WS}+|{WS}+$", "")],
)


@query(f"SELECT path, {TIDIED_SQL} || chr(10) AS text FROM (SELECT url AS path, {MARKDOWN_SQL} AS md FROM pages)")
def html_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.import_pages(table(spark, sf_dir, "pages").select(F.col("url").alias("path"), "html"), convert=to_markdown)


@query(
    r"""WITH x AS (SELECT page_id AS id, html FROM pages UNION ALL SELECT 1000000 + n_nationkey, '<meta content="text/html; Charset = ' || CASE n_nationkey % 4 WHEN 0 THEN 'GB2312' WHEN 1 THEN 'gb_2312-80' WHEN 2 THEN 'Big5' ELSE '"gbk"' END || '">' FROM nation),
    y AS (SELECT id, lower(regexp_extract(left(html, 4096), '(?i)charset\s*=\s*([A-Za-z0-9_\-]+)', 1)) AS c FROM x)
    SELECT id, CASE WHEN c IN ('gb2312', 'gb_2312-80') THEN 'gbk' WHEN c = '' THEN 'utf-8' ELSE c END AS charset FROM y"""
)
def charset_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.element_at(F.array(F.lit("GB2312"), F.lit("gb_2312-80"), F.lit("Big5"), F.lit('"gbk"')), F.col("n_nationkey") % 4 + 1)
    made = table(spark, sf_dir, "nation").select((F.col("n_nationkey").cast("long") + 1000000).alias("id"), F.concat(F.lit('<meta content="text/html; Charset = '), name, F.lit('">')).alias("html"))
    both = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "html").unionByName(made)
    return both.select("id", html.charset(F.encode("html", "UTF-8")).alias("charset"))


DECODED = [(1, "中文", "gbk", "replace"), (2, "中文", "utf-8", "replace"), (3, "a�b", "utf-8", "replace"), (4, "ab", "utf-8", "ignore"), (5, "中文", "no-such-codec", "replace"), (6, "é", "latin-1", "strict")]
BYTES = ["d6d0cec4", "e4b8ade69687", "61ff62", "61ff62", "e4b8ade69687", "e9"]


@query(per_nation_sql([(i, "@ " + t) for i, t, _, _ in DECODED], "id", "text"))
def decode_charsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = per_nation(spark, sf_dir, [(i, b, n, e) for (i, _, n, e), b in zip(DECODED, BYTES, strict=True)], "id", "hex", "codec", "errors").withColumn("id", F.col("id").cast("long"))
    rows = rows.join(table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name"), "n_nationkey").withColumn("content", F.concat(F.encode(F.concat("n_name", F.lit(" ")), "UTF-8"), F.unhex("hex")))
    out = [rows.where(F.col("errors") == e).select("n_nationkey", "id", decode_as(F.col("content"), F.col("codec"), e).alias("text")) for e in ("replace", "ignore", "strict")]
    return out[0].unionByName(out[1]).unionByName(out[2])


# --- Markdown normalising

BLANK_SQL = r"replace(replace(text, '. ', '.' || repeat(chr(10), 5)), ', ', chr(13) || chr(10))"


@query(rf"SELECT doc_id, regexp_replace(regexp_replace(replace(chr(10) || {BLANK_SQL}, chr(13) || chr(10), chr(10)), '^\n+', ''), '\n{{4,}}', repeat(chr(10), 3), 'g') AS text FROM documents")
def md_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.concat(F.lit("\n"), F.replace(F.replace("text", F.lit(". "), F.lit(".\n\n\n\n\n")), F.lit(", "), F.lit("\r\n")))
    return table(spark, sf_dir, "documents").select("doc_id", html.normalise_markdown(made).alias("text"))


TIDY_SQL = """'  <DIV> ' || chr(10) || '<table border="1"><colgroup><col width=1></colgroup><tr><td><p class="c">' || n_name || '</P ></td></tr></table>' || chr(10) || '</div>' || chr(10) || '<div>kept</div>' || repeat(chr(10), 6) || '<img src="a" data-src="b">' || chr(10)"""


@query(
    rf"""SELECT n_nationkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    array_to_string(list_filter(string_split({TIDY_SQL}, chr(10)), lambda x: NOT regexp_matches(x, '(?i)^\s*</?div>\s*$')), chr(10)),
    '(?is)<colgroup\b.*?</colgroup\s*>', '', 'g'), '(?i)<col\b[^>]*>', '', 'g'), '(?i)<table\b[^>]*>', '<table>', 'g'), '(?i)<img\b[^>]*\bsrc\s*=\s*"([^"]+)"[^>]*>', '![](\1)', 'g'),
    '(?i)<p\b[^>]*>|</p\s*>', '', 'g'), '\n{{4,}}', repeat(chr(10), 3), 'g'), '^\s+|\s+$', '', 'g') || chr(10) AS text FROM nation"""
)
def md_github_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.concat(F.lit('  <DIV> \n<table border="1"><colgroup><col width=1></colgroup><tr><td><p class="c">'), "n_name", F.lit('</P ></td></tr></table>\n</div>\n<div>kept</div>\n\n\n\n\n\n<img src="a" data-src="b">\n'))
    return table(spark, sf_dir, "nation").select("n_nationkey", html.tidy_markdown(made).alias("text"))


PATH_SQL = "regexp_replace(url, '^[a-z]+://', '')"


@query(
    rf"""WITH x AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'Template/' WHEN 1 THEN 'a/B.files/HEADER.htm' WHEN 2 THEN 'x/y.hhc' WHEN 3 THEN '' ELSE {PATH_SQL} END || CASE WHEN page_id % 5 = 0 THEN {PATH_SQL} ELSE '' END AS path, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'data:image/png;x' WHEN 2 THEN 'a\TEMPLATE2\b.png' ELSE '//cdn/x.png' END AS src FROM pages)
    SELECT page_id, path = '' OR regexp_matches(lower(path), '^template2?(/|$)') OR regexp_matches(lower(path), '\.files/header\.htm$') OR regexp_matches(lower(path), '\.(hhc|hhk|wcp)$') AS skip,
    regexp_matches(lower(replace(src, '\', '/')), '(^|/)template2?/') AS nav, regexp_matches(replace(src, '\', '/'), '(?i)^((https?:)?//|data:)') AS external FROM x"""
)
def path_and_link_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    bare = F.regexp_replace("url", r"\A[a-z]+://", "")
    k, j = F.col("page_id") % 5, F.col("page_id") % 4
    path = F.when(k == 0, F.concat(F.lit("Template/"), bare)).when(k == 1, "a/B.files/HEADER.htm").when(k == 2, "x/y.hhc").when(k == 3, "").otherwise(bare)
    src = F.when(j == 0, F.col("url")).when(j == 1, "data:image/png;x").when(j == 2, "a\\TEMPLATE2\\b.png").otherwise("//cdn/x.png")
    made = p.select("page_id", path.alias("path"), src.alias("src"))
    return made.select("page_id", html.skip_path(F.col("path")).alias("skip"), html.nav_asset(F.col("src")).alias("nav"), html.external(F.col("src")).alias("external"))


# --- lines, headings, duplicates

LINES_SQL = r"string_split_regex(CASE WHEN regexp_matches(text, '[\n]$') THEN text[:-2] ELSE text END, '\n')"
TITLED_SQL = f"""SELECT 'docs/d' || (doc_id % 13) || '/t' || (doc_id % 211) || '.md' AS path0, doc_id, 'docs/d' || doc_id || '/t' || (doc_id % 211) || '.md' AS path,
    CASE WHEN doc_id % 11 = 0 THEN text ELSE '##  **Topic ' || (doc_id % 173) || '.** ' || chr(10) || chr(10) || '---' || chr(10) || CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END END AS text FROM documents"""
INFO_SQL = rf"""titled AS ({TITLED_SQL}), info AS (SELECT path, doc_id, 'Topic ' || (doc_id % 173) || '.' AS title, 2 AS title_level,
    list_filter(string_split(text, chr(10))[2:], lambda x: regexp_replace(x, '^{WS}+|{WS}+$', '', 'g') NOT IN ('', '---', '***', '___')) AS body FROM titled WHERE doc_id % 11 <> 0),
    described AS (SELECT path, doc_id, title, title_level, len(body) AS body_nonempty_lines, length(regexp_replace(array_to_string(body, chr(10)), '^{WS}+|{WS}+$', '', 'g')) AS body_chars, len(body) = 0 AS is_title_only FROM info)"""


def titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    head = F.concat(F.lit("##  **Topic "), (k % 173).cast("string"), F.lit(".** \n\n---\n"), F.when(k % 3 == 0, "").otherwise(F.col("text")))
    path = F.concat(F.lit("docs/d"), k.cast("string"), F.lit("/t"), (k % 211).cast("string"), F.lit(".md"))
    return table(spark, sf_dir, "documents").select(path.alias("path"), F.when(k % 11 == 0, F.col("text")).otherwise(head).alias("text"))


@query(f"WITH {INFO_SQL} SELECT path, title, CAST(title_level AS BIGINT) AS title_level, CAST(body_nonempty_lines AS BIGINT) AS body_nonempty_lines, CAST(body_chars AS BIGINT) AS body_chars, is_title_only FROM described")
def doc_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(documents.described(titled(spark, sf_dir)), "title_level", "body_nonempty_lines", "body_chars")


def groups_sql(key: str) -> str:
    return f"""WITH {INFO_SQL}, keyed AS (SELECT *, {key} AS key FROM described), g AS (SELECT key FROM keyed GROUP BY key HAVING count(*) >= 2 AND bool_or(is_title_only) AND NOT bool_and(is_title_only)),
    r AS (SELECT key, path, title, CASE WHEN is_title_only THEN 'title_only' ELSE 'has_content' END AS kind, CASE WHEN NOT is_title_only THEN row_number() OVER (PARTITION BY key, is_title_only ORDER BY -body_chars, path) END AS rank, CAST(body_nonempty_lines AS BIGINT) AS body_nonempty_lines, CAST(body_chars AS BIGINT) AS body_chars FROM keyed SEMI JOIN g USING (key))
    SELECT * FROM r WHERE kind = 'title_only' OR rank <= 10"""


@query(groups_sql("'topic' || (doc_id % 173)"))
def dupes_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(documents.by_title(documents.keyed(documents.described(titled(spark, sf_dir)))).drop("stem"), "rank", "body_nonempty_lines", "body_chars")


@query(groups_sql("'t' || (doc_id % 211)"))
def dupes_by_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(documents.by_stem(documents.keyed(documents.described(titled(spark, sf_dir)))).drop("stem"), "rank", "body_nonempty_lines", "body_chars")


def section_sql(section: str, key: str, name: str, head: list[str]) -> str:
    tops = " UNION ALL ".join(f"SELECT '{section}' AS section, 0 AS part, '' AS key, '' AS least_path, 0 AS block, {i} AS place, '' AS path, {x} AS line" for i, x in enumerate([*(f"'{h}'" for h in head), "'候选组数：' || (SELECT count(*) FROM g)", "''"]))
    return f"""SELECT * FROM (WITH rows AS ({groups_sql(key)}), g AS (SELECT key, min(CASE WHEN kind = 'title_only' THEN path END) AS least_path, arg_min({name}, CASE WHEN kind = 'title_only' THEN path END) AS name FROM rows GROUP BY key)
    {tops}
    UNION ALL SELECT '{section}', 1, key, least_path, b, p, '', CASE b + p WHEN 0 THEN '== ' || name || ' ==' WHEN 1 THEN 'title_only:' WHEN 2 THEN 'has_content:' ELSE '' END FROM g, (VALUES (0, 0), (0, 1), (2, 0), (4, 0)) f(b, p)
    UNION ALL SELECT '{section}', 1, key, least_path, CASE kind WHEN 'title_only' THEN 1 ELSE 3 END, coalesce(rank, 0), path, '- ' || path || CASE kind WHEN 'title_only' THEN '' ELSE '  (body_lines=' || body_nonempty_lines || ', body_chars=' || body_chars || ')' END FROM rows JOIN g USING (key))"""


STEM_SQL = "regexp_replace(string_split(path, '/')[-1], '\\.[^.]*$', '')"


DUPES_SQL = section_sql("A", "'topic' || (doc_id % 173)", "title", [jobs.DUPES_TITLE, "", jobs.DUPES_HEAD["A"], ""]) + " UNION ALL " + section_sql("B", "'t' || (doc_id % 211)", STEM_SQL, ["", jobs.DUPES_HEAD["B"], ""])


@query(f"SELECT section, CAST(part AS BIGINT) AS part, key, least_path, CAST(block AS BIGINT) AS block, CAST(place AS BIGINT) AS place, path, line FROM ({DUPES_SQL})")
def dupes_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(jobs.duplicate_report(titled(spark, sf_dir))[0], "part", "block", "place")


KEYS = [("**战 斗**：Ａ", "战斗a", "**战斗**a"), ("<b>Core</b> `Rules`!", "corerules", "<b>core</b>rules"), ("①　ﾊﾟ_x_", "1パx", "1パ_x_"), (" A·B • C ", "abc", "abc")]


@query(f"SELECT n_nationkey, title || n_name AS title, dupes_key || replace(lower(n_name), '_', '') AS dupes_key, toc_key || lower(n_name) AS toc_key FROM ({per_nation_sql(KEYS, 'title', 'dupes_key', 'toc_key')}) JOIN (SELECT n_nationkey, n_name FROM nation) USING (n_nationkey)")
def title_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = per_nation(spark, sf_dir, [(k[0] + "@",) for k in KEYS], "title")
    return rows.select("n_nationkey", "title", md.title_key(F.col("title")).alias("dupes_key"), md.toc_key(F.col("title")).alias("toc_key"))


@query(f"SELECT path FROM ({TITLED_SQL}) WHERE doc_id % 11 = 0")
def audit_no_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.without_heading(titled(spark, sf_dir))


@query("SELECT url AS path FROM (SELECT url, CASE WHEN page_id % 2 = 0 THEN regexp_replace(html, '<[^>]*>', '', 'g') ELSE html END AS t FROM pages) WHERE regexp_matches(t, '</?[A-Za-z][^>]*>')")
def audit_html_residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = F.when(F.col("page_id") % 2 == 0, F.regexp_replace("html", "<[^>]*>", "")).otherwise(F.col("html"))
    return documents.with_markup(table(spark, sf_dir, "pages").select(F.col("url").alias("path"), some.alias("text")))


# --- table of contents

TOC_SQL = """toc AS (SELECT row_number() OVER (ORDER BY n_regionkey, n_nationkey) AS toc_idx, 1 + n_nationkey % 3 AS level,
    CASE WHEN n_nationkey % 4 = 3 THEN n_name ELSE CASE n_nationkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '2.' || n_regionkey ELSE '3.1.' END || ' ' || n_name END AS title, 10 + n_nationkey AS page FROM nation),
    docs AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'docs/' WHEN s_suppkey % 3 = 1 THEN 'docs/核心规则/' ELSE 'other/' END || 's' || s_suppkey || '.md' AS path, 's' || s_suppkey AS stem, CASE WHEN s_suppkey % 10 = 0 THEN '1 ' || n_name ELSE lower(n_name) || '!' END || CASE WHEN s_nationkey % 6 = 5 THEN ' other' ELSE '' END AS title FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    keys AS (SELECT path, regexp_replace(lower(title), '[\\s!.]+', '', 'g') AS key FROM docs UNION SELECT path, stem FROM docs),
    asked AS (SELECT toc_idx, 0 AS priority, title, regexp_replace(lower(regexp_replace(title, '^\\d+(\\.\\d+)*\\.?\\s+', '')), '[\\s!.]+', '', 'g') AS key FROM toc UNION ALL SELECT toc_idx, 1, title, regexp_replace(lower(title), '[\\s!.]+', '', 'g') FROM toc),
    hits AS (SELECT toc_idx, path, priority, title, min(priority) OVER (PARTITION BY toc_idx) AS least FROM asked JOIN keys USING (key)),
    rooted AS (SELECT DISTINCT toc_idx, path, coalesce(starts_with(path, CASE split_part(regexp_extract(title, '^(\\d+(\\.\\d+)*)\\.?\\s', 1), '.', 1) WHEN '1' THEN 'docs/' WHEN '2' THEN 'docs/核心规则/' END), false) AS inside FROM hits WHERE priority = least),
    kept AS (SELECT * FROM (SELECT *, bool_or(inside) OVER (PARTITION BY toc_idx) AS has_inside FROM rooted) WHERE inside OR NOT has_inside),
    ranked AS (SELECT toc_idx, path, row_number() OVER (PARTITION BY toc_idx ORDER BY length(path), path) AS rank FROM kept),
    matched AS (SELECT t.toc_idx, t.level, t.title, t.page, coalesce(r.rank, 1) AS rank, r.path FROM toc t LEFT JOIN ranked r ON t.toc_idx = r.toc_idx AND r.rank <= 3)""".replace("\\\\", "\\")


def toc_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from pyspark.sql import Window

    nation = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey") % 4
    number = F.when(k == 0, "1").when(k == 1, F.concat(F.lit("2."), F.col("n_regionkey").cast("string"))).otherwise("3.1.")
    title = F.when(k == 3, F.col("n_name")).otherwise(F.concat(number, F.lit(" "), "n_name"))
    # 25 rows, and 25 at any scale
    toc = nation.select(F.row_number().over(Window.orderBy("n_regionkey", "n_nationkey")).alias("toc_idx"), (F.col("n_nationkey") % 3 + 1).alias("level"), title.alias("title"), (F.col("n_nationkey") + 10).alias("page"))
    s = F.col("s_suppkey")
    folder = F.when(s % 3 == 0, "docs/").when(s % 3 == 1, "docs/核心规则/").otherwise("other/")
    joined = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    title = F.concat(F.when(s % 10 == 0, F.concat(F.lit("1 "), "n_name")).otherwise(F.concat(F.lower("n_name"), F.lit("!"))), F.when(F.col("s_nationkey") % 6 == 5, " other").otherwise(""))
    docs = joined.select(F.concat(folder, F.lit("s"), s.cast("string"), F.lit(".md")).alias("path"), title.alias("title"))
    return toc, docs


@query(f"WITH {TOC_SQL} SELECT CAST(toc_idx AS BIGINT) AS toc_idx, CAST(level AS BIGINT) AS level, title, CAST(page AS BIGINT) AS page, CAST(rank AS BIGINT) AS rank, path FROM matched")
def toc_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(contents.match(*toc_inputs(spark, sf_dir)), "toc_idx", "level", "page", "rank")


@query(f"WITH {TOC_SQL} SELECT CAST(toc_idx AS BIGINT) AS toc_idx, CAST(level AS BIGINT) AS level, title, CAST(page AS BIGINT) AS page FROM matched WHERE path IS NULL")
def toc_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(contents.unmatched(*toc_inputs(spark, sf_dir)), "toc_idx", "level", "page")


@query(
    f"""WITH {TOC_SQL}, links AS (SELECT toc_idx, level, title, page, string_agg('[`docs/' || regexp_replace(path, '^docs/', '') || '`](' || regexp_replace(path, '^docs/', '') || ')', ', ' ORDER BY rank) AS links FROM matched GROUP BY ALL)
    SELECT CAST(toc_idx AS BIGINT) AS toc_idx, repeat('  ', greatest(level - 1, 0)) || '- **' || title || '**（[P' || printf('%03d', page) || '](../assets/pdf_pages_small/page_' || printf('%03d', page) || '.jpg)） → ' || coalesce(links, '（未匹配）') AS line FROM links"""
)
def toc_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(contents.report_lines(contents.match(*toc_inputs(spark, sf_dir))), "toc_idx")


@query("SELECT CAST(o_orderkey AS BIGINT) AS toc_idx, (o_orderkey % 4) || chr(9) || o_custkey || chr(9) || o_orderpriority || chr(9) || o_orderpriority AS line FROM orders ORDER BY o_orderkey LIMIT 50")
def toc_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contents.sample(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("toc_idx"), (F.col("o_orderkey") % 4).alias("level"), F.col("o_custkey").alias("page"), F.col("o_orderpriority").alias("title")))


# --- tables


@query(
    """WITH l AS (SELECT l_orderkey AS k, l_partkey, l_suppkey, l_returnflag, l_linestatus, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_quantity, l_extendedprice) AS n FROM lineitem)
    SELECT k AS l_orderkey, '| part | supp\\|ier |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || l_partkey || '<br>' || l_returnflag || ' | ' || CASE WHEN l_linestatus = 'O' THEN ' ' ELSE '**' || l_suppkey || '**' END || ' |', chr(10) ORDER BY n) || chr(10) AS text, CAST(1 AS BIGINT) AS tables_found, CAST(1 AS BIGINT) AS tables_converted FROM l GROUP BY k"""
)
def table_to_pipe(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.concat(F.lit("<tr><td>"), F.col("l_partkey").cast("string"), F.lit("<br>"), "l_returnflag", F.lit("</td><td>"), F.when(F.col("l_linestatus") == "O", "").otherwise(F.concat(F.lit("<strong>"), F.col("l_suppkey").cast("string"), F.lit("</strong>"))), F.lit("</td></tr>"))
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", cell.alias("cell"))
    made = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(order)).alias("rows"))
    text = F.concat(F.lit("<table><thead><tr><th>part</th><th>supp|ier</th></tr></thead>"), F.array_join("rows.cell", ""), F.lit("</table>"))
    return longs(tables.replace_tables(made.select("l_orderkey", text.alias("text")), strict=True), "tables_found", "tables_converted")


SPANS = [
    (1, '<table><tr><th>A</th><th>B</th></tr><tr><td rowspan="2">x@</td><td>1</td></tr><tr><td>2</td></tr></table>', "| A | B |\n| --- | --- |\n| x@ | 1 |\n| x@ | 2 |\n"),
    (2, '<table><tr><th>a</th><th>b</th><th>c</th></tr><tr><td>1</td><td>2</td><td rowspan="2">S</td></tr><tr><td>3</td></tr><tr><td>4</td><td>5</td></tr></table>', "**3**\n\n| a | b | c |\n| --- | --- | --- |\n| 1 | 2 | S |\n| 4 | 5 | S |\n"),
    (3, '<TABLE border=1><tr><td colspan="2">T</td></tr><tr><td>a<br>b</td><td> c|d </td></tr></TABLE >', "**T**\n\n| a<br>b | c\\|d |\n| --- | --- |\n"),
    (4, '<table><tr><td colspan="2">T</td></tr><tr><td>U<td></table>', "**T**\n\n**U**\n"),
    (5, '<table><tr><td rowspan="2" colspan="2">M</td><td>1</td></tr><tr><td>2</td></tr><tr><td colspan="x">p<td>q<td>r</table>', "| M | M | 1 |\n| --- | --- | --- |\n| M | M | 2 |\n| p | q | r |\n"),
    (6, "no table @", "no table @"),
]


@query(per_nation_sql([(i, t) for i, _, t in SPANS], "case_id", "text"))
def table_span_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(tables.replace_tables(per_nation(spark, sf_dir, [(i, h) for i, h, _ in SPANS], "case_id", "text")).select("n_nationkey", "case_id", "text"), "case_id")


STRICT = [
    (1, "<table><tr><td></td><td></td></tr><tr><td>h<br>1</td><td>a|b</td></tr><tr><td><strong>z @</strong></td></tr></table>", "| h<br>1 | a\\|b |\n| --- | --- |\n| **z @** |   |\n"),
    (2, "<table><tr><td>a</tr></table>", "<table><tr><td>a</tr></table>"),
    (3, '<table class="x"><tr><td>a</td></tr></table>', '<table class="x"><tr><td>a</td></tr></table>'),
    (4, "<TABLE><tr><td>a</td></tr></TABLE>", "<TABLE><tr><td>a</td></tr></TABLE>"),
    (5, "x <table><tr><td>a</td></tr></table> y <table><tr><td>b&nbsp;c</td></tr></table>", "x | a |\n| --- |\n y | b c |\n| --- |\n"),
]


@query(per_nation_sql([(i, t) for i, _, t in STRICT], "case_id", "text"))
def table_strict_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(tables.replace_tables(per_nation(spark, sf_dir, [(i, h) for i, h, _ in STRICT], "case_id", "text"), strict=True).select("n_nationkey", "case_id", "text"), "case_id")


@query(
    """SELECT 'n' || n_nationkey AS path, n_name || chr(10) || '|**等级**|**1**|**2**|**3**|' || chr(10) || '|------|---|---|' || chr(10) || '|**经历点**|' || n_nationkey || '|1|2|'
    || CASE WHEN n_nationkey % 2 = 0 THEN chr(10) || chr(10) || '|**等级**|**11**|**12**|' || chr(10) || '|------|---|' || chr(10) || '|**经历点**|7|' || n_regionkey || '|' ELSE '' END || chr(10) || '**等级**' || chr(10) || '**经历点** 5' AS text FROM nation"""
)
def level_table_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, r = F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string")
    text = F.concat("n_name", F.lit("\n **等级** \n**经历点** "), k, F.lit(" 1 2"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("\n**等级**\n**经历点** 7 "), r)).otherwise(""), F.lit("\n**等级**\n**经历点** 5"))
    docs = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), k).alias("path"), text.alias("text"))
    return docs.withColumn("text", repair.level_tables(F.col("text"), compat=True))


TIER_IN = "前 @\n**期望** **攻击** **招架**\n**传闻** 6.5 +1光\n**怪谈** 12 x50% 升半阶\n\n**期望** **攻击** 1"
TIER_OUT = "前 @\n|期望|攻击|招架|\n|---|---|---|\n|传闻|6.5|1|+1光|\n|怪谈|12|50|x50%|升半阶|\n\n**期望** **攻击** 1"


@query(f"SELECT path, text FROM ({per_nation_sql([('@.md', TIER_OUT)], 'path', 'text')})")
def tier_table_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = per_nation(spark, sf_dir, [("@.md", TIER_IN)], "path", "text")
    return docs.select("path", repair.tier_tables(F.col("text"), compat=True).alias("text"))


#: Lines that lost their tables, behind every document's text; @ is its number.
LOST = "\n **等级** \n**经历点** @ 1 2\n**等级**\n**经历点** 7 @\n**等级**\n**经历点** 3 @ 5\n**经历点** 5\n前 **期望**\n**期望** **攻击** **招架** @\n**传闻** 6.5 +@光\n**传闻**\n\n**期望** **攻击** 1"
MADE = "\n|**等级**|**1**|**2**|**3**|\n|------|---|---|\n|**经历点**|@|1|2|\n\n|**等级**|**11**|**12**|\n|------|---|\n|**经历点**|7|@|\n|**等级**|**1**|**2**|**3**|\n|------|---|---|\n|**经历点**|3|@|5|\n**经历点** 5\n前 **期望**\n|期望|攻击|招架|@|\n|---|---|---|---|\n|传闻|6.5|@|+@光|\n\n**期望** **攻击** 1"


@query(f"SELECT doc_id, text || replace('{MADE}', '@', CAST(doc_id AS VARCHAR)) AS text FROM documents")
def repairs_in_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = F.replace(F.lit(LOST), F.lit("@"), F.col("doc_id").cast("string"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", lost).alias("text"))
    return docs.select("doc_id", repair.tier_tables(repair.level_tables(F.col("text"), compat=True), compat=True).alias("text"))


REPAIRED = {"NATION_1.md": "level", "NATION_2.md": "tier", "NATION_3.md": "level", "NOWHERE.md": "tier"}


@query(
    """SELECT n_name || '.md' AS path, CASE n_name WHEN 'NATION_1' THEN '|**等级**|**1**|**2**|' || chr(10) || '|------|---|' || chr(10) || '|**经历点**|' || n_nationkey || '|2|' WHEN 'NATION_3' THEN n_name ELSE '**等级**' || chr(10) || '**经历点** ' || n_nationkey || ' 2' END AS text,
    CASE n_name WHEN 'NATION_1' THEN 'ok' ELSE 'unchanged' END AS status FROM nation WHERE n_name IN ('NATION_1', 'NATION_2', 'NATION_3') UNION ALL SELECT 'NOWHERE.md', NULL, 'missing'"""
)
def repair_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("n_name") == "NATION_3", F.col("n_name")).otherwise(F.concat(F.lit("**等级**\n**经历点** "), F.col("n_nationkey").cast("string"), F.lit(" 2")))
    return repair.repaired(table(spark, sf_dir, "nation").select(F.concat("n_name", F.lit(".md")).alias("path"), text.alias("text")), REPAIRED)


# --- work lists, renames, assets

@query("SELECT n_regionkey AS list_id, CAST(2 * rn AS BIGINT) AS line_no, 'docs/' || n_name || '.md' AS path FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1 AS rn FROM nation) WHERE n_nationkey % 3 <> 0")
def checklist_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.concat(F.lit("- ["), F.when(F.col("n_nationkey") % 3 == 0, "x").otherwise(" "), F.lit("] `docs/"), "n_name", F.lit(".md` \r\n"))
    lists = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("list_id")).agg(F.array_join(F.array_sort(F.collect_list(F.struct("n_name", item.alias("item"))))["item"], "\n").alias("text"))
    return longs(checklist.pending(lists), "line_no")


DONE = [(1, "# L\n- [ ] `docs/a.md`\n", "# L\n- [x] `docs/a.md`\n\n### 已完成\n\n- `docs/a.md`：N\n"), (2, "- [ ] `docs/a.md`\n- [ ] `docs/a.md`\n### 已完成\n\n- x", "- [x] `docs/a.md`\n- [ ] `docs/a.md`\n### 已完成\n\n- x\n\n- `docs/a.md`：N\n"), (3, "", "\n### 已完成\n\n- `docs/a.md`：N\n")]


@query(per_nation_sql([(i, t.replace("a.md", "@.md")) for i, _, t in DONE], "case_id", "text"))
def checklist_mark_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = per_nation(spark, sf_dir, [(i, t.replace("a.md", "@.md"), "docs/@.md") for i, t, _ in DONE], "case_id", "text", "path")
    return longs(rows.select("n_nationkey", "case_id", checklist.mark_done(F.col("text"), F.col("path"), F.lit("N")).alias("text")), "case_id")


@query(
    """WITH r AS (SELECT 'docs/' || n_name || '.md' AS src, 'docs/new/' || n_name || '.md' AS dst, n_nationkey FROM nation), f AS (SELECT src AS path FROM r WHERE n_nationkey % 3 <> 0 UNION SELECT dst FROM r WHERE n_nationkey % 5 = 0),
    o AS (SELECT src, dst, CASE WHEN src NOT IN (SELECT path FROM f) THEN 'missing' WHEN dst IN (SELECT path FROM f) THEN 'exists' ELSE 'renamed' END AS outcome FROM r)
    SELECT src, dst, outcome, outcome || ': ' || CASE outcome WHEN 'exists' THEN dst WHEN 'missing' THEN src ELSE src || ' -> ' || dst END AS line FROM o"""
)
def rename_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "nation").select(F.concat(F.lit("docs/"), "n_name", F.lit(".md")).alias("src"), F.concat(F.lit("docs/new/"), "n_name", F.lit(".md")).alias("dst"), "n_nationkey")
    listing = r.where("n_nationkey % 3 <> 0").select(F.col("src").alias("path")).unionByName(r.where("n_nationkey % 5 = 0").select(F.col("dst").alias("path")))
    return assets.rename_plan(r.select("src", "dst"), listing)


IMAGES_SQL = "images AS (SELECT doc_id // 10 AS page, doc_id % 10 AS idx, text AS content FROM documents)"


def image_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 10).alias("page"), (F.col("doc_id") % 10).alias("idx"), F.encode("text", "UTF-8").alias("content"))


@query(f"WITH {IMAGES_SQL}, r AS (SELECT page, idx, sha1(content) AS sha1, row_number() OVER (PARTITION BY sha1(content) ORDER BY page, idx) AS n FROM images WHERE octet_length(encode(content)) >= 100) SELECT CAST(page AS BIGINT) AS page, CAST(idx AS BIGINT) AS idx, sha1 FROM r WHERE n = 1")
def content_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(assets.keep_first(image_rows(spark, sf_dir), 100).select("page", "idx", "sha1"), "page", "idx")


@query(f"WITH {IMAGES_SQL}, b AS (SELECT octet_length(encode(content)) < 100 AS small, sha1(content) AS s FROM images) SELECT count(DISTINCT CASE WHEN NOT small THEN s END) AS extracted, count(*) FILTER (WHERE NOT small) - count(DISTINCT CASE WHEN NOT small THEN s END) AS skipped_dupe, count(*) FILTER (WHERE small) AS skipped_small FROM b")
def image_extraction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assets.extraction_counts(image_rows(spark, sf_dir), 100)


@query("SELECT p_partkey, printf('page_%03d_img_%02d.%s', p_partkey, p_size, CASE p_partkey % 3 WHEN 0 THEN 'jpg' WHEN 1 THEN 'bin' ELSE 'png' END) AS name FROM part")
def image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    return table(spark, sf_dir, "part").select("p_partkey", assets.image_name(F.col("p_partkey"), F.col("p_size"), F.when(k == 0, "JPEG").when(k == 2, "Png")).alias("name"))


@query(
    """SELECT p_partkey, CAST(greatest(1, s) AS BIGINT) AS first, CAST(least(CASE WHEN e <> 0 AND e >= greatest(1, s) THEN e ELSE n END, n) AS BIGINT) AS last, CASE WHEN w > 0 THEN least(240.0 / w, 4.0) ELSE 1.0 END AS scale
    FROM (SELECT p_partkey, p_size % 13 AS s, p_partkey % 17 AS e, 10 AS n, CAST(p_partkey % 100 AS DOUBLE) AS w FROM part)"""
)
def page_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = assets.pages_between(F.col("p_size") % 13, (F.col("p_partkey") % 17).cast("int"), F.lit(10))
    return table(spark, sf_dir, "part").select("p_partkey", first.cast("long").alias("first"), last.cast("long").alias("last"), assets.scale((F.col("p_partkey") % 100).cast("double"), F.lit(240.0)).alias("scale"))


PAGES_SQL = """'<p><img src="img/' || n_name || '.png"><IMG alt="a" src="..\\up\\' || n_regionkey || '.GIF"><img src="https://x/y.png"><img src="template/n.png"><img src="img/none.png"><img src="img/t.txt"></p>'"""


def image_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    n = table(spark, sf_dir, "nation")
    page = F.concat(F.lit('<p><img src="img/'), "n_name", F.lit('.png"><IMG alt="a" src="..\\up\\'), F.col("n_regionkey").cast("string"), F.lit('.GIF"><img src="https://x/y.png"><img src="template/n.png"><img src="img/none.png"><img src="img/t.txt"></p>'))
    pages = n.select(F.concat(F.lit("a/b"), F.col("n_nationkey").cast("string"), F.lit("/p.htm")).alias("path"), page.alias("html"))
    folder = F.concat(F.lit("a/b"), F.col("n_nationkey").cast("string"), F.lit("/"))
    listing = n.select(F.explode(F.array(F.concat(folder, F.lit("img/"), "n_name", F.lit(".png")), F.concat(F.lit("a/up/"), F.col("n_regionkey").cast("string"), F.lit(".GIF")), F.concat(folder, F.lit("img/t.txt")))).alias("path"))
    return pages, listing


@query(
    """SELECT 'a/b' || n_nationkey || '/p.htm' AS path, CAST(0 AS BIGINT) AS pos, 'img/' || n_name || '.png' AS src, 'a/b' || n_nationkey || '/img/' || n_name || '.png' AS file, 'assets/chm/a/b' || n_nationkey || '/img/' || n_name || '.png' AS destination, '../../assets/chm/a/b' || n_nationkey || '/img/' || n_name || '.png' AS link FROM nation
    UNION ALL SELECT 'a/b' || n_nationkey || '/p.htm', 1, '..\\up\\' || n_regionkey || '.GIF', 'a/up/' || n_regionkey || '.GIF', 'assets/chm/a/up/' || n_regionkey || '.GIF', '../../assets/chm/a/up/' || n_regionkey || '.GIF' FROM nation""".replace("\\\\", "\\")
)
def asset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(assets.copy_plan(*image_pages(spark, sf_dir)), "pos")


@query(
    """SELECT 'a/b' || n_nationkey || '/p.htm' AS path, '<p><img src="../../assets/chm/a/b' || n_nationkey || '/img/' || n_name || '.png"><IMG alt="a" src="../../assets/chm/a/up/' || n_regionkey || '.GIF"><img src="https://x/y.png"><img src="template/n.png"><img src="img/none.png"><img src="img/t.txt"></p>' AS html FROM nation"""
)
def asset_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, listing = image_pages(spark, sf_dir)
    return assets.rewrite_links(pages, assets.copy_plan(pages, listing))


@query("SELECT count(*) AS documents, CAST(sum(CASE page_id % 3 WHEN 0 THEN 0 ELSE page_id % 3 END) AS BIGINT) AS tables_found, CAST(sum(CASE page_id % 3 WHEN 0 THEN 0 ELSE page_id % 3 END) AS BIGINT) AS tables_converted, count(*) FILTER (WHERE page_id % 3 > 0) AS changed FROM pages")
def etl_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.repeat(F.concat(F.lit("<TABLE a=b><tr><td>"), "url", F.lit("<td>y</table>\n")), (F.col("page_id") % 3).cast("int"))
    return jobs.metrics(table(spark, sf_dir, "pages").select(F.col("url").alias("path"), F.concat(F.regexp_replace("html", "(?i)<table", "<x"), found).alias("text")))


# --- files: written to a small tree and read back


def tree(spark: SparkSession, sf_dir: str) -> str:
    """A tree of files by nation: docs/<region>/<name>.md with a faulty byte and mixed line ends, a readme and another file beside it."""
    root = work_folder(spark)
    n = table(spark, sf_dir, "nation")
    folder = F.concat(F.lit("docs/"), F.col("n_regionkey").cast("string"), F.lit("/"))
    body = F.concat(F.encode(F.concat("n_name", F.lit("\r\n")), "UTF-8"), F.when(F.col("n_nationkey") % 2 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit(""))), F.encode(F.lit("\rx"), "UTF-8"))
    for name, suffix in (("n_name", ".md"), ("n_name", ".txt"), (F.concat(F.lit("x"), F.col("n_nationkey").cast("string"), F.lit("/README")), ".md")):
        sinks.write_tree(n.select(F.concat(folder, name, F.lit(suffix)).alias("path"), body.alias("text")), root)
    return root


TREE_SQL = "SELECT 'docs/' || n_regionkey || '/' || n_name || '.md' AS path, n_name || chr(10) || CASE WHEN n_nationkey % 2 = 0 THEN {} ELSE '' END || chr(10) || 'x' AS text FROM nation"


@query(TREE_SQL.format("'�'"))
def tree_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.markdown(spark, tree(spark, sf_dir), only="docs/", without=["README.md"])


@query(TREE_SQL.format("''"))
def tree_markdown_ignoring_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.markdown(spark, tree(spark, sf_dir), "ignore", without=["README.md"])


@query("SELECT 'docs/' || n_regionkey || '/' || CASE k WHEN 0 THEN n_name || '.md' WHEN 1 THEN n_name || '.txt' ELSE 'x' || n_nationkey || '/README.md' END AS path FROM nation, range(3) r(k)")
def tree_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.listing(spark, tree(spark, sf_dir))


@query("SELECT n_name || '.md' AS path, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE lower(n_name) END AS text FROM nation")
def tree_strict_and_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts written, every other one changed and written again, read strictly."""
    root, n = work_folder(spark), table(spark, sf_dir, "nation")
    path = F.concat("n_name", F.lit(".md")).alias("path")
    sinks.write_tree(n.select(path, F.col("n_name").alias("text")), root)
    sinks.write_changed(n.select(path, F.col("n_name").alias("old"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(F.lower("n_name")).alias("text")), root)
    return files.markdown(spark, root, "strict")


@query("""SELECT 'a/' || n_name || '.md' AS path, '中' || n_name || chr(10) || chr(10) || '![](../assets/chm/a/i/' || n_name || '.PNG)' || chr(10) AS text FROM nation UNION ALL SELECT 'assets/chm/a/i/' || n_name || '.PNG', CASE WHEN n_nationkey = 3 THEN 'there before' ELSE 'png ' || n_name END FROM nation""")
def tree_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export in another charset imported, with its images but for one that is there already."""
    root, n = work_folder(spark), table(spark, sf_dir, "nation")
    page = F.concat(F.lit("<html><head><meta charset=gb2312></head><body><p>"), F.lit("@"), "n_name", F.lit('</p><p><img src="i/'), "n_name", F.lit('.PNG"></p></body></html>'))
    # the sign in gbk
    cut = F.split(page, "@")
    made = F.concat(F.encode(F.get(cut, F.lit(0)), "UTF-8"), F.unhex(F.lit("D6D0")), F.encode(F.get(cut, F.lit(1)), "UTF-8"))
    image = F.concat(F.lit("i/"), "n_name", F.lit(".PNG"))
    sinks.write_tree(n.select(F.concat(F.lit("a/"), "n_name", F.lit(".htm")).alias("path"), made.alias("text")), f"{root}/in")
    sinks.write_tree(n.select(F.concat(F.lit("a/"), image).alias("path"), F.concat(F.lit("png "), "n_name").alias("text")), f"{root}/in")
    sinks.write_tree(n.select(F.lit("template/t.htm").alias("path"), F.lit("no page").alias("text")).limit(1), f"{root}/in")
    sinks.write_tree(n.where("n_nationkey = 3").select(F.concat(F.lit("assets/chm/a/"), image).alias("path"), F.lit("there before").alias("text")), f"{root}/out")
    jobs.import_tree(spark, f"{root}/in", f"{root}/out", "assets/chm")
    return files.scan(spark, f"{root}/out").select("path", files.text_of(F.col("content")).alias("text"))


@query("SELECT 'report.txt' AS path, string_agg(n_name, chr(10) ORDER BY n_regionkey, n_nationkey) || chr(10) AS text FROM nation UNION ALL SELECT 'new/' || n_name || '.md', n_name FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT 'old/' || n_name || '.md', n_name FROM nation WHERE n_nationkey % 3 <> 0")
def tree_report_and_renames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cleaned tree with a report in order, and some files renamed."""
    root, n = work_folder(spark), table(spark, sf_dir, "nation")
    sinks.write_tree(n.select(F.lit("gone.md").alias("path"), F.col("n_name").alias("text")).limit(1), root)
    sinks.clean(spark, root)
    sinks.write_tree(n.select(F.concat(F.lit("old/"), "n_name", F.lit(".md")).alias("path"), F.col("n_name").alias("text")), root)
    sinks.write_report(n.select("n_regionkey", "n_nationkey", F.col("n_name").alias("line")), f"{root}/report.txt", ["n_regionkey", "n_nationkey"])
    wish = n.where("n_nationkey % 3 = 0").select(F.concat(F.lit("old/"), "n_name", F.lit(".md")).alias("src"), F.concat(F.lit("new/"), "n_name", F.lit(".md")).alias("dst"))
    sinks.apply_renames(assets.rename_plan(wish, files.listing(spark, root)), root)
    return files.scan(spark, root).select("path", files.text_of(F.col("content")).alias("text"))


@query(
    """WITH p AS (SELECT page_id, page_id % 3 AS k, 'p' || page_id || '.md' AS path FROM pages) SELECT path, 'x' || page_id || CASE k WHEN 0 THEN '' WHEN 1 THEN '| ' || page_id || ' |' || chr(10) || '| --- |' || chr(10) ELSE '<table><tr><td>1</tr></table>' END || chr(10) || 'y' AS text FROM p
    UNION ALL SELECT 'counts', count(*) || ' ' || count(*) FILTER (WHERE k > 0) || ' ' || count(*) FILTER (WHERE k = 1) || ' ' || count(*) FILTER (WHERE k = 1) FROM p"""
)
def tree_tables_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each page, their strict tables converted in place, and the counts of that job."""
    root, pages = work_folder(spark), table(spark, sf_dir, "pages")
    k, number = F.col("page_id") % 3, F.col("page_id").cast("string")
    cell = F.when(k == 1, F.concat(F.lit("<table><tr><td>"), number, F.lit("</td></tr></table>"))).when(k == 2, "<table><tr><td>1</tr></table>").otherwise("")
    sinks.write_tree(pages.select(F.concat(F.lit("p"), number, F.lit(".md")).alias("path"), F.concat(F.lit("x"), number, cell, F.lit("\r\ny")).alias("text")), root)
    counts = jobs.convert_tables(spark, root)
    told = " ".join(str(counts[c]) for c in ("documents", "tables_found", "tables_converted", "changed"))
    return files.markdown(spark, root).unionByName(spark.createDataFrame([("counts", told)], "path string, text string"))


@query(
    f"""SELECT 'docs/' || n_name || '.md' AS path, CASE WHEN n_nationkey % 2 = 0 THEN '| ' || n_name || ' | 1 |' || chr(10) || '| --- | --- |' || chr(10) ELSE n_name END AS text FROM nation UNION ALL
    SELECT 'todo.md', string_agg('- [x] `docs/' || n_name || '.md`', chr(10) ORDER BY n_name) || chr(10) || chr(10) || '### 已完成' || chr(10) || chr(10) || string_agg('- `docs/' || n_name || '.md`：' || CASE WHEN n_nationkey % 2 = 0 THEN '{jobs.REBUILT.format(1)}' ELSE '{jobs.NOTHING}' END, chr(10) || chr(10) ORDER BY n_name) || chr(10) FROM nation"""
)
def rebuild_checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents on a work list rebuilt in place, and the list ticked."""
    root, n = work_folder(spark), table(spark, sf_dir, "nation")
    text = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("<table><tr><td>"), "n_name", F.lit("<td>1</table>"))).otherwise(F.col("n_name"))
    path = F.concat(F.lit("docs/"), "n_name", F.lit(".md"))
    sinks.write_tree(n.select(path.alias("path"), text.alias("text")), root)
    items = F.transform(F.array_sort(F.collect_list(path)), lambda p: F.concat(F.lit("- [ ] `"), p, F.lit("`")))
    sinks.write_tree(n.agg(F.array_join(items, "\n").alias("text")).select(F.lit("todo.md").alias("path"), F.concat("text", F.lit("\n")).alias("text")), root)
    jobs.rebuild_checklist(spark, root, "todo.md")
    return files.markdown(spark, root)


@query("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, 'see `docs/new/' || n_name || '.md`, not docs/old/' || n_name || '.md' AS text FROM nation")
def renamed_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    pairs = tuple((f"docs/old/{r.n_name}.md", f"docs/new/{r.n_name}.md") for r in n.select("n_name").collect())  # 25 at any scale
    text = F.concat(F.lit("see `docs/old/"), "n_name", F.lit(".md`, not docs/old/"), "n_name", F.lit(".md"))
    return n.select(F.col("n_nationkey").cast("long").alias("n_nationkey"), assets.renamed_references(text, pairs).alias("text"))


@query("SELECT p_partkey, CAST(page AS BIGINT) AS page, CAST(idx AS BIGINT) AS idx, 'i' || idx AS image FROM (SELECT p_partkey, unnest(range(1, p_size % 4 + 1)) AS page FROM part), range(1, 3) r(idx)")
def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = files.page_numbers(table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 4).alias("n_pages")))
    rows = files.page_images(numbered.select("p_partkey", "page", F.array(F.lit("i1"), F.lit("i2")).alias("images")))
    return longs(rows, "page", "idx")


def lines_sql(section: int, lines: tuple[str, ...], source: str = "") -> str:
    return " UNION ALL ".join(f"SELECT {section} AS section, {i - len(lines)} AS idx, '{x.format(source)}' AS line" for i, x in enumerate(lines))


@query(
    f"""WITH {TOC_SQL}, links AS (SELECT toc_idx, level, title, page, string_agg('[`docs/' || regexp_replace(path, '^docs/', '') || '`](' || regexp_replace(path, '^docs/', '') || ')', ', ' ORDER BY rank) AS links FROM matched GROUP BY ALL),
    p AS (SELECT *, '**（[P' || printf('%03d', page) || '](../assets/pdf_pages_small/page_' || printf('%03d', page) || '.jpg)）' AS place FROM links),
    r AS (SELECT 1 AS section, toc_idx AS idx, repeat('  ', greatest(level - 1, 0)) || '- **' || title || place || ' → ' || coalesce(links, '（未匹配）') AS line FROM p UNION ALL SELECT 2, toc_idx, '- **' || title || place FROM p WHERE links IS NULL
    UNION ALL {lines_sql(1, jobs.MAP_HEAD, 'x.pdf')} UNION ALL SELECT * FROM ({lines_sql(2, jobs.MAP_MISSING)}) WHERE EXISTS (SELECT 1 FROM p WHERE links IS NULL))
    SELECT CAST(section AS BIGINT) AS section, CAST(idx AS BIGINT) AS idx, line FROM r"""
)
def chapter_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    toc, docs = toc_inputs(spark, sf_dir)
    return longs(jobs.chapter_map(toc, docs.select("path", F.concat(F.lit("\n# "), "title", F.lit("\ntext")).alias("text")), "x.pdf"), "section", "idx")


@query(f"WITH {TOC_SQL} SELECT (SELECT count(*) FROM toc) AS toc_items, (SELECT count(*) FROM docs) AS md_files, (SELECT count(*) FROM matched WHERE path IS NULL) AS unmatched")
def chapter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    toc, docs = toc_inputs(spark, sf_dir)
    return jobs.chapter_counts(toc, docs.select("path", F.concat(F.lit("# "), "title").alias("text")))


@query(f"SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(list_filter(l, lambda x: regexp_replace(x, '^{WS}+|{WS}+$', '', 'g') NOT IN ('', '---', '***', '___'))) AS BIGINT) AS n_kept FROM (SELECT doc_id, {LINES_SQL} AS l FROM documents)")
def doc_line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", tx.lines(F.col("text")).alias("l"))
    return d.select("doc_id", F.size("l").cast("long").alias("n_lines"), F.size(F.filter("l", lambda x: ~tx.strip(x).isin("", *md.RULES))).cast("long").alias("n_kept"))


ESCAPED = [("战 a", "\\u6218 a"), ("�\t", "\\ufffd\\t")]


@query(per_nation_sql([(f"{t}@", f"{e}@") for t, e in ESCAPED], "title", "escaped"))
def escape_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_nation(spark, sf_dir, [(f"{t}@",) for t, _ in ESCAPED], "title").select("n_nationkey", "title", files.escape_unicode(F.col("title")).alias("escaped"))


# queries of other modules, which register themselves
from folio.plans import job_cases, markdown_cases, pdf_cases, table_cases  # noqa: E402, F401
