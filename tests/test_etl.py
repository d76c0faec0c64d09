"""Operators on crafted inputs and on real files."""

import os
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folio.functions import html, text
from folio.functions import markdown as md
from folio.operators import assets, checklist, contents, documents, repair, tables
from folio.plans import jobs
from folio.sources import files, sinks
from folio.streaming import imports

SIGNS = "ab 1#*_`|$\\\r\n\t\x0b\x0c\x1c\x1e\x85\xa0  　K<>/\"=ſ"


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i long, v {kind}")
    return [r[1] for r in df.select("i", make(F.col("v"))).orderBy("i").collect()]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(SIGNS, max_size=30), min_size=40, max_size=80))
def test_text_rules_are_pythons(spark, values):
    assert column(spark, values, text.strip) == [v.strip() for v in values]
    assert column(spark, values, text.lines) == [v.splitlines() or [""][:0] if v else [] for v in values]
    assert column(spark, values, text.unify_newlines) == [v.replace("\r\n", "\n").replace("\r", "\n") for v in values]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("<>/aAimgsrc=hreftdpouv:- \n\"'x!-", max_size=60), min_size=40, max_size=80))
def test_html_rules(spark, values):
    def keep(tag, name):
        def one(m):
            found = re.search(rf'{name}\s*=\s*"([^">]+)"', m[0], re.I)
            return f'<{tag} {name}="{found[1]}">' if found else f"<{tag}>"

        return lambda v: re.sub(rf"<{tag}\b[^>]*>", one, v, flags=re.I)

    assert column(spark, values, html.keep_src) == list(map(keep("img", "src"), values))
    assert column(spark, values, html.keep_href) == list(map(keep("a", "href"), values))
    tags = "|".join(html.STRUCTURAL)
    assert column(spark, values, html.strip_attributes) == [re.sub(rf"<({tags})\b[^>]*>", r"<\1>", v, flags=re.I) for v in values]
    assert column(spark, values, html.drop_namespaced) == [re.sub(r"</?[vow]:[^>]*>", "", v, flags=re.I) for v in values]


@pytest.mark.parametrize(
    ("tag", "want"),
    [('<a data-href="d" href="e">', '<a href="d">'), ("<a name=k>", "<a>"), ("<a href='s'>", "<a>"), ('<A HREF = "x" b>', '<a href="x">')],
)
def test_anchors(spark, tag, want):
    assert column(spark, [tag], html.keep_href) == [want]


def test_images(spark):
    assert column(spark, ['<img src="a" data-src="b">'], html.keep_src) == ['<img src="a">']
    assert column(spark, ['<img src="a" data-src="b">'], html.images_to_markdown) == ["![](b)"]


def test_charset(spark):
    cases = {b"charset=gb2312": "gbk", b'charset="gbk"': "utf-8", b"Charset = Big5": "big5", b"": "utf-8", b" " * 4096 + b"charset=gbk": "utf-8"}
    assert column(spark, [bytearray(k) for k in cases], html.charset, "binary") == list(cases.values())


def test_titles(spark):
    assert column(spark, ["2.1 战斗", "2. 核心", "1.战斗", "x"], md.section_number) == ["2.1", "2", "", ""]
    assert column(spark, ["2.1 战斗 ", "2. 核心", " 1.战斗"], md.without_number) == ["战斗", "核心", "1.战斗"]
    assert column(spark, ["**战 斗**：Ａ"], md.title_key) == ["战斗a"] and column(spark, ["**战 斗**：Ａ"], md.toc_key) == ["**战斗**a"]
    assert column(spark, ["  ## A b  ", "#x", "####### y", "# 　"], md.heading_text) == ["A b", "", "", ""]


def test_described(spark):
    docs = spark.createDataFrame([("a.md", "# T\n\n---\n"), ("b.md", "x\n# T\n"), ("c.md", "\n\n## **Q**\nbody\n***\n more \n"), ("d.md", ""), ("e.md", "# **\nx"), ("f.md", None)], "path string, text string")
    got = {r.path: tuple(r)[1:] for r in documents.described(docs).collect()}
    assert got == {"a.md": ("T", 1, 0, 0, True), "c.md": ("Q", 2, 2, 10, False)}
    assert {r.path for r in documents.without_heading(docs.where("text is not null")).collect()} == {"d.md"}
    assert {r.path: r.title for r in documents.first_heading(docs.where("text is not null")).collect()}["b.md"] == "T"


def test_toc_fallbacks(spark):
    docs = spark.createDataFrame([("docs/a/x.md", "One"), ("docs/核心规则/y.md", "One"), ("z.md", "2 Two"), ("w.md", "Two"), ("1.md", "One"), ("22.md", "One"), ("333.md", "One")], "path string, title string")
    toc = spark.createDataFrame([(0, 1, "2 One", 3), (1, 1, "2 Two", 4), (2, 2, "9 One", 5), (3, 1, "none", 6), (4, 1, "", 7)], "toc_idx int, level int, title string, page int")
    got = {}
    for r in contents.match(toc, docs).orderBy("toc_idx", "rank").collect():
        got.setdefault(r.toc_idx, []).append(r.path)
    assert got == {0: ["docs/核心规则/y.md"], 1: ["w.md"], 2: ["1.md", "22.md", "333.md"], 3: [None], 4: [None]}
    assert {r.toc_idx for r in contents.unmatched(toc, docs).collect()} == {3, 4}


def test_expand_spans():
    assert tables.expand([[("a", 3, 1), ("b", 1, 1)], [("c", 1, 1)], []]) == [["a", "b"], ["a", "c"], ["a"]]
    assert tables.expand([[("x", 2, 2)], [("y", 1, 1)]]) == [["x", "x"], ["x", "x", "y"]]


def test_pending_and_done(spark):
    todo = "# L\n- [ ] `docs/a.md`\n- [ ]  `no`\n- [x] `docs/b.md`\n - [ ] `no`\n- [ ] `docs/c.md`  \n"
    got = checklist.pending(spark.createDataFrame([(todo,)], "text string")).collect()
    assert [r.path for r in got] == ["docs/a.md", "docs/c.md"]


def test_rebuild_listed(spark):
    docs = spark.createDataFrame([("docs/a.md", "x <table><tr><td>1<td>2</table> y"), ("docs/c.md", "plain"), ("docs/z.md", "other")], "path string, text string")
    out, ticked = jobs.rebuild_listed(docs, "- [ ] `docs/a.md`\n- [ ] `docs/c.md`\n")
    todo = ticked.first().text
    assert {r.path: r.text for r in out.collect()} == {"docs/a.md": "x | 1 | 2 |\n| --- | --- |\n y"}
    assert todo.startswith("- [x] `docs/a.md`\n- [x] `docs/c.md`\n\n### 已完成\n\n- `docs/a.md`：") and todo.endswith(f"：{jobs.NOTHING}\n")
    with pytest.raises(ValueError, match="docs/q.md"):
        jobs.rebuild_listed(docs, "- [ ] `docs/q.md`\n")
    assert jobs.metrics(docs).first().asDict() == {"documents": 3, "tables_found": 1, "tables_converted": 1, "changed": 1}


def test_regular_repairs(spark):
    docs = spark.createDataFrame([("a", "**期望** **攻击** **招架**\n**传闻** 6.5 +1光\n**传说** x")], "path string, text string")
    got = docs.select(repair.tier_tables(F.col("text"))).first()[0]
    assert got == "|期望|攻击|招架|\n|---|---|---|\n|传闻|6.5|+1光|"


LINES = ["**等级**", " **等级**　", "**经历点** 1 2", "\x1c**经历点** 3, 4 5 ", "**经历点** 7", "**经历点** 12", "x", "", "**期望** **攻击** **招架**", "**期望** 攻 ** 1", "**传闻** 6.5 +1光", "**怪谈** 12 x50% 升半阶", " **星辰**", "a **期望** **攻击** b", "|**传闻** 1", "**传闻** **期望** **攻击**", "\r", "**等级**\r"]


def level_by_lines(text):
    """The rule as it is told, line by line."""
    lines, out, again = text.split("\n"), [], False
    while lines:
        numbers = re.findall(r"\d+", lines[1]) if len(lines) > 1 and lines[0].strip() == repair.LEVEL and lines[1].strip().startswith(repair.POINTS) else []
        if len(numbers) < 2:
            out.append(lines.pop(0))
            again = False
            continue
        first = repair.SECOND_FROM if again else 1
        out += [""] * again + [f"|{repair.LEVEL}|" + "".join(f"**{first + i}**|" for i in range(len(numbers))), "|------|" + "---|" * (len(numbers) - 1), f"|{repair.POINTS}|{'|'.join(numbers)}|"]
        lines, again = lines[2:], not again
    return "\n".join(out)


def tiers_by_lines(text):
    lines, out = text.split("\n"), []

    def fits(x):
        x = x.strip()
        return x != "" and "|" not in x and (re.search(rf"\*\*({'|'.join(repair.TIERS)})\*\*", x) or x.startswith(repair.EXPECTED) and x.count("**") >= 4)

    while lines:
        n = next((i for i, x in enumerate(lines) if not fits(x)), len(lines))
        if repair.EXPECTED not in lines[0] or repair.ATTACK not in lines[0] or n < 2:
            out.append(lines.pop(0))
            continue
        for k, x in enumerate(y.strip() for y in lines[:n]):
            cells = re.findall(r"\*\*([^*]+)\*\*", x) + re.findall(r"\d+\.?\d*", re.sub(r"\*\*[^*]+\*\*", "", x)) + re.findall(r"[+\-]?\d+光|x\d+%|升[半\d]+阶", x)
            if len(cells) > 1:
                out += [f"|{'|'.join(cells)}|"] + [f"|{'|'.join(['---'] * len(cells))}|"] * (k == 0)
        lines = lines[n:]
    return "\n".join(out)


def test_repairs_line_by_line(spark):
    rnd = random.Random(4)
    texts = ["\n".join(rnd.choice(LINES) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    texts += ["\n".join(["**期望** **攻击**"] + ["**传闻** 1 2"] * 50_000), "\n".join(["**等级**", "**经历点** 1 2 3"] * 20_000), "**等级**\n**经历点**" + " 1" * 50_000]
    assert column(spark, texts, lambda t: repair.level_tables(t, True)) == list(map(level_by_lines, texts))
    assert column(spark, texts, lambda t: repair.tier_tables(t, True)) == list(map(tiers_by_lines, texts))


def test_repairs_stay_in_their_row(spark):
    docs = spark.createDataFrame([("a", "x")], "path string, text string")
    plan = docs.select("path", repair.level_tables(F.col("text")), repair.tier_tables(F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Window", "Generate", "Python"))


def test_assets_by_hand(spark):
    rows = [(1, 1, b"aa"), (1, 2, b"bb"), (2, 1, b"aa"), (2, 2, b""), (3, 1, b"b"), (3, 2, None)]
    df = spark.createDataFrame(rows, "page int, idx int, content binary")
    assert sorted((r.page, r.idx) for r in assets.keep_first(df, 2).collect()) == [(1, 1), (1, 2)]
    assert tuple(assets.extraction_counts(df, 2).first()) == (2, 1, 3)
    lit = F.lit
    assert [tuple(spark.range(1).select(*assets.pages_between(lit(a), lit(b), lit(10))).first()) for a, b in ((0, 0), (5, 3), (12, 0))] == [(1, 10), (5, 10), (12, 10)]
    pages = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "page int, images array<string>")
    assert [tuple(r) for r in files.page_images(pages).orderBy("idx").collect()] == [(1, 1, "a"), (1, 2, "b")]
    assert files.page_numbers(spark.createDataFrame([(3,), (0,)], "n_pages int")).count() == 3


def test_files(spark, tmp_path):
    src, out = tmp_path / "src", tmp_path / "out"
    pages = {"a/p.htm": '<meta charset=gb2312><p>中<img src="i/x.PNG"></p>'.encode("gbk"), "template/t.htm": b"no", "a/q.files/header.htm": b"no", "b.html": b"no", "a/i/x.PNG": b"png"}
    for name, data in pages.items():
        os.makedirs((src / name).parent, exist_ok=True)
        (src / name).write_bytes(data)
    counts = jobs.import_tree(spark, str(src), str(out), "assets/chm")
    assert counts == {"converted": 1, "copied": 1}
    made = (out / "a/p.md").read_text()
    assert "中" in made and "![](../assets/chm/a/i/x.PNG)" in made
    assert (out / "assets/chm/a/i/x.PNG").read_bytes() == b"png"
    docs = files.markdown(spark, str(out), only="p.md")
    assert [r.path for r in docs.collect()] == ["a/p.md"] and files.markdown(spark, str(out), without=["p.md"]).count() == 0
    old = spark.createDataFrame([("a/p.md", made, "new"), ("a/z.md", "same", "same")], "path string, old string, text string")
    sinks.write_changed(old, str(out))
    assert (out / "a/p.md").read_text() == "new" and not (out / "a/z.md").exists()
    sinks.write_report(spark.createDataFrame([(2, "b"), (1, "a")], "n int, line string"), str(out / "r.txt"), ["n"])
    assert (out / "r.txt").read_text() == "a\nb\n"
    plan = assets.rename_plan(spark.createDataFrame([("a/p.md", "c/p.md"), ("no.md", "x.md"), ("r.txt", "a/p.md")], "src string, dst string"), files.listing(spark, str(out)))
    assert {r.src: r.outcome for r in plan.collect()} == {"a/p.md": "renamed", "no.md": "missing", "r.txt": "exists"}
    sinks.apply_renames(plan, str(out))
    assert (out / "c/p.md").read_text() == "new"
    sinks.clean(spark, str(out))
    assert not out.exists()


def test_decoding_policies(spark, tmp_path):
    (tmp_path / "x.md").write_bytes(b"a\xff\r\nb")
    assert files.markdown(spark, str(tmp_path)).first().text == "a�\nb" and files.markdown(spark, str(tmp_path), "ignore").first().text == "a\nb"
    with pytest.raises(Exception, match="decode"):
        files.markdown(spark, str(tmp_path), "strict").collect()


def test_stream(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    os.makedirs(src)
    for k in (1, 2):
        (tmp_path / "src" / f"p{k}.htm").write_text(f"<p>page {k}</p>")
        imports.import_new(spark, src, out, mark).awaitTermination(120)
        assert spark.read.parquet(out).count() == k


def test_plans_push_down_and_stay_native(spark):
    from folio.plans import catalog

    plan = catalog.html_clean(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "url" not in plan.split("ReadSchema")[1]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_repair_files(spark, tmp_path):
    for name, text in (("a.md", "**等级**\n**经历点** 1 2"), ("b.md", "x"), ("c.md", "**等级**\n**经历点** 3 4")):
        (tmp_path / name).write_text(text)
    kinds = {"a.md": "level", "b.md": "tier", "no.md": "tier", "c.md": "level"}
    got = {r.path: r.status for r in jobs.repair_files(spark, str(tmp_path), kinds).collect()}
    assert got == {"a.md": "ok", "b.md": "unchanged", "no.md": "missing", "c.md": "ok"}
    assert (tmp_path / "a.md").read_text() == "|**等级**|**1**|**2**|\n|------|---|\n|**经历点**|1|2|"
    # a file that can't be written fails alone
    rows = spark.createDataFrame([("d/x.md", "1", "ok"), ("a.md/x.md", "2", "ok"), ("e.md", None, "missing")], "path string, text string, status string")
    found = {r.path: (r.status, bool(r.error)) for r in sinks.write_each(rows, str(tmp_path), status_col="status").collect()}
    assert found == {"d/x.md": ("ok", False), "a.md/x.md": ("failed", True), "e.md": ("missing", False)}


def test_rename_files(spark, tmp_path):
    sinks.write_tree(spark.createDataFrame([("docs/a.md", "A"), ("docs/c.md", "C"), ("todo.md", "- [ ] `docs/a.md`\n- [ ] `docs/b.md`\n")], "path string, text string"), str(tmp_path))
    log = jobs.rename_files(spark, str(tmp_path), "todo.md", [("docs/a.md", "docs/n/a.md"), ("docs/b.md", "docs/n/b.md")])
    assert log == ["renamed: docs/a.md -> docs/n/a.md", "missing: docs/b.md"]
    assert (tmp_path / "docs/n/a.md").read_text() == "A" and (tmp_path / "todo.md").read_text() == "- [ ] `docs/n/a.md`\n- [ ] `docs/n/b.md`\n"


def test_reports_as_files(spark, tmp_path):
    docs = spark.createDataFrame([("x/a.md", "# T\n"), ("y/a.md", "# T\nbody\n")], "path string, text string")
    assert jobs.write_duplicate_report(docs, str(tmp_path / "r.txt")) == {"A": 1, "B": 1}
    group = "title_only:\n- x/a.md\nhas_content:\n- y/a.md  (body_lines=1, body_chars=4)\n"
    assert (tmp_path / "r.txt").read_text() == f"{jobs.DUPES_TITLE}\n\n{jobs.DUPES_HEAD['A']}\n\n候选组数：1\n\n== T ==\n{group}\n\n{jobs.DUPES_HEAD['B']}\n\n候选组数：1\n\n== a ==\n{group}\n"
    toc = spark.createDataFrame([(0, 1, "T", 3), (1, 2, "no", 4)], "toc_idx int, level int, title string, page int")
    assert jobs.write_chapter_map(toc, docs, str(tmp_path / "m.md"), "b.pdf") == {"toc_items": 2, "md_files": 2, "unmatched": 1}
    made = (tmp_path / "m.md").read_text()
    assert made.startswith("#### ") and "来源：`b.pdf`\n" in made and made.endswith("- **no**（[P004](../assets/pdf_pages_small/page_004.jpg)）\n")
    assert tuple(jobs.chapter_counts(toc, docs).first()) == (2, 2, 1)
