"""Queries over jobs that go wrong in part or whole: what they say, and what they leave."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators import contents
from folio.plans import jobs
from folio.plans.catalog import query, table, work_folder
from folio.sources import files, scratch, sinks


@query(
    """WITH p AS (SELECT 'x/' || (page_id % 9) || '/' || page_id || '.md' AS path, url, page_id % 3 AS k FROM pages)
    SELECT path || CASE k WHEN 1 THEN '/y.md' ELSE '' END AS path, CASE k WHEN 0 THEN 'ok' WHEN 1 THEN 'failed' ELSE 'missing' END AS status, k = 1 AS has_error FROM p
    UNION ALL SELECT 'left: ' || path, CASE k WHEN 0 THEN 'new ' ELSE 'old ' END || url, false FROM p"""
)
def write_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of which every third can't be written, as a file stands where its folder should be: the others are written all the same."""
    root, pages = work_folder(spark), table(spark, sf_dir, "pages")
    number, k = F.col("page_id"), F.col("page_id") % 3
    path = F.concat(F.lit("x/"), (number % 9).cast("string"), F.lit("/"), number.cast("string"), F.lit(".md"))
    sinks.write_tree(pages.select(path.alias("path"), F.concat(F.lit("old "), "url").alias("text")), root)
    rows = pages.select(F.when(k == 1, F.concat(path, F.lit("/y.md"))).otherwise(path).alias("path"), F.concat(F.lit("new "), "url").alias("text"), F.when(k == 2, "missing").otherwise("ok").alias("status"))
    done = scratch.stored(sinks.write_each(rows, root, status_col="status"), "statuses")
    left = files.markdown(spark, root).select(F.concat(F.lit("left: "), "path"), "text", F.lit(False))
    return done.select("path", "status", F.col("error").isNotNull().alias("has_error")).union(left)


@query(
    """SELECT 'rebuild' AS job, 'missing, or with tables that are left: ' || string_agg(path, ', ' ORDER BY path) AS message FROM (SELECT 'docs/' || s_name || '.md' AS path FROM supplier WHERE s_suppkey % 5 < 2 ORDER BY path LIMIT 20)
    UNION ALL SELECT 'import', 'no pages' UNION ALL SELECT 'left', 'docs unchanged: ' || count(*) FROM supplier WHERE s_suppkey % 5 > 0"""
)
def jobs_aborted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rebuild with documents that are missing or keep a table, of which at most 20 are named and which changes nothing, and an import that finds no pages."""
    root, n = work_folder(spark), table(spark, sf_dir, "supplier")
    path, k = F.concat(F.lit("docs/"), "s_name", F.lit(".md")), F.col("s_suppkey") % 5
    text = F.concat(F.lit("<table><tr><td>"), "s_name", F.lit("<td>1</table>"), F.when(k == 1, "<table><tr>").otherwise(""))
    docs = n.where(k > 0).select(path.alias("path"), text.alias("text"))
    sinks.write_tree(docs, root)
    todo = n.agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("- [ ] `"), path, F.lit("`")))), "\n").alias("text"))
    sinks.write_tree(todo.select(F.lit("todo.md").alias("path"), "text"), root)
    said = []
    for job, run in (("rebuild", lambda: jobs.rebuild_checklist(spark, root, "todo.md")), ("import", lambda: jobs.import_tree(spark, root, f"{root}/out", "assets"))):
        try:
            run()
        except (ValueError, FileNotFoundError) as e:
            said.append((job, str(e).split(" under ")[0]))
    same = files.markdown(spark, root, only="docs/").join(docs, ["path", "text"], "left_semi")
    left = same.agg(F.concat(F.lit("docs unchanged: "), F.count(F.lit(1)).cast("string")).alias("message")).select(F.lit("left").alias("job"), "message")
    return spark.createDataFrame(said, "job string, message string").union(left)


@query(
    """SELECT 'sample.tsv' AS path, string_agg(line, chr(10) ORDER BY o_orderkey) AS text FROM (SELECT o_orderkey, (o_orderkey % 4) || chr(9) || o_custkey || chr(9) || o_orderpriority || chr(9) || o_orderpriority AS line FROM orders ORDER BY o_orderkey LIMIT 50)"""
)
def tree_sample_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contents sample as a file without a newline at its end."""
    root, o = work_folder(spark), table(spark, sf_dir, "orders")
    toc = o.select(F.col("o_orderkey").alias("toc_idx"), (F.col("o_orderkey") % 4).alias("level"), F.col("o_custkey").alias("page"), F.col("o_orderpriority").alias("title"))
    sinks.write_report(contents.sample(toc), f"{root}/sample.tsv", ["toc_idx"], final_newline=False)
    return files.scan(spark, root).select("path", files.text_of(F.col("content")).alias("text"))
