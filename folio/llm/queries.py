"""The registered queries of the corpus operators: thin wrappers that derive the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: SQL for the operators that it can express.
WORDS_SQL = r"""words AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(coalesce({}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents)"""
SQL = {
    "op1_substring_dedup": f"""WITH {WORDS_SQL.format("text")},
        places AS (SELECT rid, w, unnest(range(1, len(w) + 1)) AS p FROM words),
        pos AS (SELECT rid, p, w[p] AS word, CASE WHEN p + 34 <= len(w) THEN array_to_string(w[p:p + 34], ' ') END AS key FROM places),
        n AS (SELECT key FROM pos WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1),
        m AS (SELECT rid, p, word, coalesce(p - max(CASE WHEN n.key IS NOT NULL THEN p END) OVER (PARTITION BY rid ORDER BY p) < 35, false) AS gone FROM pos LEFT JOIN n USING (key)),
        d AS (SELECT rid, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept FROM m GROUP BY rid)
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM words LEFT JOIN d USING (rid)""",
    "op8_minhash_near_dedup": f"""WITH RECURSIVE {WORDS_SQL.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")},
        places AS (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM words WHERE len(w) > 0),
        sh AS (SELECT DISTINCT rid, array_to_string(w[p:p + 4], ' ') AS key FROM places),
        n AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
        both_ AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM sh a JOIN sh b ON a.key = b.key AND a.rid < b.rid GROUP BY ALL),
        link AS (SELECT a, b FROM both_ JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
        edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        reach AS (SELECT rid, rid AS r FROM words UNION SELECT reach.rid, edge.b FROM reach JOIN edge ON reach.r = edge.a),
        low AS (SELECT reach.rid, min(o.doc_id) AS component_id FROM reach JOIN words o ON o.rid = reach.r GROUP BY reach.rid)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM words LEFT JOIN n USING (rid) LEFT JOIN low USING (rid)""",
    "op11_source_mixing": r"""WITH docs AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
        src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM docs GROUP BY source),
        wt AS (SELECT *, CASE nth % 3 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 2 END AS weight, CAST(sum(source_size) OVER () AS BIGINT) * 3 AS asked FROM src),
        filling AS (SELECT *, row_number() OVER (ORDER BY 2 * source_size / weight, nth) AS rk FROM wt),
        lev AS (SELECT arg_min(level, rk) AS level FROM (
            SELECT f.rk, any_value(2 * f.source_size / f.weight) AS full_at, (any_value(f.asked) - 4 * coalesce(sum(g.source_size) FILTER (g.rk < f.rk), 0)) / (2.0 * sum(g.weight) FILTER (g.rk >= f.rk)) AS level FROM filling f, filling g GROUP BY f.rk) WHERE level <= full_at),
        tg AS (SELECT source, source_size, CASE WHEN weight * level > 2 * source_size OR level IS NULL THEN CAST(2 * source_size AS DOUBLE) ELSE weight * level END AS target FROM wt, lev),
        plan AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(least(target / source_size, 2.0) * 16777216) AS BIGINT) ELSE 0 END AS units, CAST('0x' || substr(md5('11:' || coalesce('=' || source, '')), 1, 6) AS BIGINT) AS off FROM tg),
        placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) AS place FROM docs)
        SELECT doc_id, size, source_size, target, size * (((place * units + off) >> 24) - (((place - 1) * units + off) >> 24)) AS taken FROM placed JOIN plan ON placed.source IS NOT DISTINCT FROM plan.source""",
    "op12_ranked_search": r"""WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        items AS (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
        asked AS (SELECT DISTINCT iid, item_id, unnest(terms) AS term FROM items),
        total AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0),
        tokens AS (SELECT rid, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM docs),
        tf AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM tokens GROUP BY rid, doc_id, n, term),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        hits AS (SELECT iid, item_id, rid, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM asked JOIN tf USING (term) JOIN df USING (term), total GROUP BY iid, item_id, rid, doc_id),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM hits WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
}


def _clustering_sql(rounds: int = 5) -> str:
    """The rounds as one chain of relations; vectors are rows of components there."""
    nearest = """SELECT rid, arg_min(cluster, d * 64 + cluster) AS cluster, min(d) AS d FROM (SELECT rid, cluster, sum((v.x - c.x) * (v.x - c.x)) AS d FROM parts v JOIN c{0} c USING (i) GROUP BY rid, cluster) GROUP BY rid"""
    chain = """vecs AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        parts AS (SELECT rid, unnest(range(1, 65)) AS i, unnest(v) AS x FROM vecs),
        seeds AS (SELECT rid, row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS cluster FROM vecs),
        c0 AS (SELECT cluster, i, x FROM seeds JOIN parts USING (rid) WHERE cluster < 40)"""
    for k in range(rounds):
        chain += f""",
        a{k} AS ({nearest.format(k)}),
        m{k} AS (SELECT cluster, i, sum(x) AS s, count(*) AS n FROM a{k} JOIN parts USING (rid) GROUP BY cluster, i),
        c{k + 1} AS (SELECT cluster, i, CAST(coalesce((s - ((s % n) + n) % n) // n, x) AS BIGINT) AS x FROM c{k} LEFT JOIN m{k} USING (cluster, i))"""
    return f"""WITH {chain},
        a AS ({nearest.format(rounds)}),
        sha AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
        SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM vecs JOIN a USING (rid) JOIN sha USING (cluster)"""


SQL["op13_centroid_clustering"] = _clustering_sql()
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm import substring_dedup

    return substring_dedup.remove_recurring(table(spark, sf_dir, "documents"), window=35, digest=True)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm import bpe

    return bpe.digest(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm import license_scan

    return license_scan.summary(table(spark, sf_dir, "documents"))


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm import webp

    return webp.round_trip(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm import html_extract

    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm import quality

    return quality.classify(table(spark, sf_dir, "documents"))


def op7_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm import lm_score

    return lm_score.score(table(spark, sf_dir, "documents"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm import near_dedup

    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm import packing

    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm import fingerprint

    return fingerprint.with_next(table(spark, sf_dir, "documents"))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm import mixing

    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm import ranked_search

    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm import clustering

    return clustering.cluster(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k == "pipeline" or k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
