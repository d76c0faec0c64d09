from collections import Counter, defaultdict

import corpus_pipeline
from folio.llm import bpe, quality
from folio.llm.queries import queries, tokenizer_path
from tests.llm.cases import empty, rows, table
from tests.llm.test_dedup import near, removed, words

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    """Each stage's result from its own input; the trained first stage against its own classification."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    first = corpus_pipeline.minhash_near_dedup
    kept = corpus_pipeline.quality_classifier(spark, docs, SF)
    good = {r.doc_id for r in quality.classify(docs).where("keep").collect()}
    assert {r.doc_id for r in kept.collect()} == good and kept.columns == names

    rows = sorted(map(tuple, kept.collect()))
    single = first(spark, kept, SF)
    want = {x for x, _, _, k in near([r[0] for r in rows], [r[1] for r in rows], 80) if k}
    got = sorted(map(tuple, single.collect()))
    assert {r[0] for r in got} == want and single.columns == names

    cut = corpus_pipeline.substring_removal(spark, single, SF)
    assert cut.columns == names
    texts = {r.doc_id: r.text for r in cut.collect()}
    gone = removed([r[1] for r in got], 35)
    for r, g in zip(got, gone, strict=True):
        assert texts[r[0]] == (" ".join(w for w, x in zip(words(r[1]), g) if not x) if any(g) else r[1])

    packed = corpus_pipeline.best_fit_packing(spark, cut, SF).collect()
    ours = bpe.load(tokenizer_path())
    size = {i: len(next(ours.encode_batch([t]))) + 1 for i, t in texts.items()}
    n = Counter()
    for p in packed:
        n[p.doc_id] += p.length
    assert n == size
    by = defaultdict(int)
    for p in packed:
        by[p.sequence_id] += p.length
    assert max(by.values()) <= 1024 and len(by) <= sum(size.values()) / 1024 + 2


def test_first_stage_knows_all_documents(spark, monkeypatch):
    """What stays does not hang on the texts that the fit starts from."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = []
    for rows in (60, 4000):
        monkeypatch.setattr(quality, "FIT_ROWS", rows)
        kept.append(sorted(r.doc_id for r in corpus_pipeline.quality_classifier(spark, docs, SF).collect()))
    assert kept[0] == kept[1]


def test_run_is_registered(spark):
    assert queries()["pipeline"](spark, SF).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "minhash_near_dedup", "substring_dedup", "best_fit_packing"]


def test_awkward_documents(spark, tmp_path):
    """Nulls, blanks, very long and repeated texts, columns with clashing names, and no documents at all."""
    table(spark).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    empty(spark).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "a")).collect()
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).count() == 0
    docs = rows()
    good = {r.doc_id for r in quality.classify(table(spark)).collect() if r.keep}
    assert {p.doc_id for p in got} <= good & {r[0] for r in docs if words(r[1])}
    # the copies and near copies of one text leave one document
    alike = [r[0] for r in docs if r[1] and r[1] in (docs[6][1], docs[8][1])]
    assert len({p.doc_id for p in got} & set(alike)) == min(1, len(good & set(alike)))
    assert len({(p.doc_id, p.piece) for p in got}) == len(got)
    for stage in (corpus_pipeline.quality_classifier, corpus_pipeline.minhash_near_dedup, corpus_pipeline.substring_removal):
        assert stage(spark, table(spark), "").columns == table(spark).columns
