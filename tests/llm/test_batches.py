import pyarrow as pa
from pyspark.sql import functions as F

from folio.llm.batches import lean
from folio.llm.shared import TIDY, tidy


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["id", "text"])


def test_slices_hold_all_rows_in_order():
    texts = ["a" * 10, None, "", "b" * 5000, *["c" * 100] * 200, "d" * 20_000, "d" * 20_000]
    parts = list(lean(iter([batch(texts), batch([]), batch(["x"])]), 1000))
    assert [t for p in parts for t in p.column(1).to_pylist()] == [*texts, "x"]
    assert all(p.num_rows == 1 or p.nbytes <= 2000 for p in parts)
    assert len(parts) > 20


def test_no_batches():
    assert list(lean(iter([]))) == []


def test_settings_hold_inside_only(spark):
    before = {k: spark.conf.get(k, None) for k in TIDY}
    rows = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("t"))
    sizes = lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"]) for b in bs)
    with tidy(spark):
        inside = [r.n for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(inside) == 400 and max(inside) < 100
    assert {k: spark.conf.get(k, None) for k in TIDY} == before
