from __future__ import annotations

import numpy as np

import corpus_pipeline as P
from martflow.llm import golay_dedup, pfair_mix, quality_rules, string_tiling
from martflow.llm.common import table
from martflow.llm.packing import packed
from pyspark.sql import functions as F
from tests.conftest import SF0001, need_testdata


def test_stages_take_effect_and_end_in_packed_rows(spark):
    need_testdata()
    docs = table(spark, SF0001, "documents")
    want = {r.doc_id: r.text for r in docs.collect()}
    model = quality_rules.fit(docs, table(spark, SF0001, "labels"), F.lit(True))
    good = {r.doc_id for r in quality_rules.score(docs, model).filter("score >= 0.5").collect()}
    kept = docs
    for name, stage in P.STAGES[:-1]:
        kept = stage(spark, kept, SF0001)
        assert kept.columns == docs.columns, name
        kept = P.materialize(kept, "test-stage")
        ids = [r.doc_id for r in kept.select("doc_id").collect()]
        assert len(ids) == len(set(ids))
        if name.startswith("quality"):
            assert set(ids) == good
    left = {r.doc_id: r.text for r in kept.collect()}
    assert set(left) <= good and all(left[i] == want[i] for i in left)
    assert string_tiling.contaminated(kept, table(spark, SF0001, "benchmark")).count() == 0
    assert {r.group_docs for r in golay_dedup.near_duplicates(kept).collect()} == {1}
    assert pfair_mix.mix_order(kept).count() == len(left)
    rows = P.run(spark, SF0001).collect()
    seen = [d for r in rows for d in r.doc_ids]
    assert set(seen) == set(left)
    assert sum(r.n_tokens for r in rows) == sum(int((np.diff(r.cu_seqlens)).sum()) for r in rows)


def test_packed_batches_follow_the_mix_whatever_the_files(spark, tmp_path, monkeypatch):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('word ', 5 + id % 90)").alias("text"), F.lit("en").alias("lang"),
                                    F.expr("if(id % 10 = 0, 'small', 'large')").alias("source"), F.lit(1).alias("n_chars"))
    docs.repartition(7, F.col("doc_id") % 3).write.parquet(str(tmp_path / "stage"))  # files of unequal size, in no order
    stage = spark.read.parquet(str(tmp_path / "stage"))
    monkeypatch.setattr(P, "packed", lambda d, **o: packed(d, batch_tokens=1 << 13, **o))
    place = {r.doc_id: r.place for r in pfair_mix.mix_order(docs).collect()}
    batches: dict[int, list[int]] = {}
    for r in P.tokens(spark, stage, "").collect():
        batches.setdefault(r.batch, []).extend(place[d] for d in r.doc_ids)
    assert len(batches) > 5 and sum(map(len, batches.values())) >= 3000
    ends = [(min(batches[b]), max(batches[b])) for b in sorted(batches)]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_null_ids_and_repeats_pass_through(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "one two three four", "en", None, 1), (1, "one two three four", "en", "a", 1), (None, None, None, None, None),
         (2, "", "en", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = P.run(spark, str(tmp_path)).collect()
    assert sorted(str(d) for r in rows for d in r.doc_ids) == ["1", "2"]
