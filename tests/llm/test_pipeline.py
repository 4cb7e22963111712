import zlib
from array import array

import corpus_pipeline
from riverdeck.llm.mixing import copies, source_targets, word_count
from riverdeck.llm.packing import WINDOW
from riverdeck.llm.pii import find
from riverdeck.llm.quality import quality_report


def test_stages_take_effect_one_after_the_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.pinned(stage(spark, docs, sf_dir), name)
        assert out.columns == docs.columns
        seen.append((docs, out))
        docs = out
    (raw, good), (_, unique), (_, clean), (before, mixed) = seen
    kept = {r.doc_id for r in quality_report(raw).filter("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept
    assert {r.doc_id for r in unique.collect()} < kept and unique.count() == unique.select("doc_id").distinct().count()
    assert not any(base for r in clean.collect() for *_, base in find(r.text))
    targets = {r.source: r for r in source_targets(before.select("source", word_count(before.text).alias("size"))).collect()}
    rates = spark.createDataFrame([(s, r.rate) for s, r in targets.items()], "source string, rate double")
    expected = {r.doc_id: r.n for r in before.join(rates, "source").select("doc_id", copies(rates.rate, before.doc_id).alias("n")).collect()}
    found = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert found == {k: n for k, n in expected.items() if n}
    pieces = corpus_pipeline.STAGES[-1][1](spark, mixed, sf_dir).collect()
    ends = {}
    for r in pieces:
        ends[r.doc_id] = ends.get(r.doc_id, 0) + (r.start + r.length == r.doc_tokens)
    assert ends == found


def test_run_gives_rows(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_sequences_can_be_built_from_the_result(spark, sf_dir):
    sequences = {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(array("I", r.ids).tobytes())
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.ids))
    for own in sequences.values():
        end = 0
        for offset, ids in sorted(own):
            assert offset == end
            end += len(ids)
        assert 0 < end <= WINDOW
