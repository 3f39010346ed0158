"""The pipeline's stages against brute force on each stage's own input."""

import corpus_pipeline
from geotally.llm import quality_crf
from geotally.llm.common import table, written
from tests.conftest import DATA
from tests.llm.test_decontamination import brute as brute_hits
from tests.llm.test_exact_dedup import brute as brute_copies
from tests.llm.test_near_dedup import brute as brute_near
from tests.llm.test_packing import check, ids_of


def test_stages(spark):
    folder = str(DATA)
    docs = table(spark, folder, "documents")
    columns = docs.columns
    kept = {}
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, folder), "test")
        assert docs.columns == columns
        rows = docs.collect()
        kept[name] = {r.doc_id: r.text for r in rows}
        assert len(rows) == len(kept[name])
        if name == "quality classifier":
            scores = quality_crf.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
            want = {r.doc_id for r in scores.where("predicted = 1").collect()}
        elif name == "exact dedup":
            want = {i for i, _, _, stays, _ in brute_copies(before.items()) if stays}
        elif name == "near dedup":
            ids = sorted(before)
            want = {ids[k] for k in brute_near([before[i] for i in ids], corpus_pipeline.NEAR_SHARE)}
        else:
            items = [(r.item_id, r.text) for r in table(spark, folder, "benchmark").collect()]
            want = {i for i, t in before.items() if not brute_hits(t, items)[1]}
        assert set(kept[name]) == want, name
        before = kept[name]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    check(pieces, {i: ids_of(t) for i, t in before.items()}, 2048)


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, str(DATA))
    assert got.count() > 0 and "sequence_id" in got.columns
