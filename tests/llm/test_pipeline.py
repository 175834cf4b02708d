import corpus_pipeline as C
import pytest

from models import components, decontaminated
from webcorpus.llm import packing

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Name -> (rows in, rows out), every stage written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in C.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        got = stage(spark, docs, SF)
        got.write.parquet(path)
        after = spark.read.parquet(path)
        assert name == "packing" or after.columns == COLUMNS
        out[name] = docs.collect(), after.collect()
        docs = after
    return out


def test_order_of_the_stages():
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "minhash_neardup", "benchmark_decontamination", "secret_scans", "packing"]


def test_quality_rejects_some_and_keeps_the_good(stages, spark):
    before, after = stages["quality_classifier"]
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality}
    kept = {r.doc_id for r in after}
    assert len(kept) < len(before) and len(good & kept) >= 0.97 * len(good)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["minhash_neardup"]
    assert {r.doc_id for r in after} == {c for _, c in components([(r.doc_id, r.text) for r in before]).values()}


def test_contaminated_documents_go(stages, spark):
    before, after = stages["benchmark_decontamination"]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    judged = decontaminated([(r.doc_id, r.text) for r in before], items)
    assert {r.doc_id for r in after} == {d for d, v in judged.items() if not v[3]}


def test_secrets_are_masked_and_no_document_goes(stages):
    before, after = stages["secret_scans"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    masked = {r.doc_id for r in after if "[SECRET]" in r.text}
    assert {r.doc_id for r in before} - masked == {r.doc_id for r in after if r in before}
    assert all(r.n_chars == len(r.text) for r in after if r.doc_id in masked)


def test_sequences_hold_every_id_of_every_document_once(stages):
    before, after = stages["packing"]
    encoder = packing.Encoder(*packing.vocabulary_files())
    ids = {r.doc_id: b"" for r in before}
    for r in sorted(after, key=lambda r: (r.doc_id, r.start)):
        ids[r.doc_id] += bytes(r.ids)
    for r in before:
        assert ids[r.doc_id] == encoder.ids(r.text).astype("<u4").tobytes() + (1).to_bytes(4, "little")


def test_run_equals_the_stages(spark, stages):
    key = lambda r: (r.doc_id, r.start)
    got = sorted(C.run(spark, SF).select("doc_id", "start", "ids").collect(), key=key)
    total = {d: sum(len(r.ids) for r in got if r.doc_id == d) for d in {r.doc_id for r in got}}
    assert total == {d: sum(len(r.ids) for r in stages["packing"][1] if r.doc_id == d) for d in {r.doc_id for r in stages["packing"][1]}}


def test_odd_rows_and_empty_tables(spark, frame, table_dir):
    docs = frame([(1, None, "x"), (2, "", None), (None, "a b", "y"), (3, "w " * 4000, "z"), (3, "w " * 4000, "z")], "doc_id long, text string, score string")
    sf = table_dir(benchmark=frame([], "item_id long, text string"), labels=frame([], "doc_id long, quality int, toxic int"), documents=docs)
    assert C.run(spark, sf).count() > 0
    for name, stage in C.STAGES:
        empty = stage(spark, docs.limit(0), sf)
        assert empty.count() == 0 and (name == "packing" or empty.columns == docs.columns)
