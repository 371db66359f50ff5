"""The pipeline's stages, each against brute force on its own input."""

import pytest
from edge import base_rows, documents, shingles
from test_join import ITEMS, brute_classes, contaminated
from test_text import check_pieces

import __spark_entry__ as driver
import corpus_pipeline
from chroniq.llm import packing
from chroniq.llm import queries as Q

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Awkward documents, with labels and benchmark items of their own."""
    folder = str(tmp_path_factory.mktemp("sf"))
    rows = base_rows() + [(i + 700, t) for i, t in [(r[0] or 90, r[1]) for r in contaminated()]]
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (4, 0, 1), (8, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_registered():
    assert driver.queries()["pipeline"] is corpus_pipeline.run
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in driver.queries() if k.startswith("op")}


def test_stages_on_awkward_rows_and_on_none(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        for some in (docs, docs.limit(0)):
            out = step(spark, some, sf)
            n = out.count()
            assert n or not some.take(1) or name != "packing"
            if name != "packing":
                assert out.columns == corpus_pipeline.DOCUMENT_COLUMNS


def test_every_stage_does_what_it_says(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = corpus_pipeline.good_quality(spark, docs, SF)
    kept = {r.doc_id for r in good.collect()}
    clean = [i for i, r in labels.items() if r.quality]
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)
    assert sum(i in kept for i, r in labels.items() if not r.quality) <= 0.3 * sum(not r.quality for r in labels.values())

    mild = rows_of(corpus_pipeline.not_toxic(spark, docs, SF))
    bad = {r.doc_id for r in Q.op3_toxicity(spark, SF).where("predicted = 1").collect()}
    assert mild == [r for r in rows_of(docs) if r[0] not in bad]

    rows = rows_of(docs)
    classes = brute_classes(rows)
    assert rows_of(corpus_pipeline.one_per_class(spark, docs, SF)) == [r for r in rows if any(c[0] == r[0] == c[1] for c in classes)]

    items = [shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = lambda text: any(i and len(i & shingles(text)) >= 0.8 * len(i) for i in items)
    assert rows_of(corpus_pipeline.no_benchmark(spark, docs, SF)) == [r for r in rows if not leaks(r[1])]

    pieces = packing.pack(docs.limit(40), Q.tokenizer_file("byte_bpe_50k.json"), with_ids=True)
    check_pieces(pieces.collect(), rows_of(docs.limit(40)))


def test_run_is_the_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF)
    left = rows_of(docs)
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == {i for i, _ in left} and len(left) < 200
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())
