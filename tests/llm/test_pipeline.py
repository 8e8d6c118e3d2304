"""The pipeline: every stage against its operator and brute force, and the registered queries."""

import os

import corpus_pipeline
import __spark_entry__ as entry_point
from tenura.llm import toxicity
from tenura.llm.near_join import near_join
from tests.llm.helpers import odd_documents
from tests.llm.test_documents import near_by_hand

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs, written = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        path = f"{spark.conf.get('spark.sql.warehouse.dir')}/stage-{len(written)}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        written.append((name, before, docs))
        if name != "packing":
            assert docs.columns == COLUMNS
    by_name = {name: (before, after) for name, before, after in written}
    before, after = by_name["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    rejected = {r["doc_id"] for r in toxicity.score(before, model).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()} - rejected
    before, after = by_name["line_dedup"]
    assert before.count() == after.count() and all(r["n_chars"] == len(r["text"]) for r in after.collect())
    before, after = by_name["near_duplicates"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert {r["doc_id"] for r in after.collect()} == {least for _, least, _ in near_by_hand(rows)[0]}
    before, after = by_name["secret_scan"]
    assert before.count() == after.count()
    before, after = by_name["packing"]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()}
    assert corpus_pipeline.run(spark, SF).count() == after.count()


def test_one_of_repeated_rows_stays(spark):
    rows = odd_documents()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert kept.count() == near_by_hand(rows)[1] == near_join(docs).where("kept").select("doc_id", "text_mark").distinct().count()


def test_registered():
    names = entry_point.queries()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in names if name.startswith("op")}
    assert "pipeline" in names and os.path.isfile(corpus_pipeline.__file__)
