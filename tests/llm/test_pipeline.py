from pyspark.sql import functions as F

import corpus_pipeline as C
from paylake.llm import toxicity


def test_stages_in_order():
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_dedup", "pii", "packing"]


def test_pipeline(spark, small, read):
    docs = read("documents")
    for name, stage in C.STAGES[:-1]:
        after = stage(spark, docs, small)
        assert after.columns == list(C.COLUMNS) and after.count() <= docs.count()
        docs = after
    out = C.run(spark, small)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_stages_take_odd_rows(spark, small, edge_docs, no_docs, clash):
    for _, stage in C.STAGES:
        assert stage(spark, no_docs, small).count() == 0
        assert stage(spark, clash.add(edge_docs), small).count() > 0
    kept = C.drop_near_duplicates(spark, edge_docs, small)
    assert kept.where("doc_id = 3").count() == 1 and kept.where("doc_id is null").count() == 2
    assert kept.where("doc_id in (9, 10)").count() == 1


def test_toxic_rows_go_by_their_own_text(spark, small, read):
    docs = read("documents")
    scored = toxicity.toxicity(docs, read("labels")).join(docs.select("doc_id", "text"), "doc_id")
    bad = scored.where("predicted = 1").orderBy("doc_id").select("text").head()["text"]
    good = scored.where("predicted = 0 and length(text) > 20").orderBy("doc_id").select("text").head()["text"]
    odd = spark.createDataFrame([(None, bad), (10**9, bad), (10**9, good), (None, None), (None, good)],
                                "doc_id long, text string")
    odd = odd.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    kept = C.reject_toxic(spark, docs.unionByName(odd), small).where("lang = 'en' and source = 's'")
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()) == [(10**9, good)]
    assert {r.text for r in kept.where("doc_id is null").collect()} == {None, good}


def test_run_on_odd_tables(spark, small, read, edge_docs, no_docs, clash, tmp_path):
    for name, docs in (("none", no_docs), ("odd", clash.add(edge_docs))):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        read("labels").write.parquet(str(tmp_path / name / "labels.parquet"))
        assert (C.run(spark, str(tmp_path / name)).count() > 0) == (name == "odd")
