import numpy as np

import corpus_pipeline as P


def test_stages_on_odd_rows(spark, documents, nothing, tmp_path):
    for start, some in ((documents, True), (nothing, False)):
        docs = start
        for n, (name, stage) in enumerate(P.STAGES):
            out = stage(spark, docs, "")
            if n < len(P.STAGES) - 1:
                assert out.columns == start.columns, name
            out.write.parquet(path := str(tmp_path / f"{some}-{n}"))
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == some


def test_run_keeps_clean_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = P.language_id(spark, docs, sf_dir)
    letters = docs.filter("text RLIKE '[A-Za-z]'").count()
    assert kept.count() == letters
    pieces = P.run(spark, sf_dir).collect()
    assert all(len(np.frombuffer(p.ids, "<u4")) == p.length for p in pieces)
    # Near copies are gone: no document of the result is another's class.
    from gaugeline.llm.near_dedup import near_groups

    ids = {p.doc_id for p in pieces}
    left = near_groups(P.exact_dedup(spark, kept, sf_dir)).filter("kept").collect()
    assert ids <= {r.doc_id for r in left}


def test_mixed_and_unlabelled_documents_stay(spark):
    en, de, ru = "the cat and the dog were in the house ", "der Hund und die Katze sind nicht im Haus ", "кошка и собака не были в доме "
    rows = [(i, t * 6, lang, "a", 1) for i, (t, lang) in enumerate([(en, "en"), (de, "de"), (ru, "ru")] * 10)]
    rows += [(100, en * 4 + de * 4 + ru * 4, None, "a", 1), (101, "123 !", None, "a", 1), (102, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r.doc_id for r in P.language_id(spark, docs, "").collect()}
    assert kept == set(range(30)) | {100}
    unlabelled = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang", "source", "n_chars")
    assert P.language_id(spark, unlabelled, "").count() == docs.count()
