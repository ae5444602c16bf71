import corpus_pipeline
from alvara.llm import simhash
from alvara.llm.secrets import rule_spans

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, sizes, texts = docs.columns, [docs.count()], None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        sizes.append(docs.count())
        if name == "simhash_near_dedup":
            groups = simhash.simhash_groups(docs).collect()
            assert len({r.component_id for r in groups}) == len(groups)
        if name == "secret_scan":
            rows = docs.collect()
            assert not any(rule_spans(r.text or "") for r in rows)
            assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
            texts = {r.doc_id: r.text for r in rows}
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] < sizes[4]
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert len(rows) == sizes[4] and {r.doc_id for r in rows} == set(texts)
    assert all(r.decoded == (texts[r.doc_id] or "") and len(r.ids) == r.n_tokens for r in rows)


def test_empty_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row__ int, text_ string"
    rows = [(1, None, None, None, None, 1, "x"), (1, None, None, None, None, 1, "x"), (None, "", "", "", 0, 1, "x"),
            (2, "a b c d e f g h i j k", "en", None, 21, 1, "x"), (2, "a b c d e f g h i j k", "en", None, 21, 1, "x")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialise(stage(spark, docs, FOLDER), "odd")
        assert docs.count() == (1 if data else 0)


def test_registered():
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries() and corpus_pipeline.ORACLE_SQL is None
