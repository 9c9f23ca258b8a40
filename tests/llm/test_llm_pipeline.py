import corpus_pipeline
from calipers.llm import ngram_join
from calipers.llm.common import settle

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        after = settle(stage(spark, docs, DIR))
        counts.append(after.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == list(corpus_pipeline.COLUMNS)
            docs = after
        if name == "ngram_jaccard_join":
            assert ngram_join.similar(after).filter("doc_id <> component_id").count() == 0
    assert counts[0] >= counts[1] == counts[2] >= counts[3] == counts[4] == counts[5] > 0


def test_stages_take_nulls_and_nothing(spark):
    from corpus_cases import documents

    for docs in (documents(spark), documents(spark).filter("false")):
        for _, stage in corpus_pipeline.STAGES:
            docs = settle(stage(spark, docs, DIR))


def test_unlike_rows_of_one_id_are_judged_apart(spark):
    words = lambda tag, n=40: " ".join(f"{tag}{i}" for i in range(n))
    rows = [
        (5, words("a")), (5, words("b")), (5, words("b")), (2, words("b")), (None, words("c")), (None, words("d")), (None, words("a")),
        (7, words("d")), (8, words("e")), (8, words("e") + " more"), (9, None), (9, None), (9, ""),
    ]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, df, DIR).collect()]
    texts = {i: [t for j, t in got if j == i] for i in (2, 5, 7, 8, 9, None)}
    assert texts[2] == [words("b")] and texts[5] == [words("a")] and texts[7] == [words("d")] and texts[None] == [words("c")]
    assert len(texts[8]) == 1 and sorted(texts[9], key=str) == ["", None]
    assert len(got) == 7


def test_python_workers_take_few_bytes_at_a_time_and_forget(spark):
    """Batches are bounded by bytes unless the session says otherwise, and a waiting tokenizer holds no words."""
    import json

    import pyarrow as pa
    from calipers.llm import bpe, common

    before = spark.conf.get(common.BATCH_SETTING, None)
    spark.conf.unset(common.BATCH_SETTING)
    try:
        common.table(spark, DIR, "documents")
        sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches)
        wide = spark.range(0, 8_000, 1, 1).selectExpr("repeat('x', 2000) AS text")
        got = [r["n"] for r in wide.mapInArrow(sizes, "n long").collect()]
        assert len(got) > 3 and max(got) < 1.5 * common.BATCH_BYTES
        spark.conf.set(common.BATCH_SETTING, "1000000")
        common.table(spark, DIR, "documents")
        assert spark.conf.get(common.BATCH_SETTING) == "1000000"
    finally:
        spark.conf.set(common.BATCH_SETTING, before) if before else spark.conf.unset(common.BATCH_SETTING)
    encoder = bpe.Bpe(json.dumps({"model": {"vocab": {bpe_letter: b for bpe_letter, b in bpe.byte_letters().items()}, "merges": []}, "added_tokens": []}))
    want = list(encoder.encode(["some words, some more"]))
    encoder.forget()
    assert not encoder.known and not encoder.pairs and list(encoder.encode(["some words, some more"])) == want


def test_texts_are_searched_and_cut_by_one_worker(spark):
    """One Python step for a benchmark of one block, the same texts whatever the blocks are."""
    from calipers.llm import decontaminate

    docs, benchmark = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    found = decontaminate.cleaned(docs, benchmark)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    rows = lambda df: sorted((r["row"]["doc_id"], r["text"] or "") for r in df.collect())
    want = rows(decontaminate.spans_removed(decontaminate.search(docs, benchmark)))
    assert rows(found) == want and rows(decontaminate.cleaned(docs, benchmark, most=300)) == want
    assert want != sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
