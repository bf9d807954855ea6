"""The stages against plain Python on their own inputs."""

import pyarrow.parquet as pq
import pytest
from test_operators import SF, VOCABULARY, brute_components, brute_windows, lower
from tokenizers import Tokenizer

import corpus_pipeline
from riskspark.llm.exact_dedup import _chain, _combine
from riskspark.llm.jaccard_join import _per_text
from riskspark.llm.text import letter_words
from riskspark.llm.tokens import Encoder


def test_stages(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.cut_lineage(stage(spark, docs, SF), "test-stage")
        assert out.columns == docs.columns
        kept[name], docs = {r["doc_id"]: r for r in out.collect()}, out
    languages = {r["doc_id"]: r["text"] for r in kept["language_id"].values()}
    assert len(languages) >= 995
    groups = {}
    for i, t in languages.items():
        groups[lower(t)] = max(i, groups.get(lower(t), i))
    assert set(kept["exact_dedup"]) == set(groups.values())
    components = brute_components({i: r["text"] for i, r in kept["exact_dedup"].items()}, 5, 80)
    assert set(kept["jaccard_join"]) == {i for i, (_, c) in components.items() if c == i}
    items = {r["item_id"]: letter_words(r["text"].encode()) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()}
    dropped = set(kept["jaccard_join"]) - set(kept["decontamination"])
    assert dropped and all(brute_windows(kept["jaccard_join"][i]["text"], items)[1] for i in dropped)
    spans = corpus_pipeline.packing(spark, docs, SF).groupBy("doc_id").sum("length").collect()
    assert {r["doc_id"] for r in spans} == set(kept["decontamination"])


def test_packed_rows_hold_all_ids_of_their_texts(spark):
    docs = corpus_pipeline.table(spark, SF, "documents").limit(50)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    tokenizer, pieces = Tokenizer.from_file(VOCABULARY), {i: [] for i in texts}
    for r in sorted(corpus_pipeline.packing(spark, docs, SF).collect(), key=lambda r: r["start"]):
        pieces[r["doc_id"]] += r["ids"]
    assert pieces == {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in texts.items()}


def test_stages_on_edge_cases(spark):
    rows = [(1, "one two three", "en", 9), (1, "one two three", "en", 9), (None, "some words here", None, 9), (3, None, None, 9), (4, "", "en", 9), (5, "12", "de", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, _kept_id int")
    for docs in (df, df.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF), "edge-stage")
        assert docs.select("doc_id").distinct().count() == (2 if docs.count() else 0)


def test_a_tokenizer_leaves_the_worker_when_another_operator_begins():
    for task in (_combine, _chain, _per_text(5, lambda ids, sets: None)):
        assert Encoder.of(VOCABULARY).count("some words") > 1 and Encoder._held
        list(task(iter(())) if task is not _chain else _begun(task))
        assert not Encoder._held
    assert Encoder.of(VOCABULARY).count("some words") > 1


def _begun(task):
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr("riskspark.llm.exact_dedup.TaskContext", type("Task", (), {"get": staticmethod(lambda: type("One", (), {"partitionId": lambda self: 0})())}))
        return list(task(iter(())))


def test_pipeline_stages_take_small_batches(spark, sf_dir, monkeypatch):
    """Every stage runs with small Arrow batches; a user's own setting stands, and the session's is as before in the end."""
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []

    def stage(session, docs, where):
        seen.append(session.conf.get(name))
        return docs.limit(3)

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("two", stage)])
    before = spark.conf.getAll.get(name)
    try:
        for own, within in ((None, "4194304"), ("16777216", "4194304"), ("1000000", "1000000")):
            spark.conf.unset(name) if own is None else spark.conf.set(name, own)
            seen.clear()
            assert corpus_pipeline.run(spark, sf_dir).count() == 3
            assert seen == [within, within] and spark.conf.getAll.get(name) == own
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
