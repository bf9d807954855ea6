"""Shards and languages worked out again in plain Python, and archives and stages on awkward rows."""

import gzip
import math
import struct
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import functions as F
from test_operators import SF, by_id

import corpus_pipeline
from riskspark.llm import language_id, queries, warc
from riskspark.llm.sharding import shard


def plain_shard(key, weights):
    """The highest -weight / ln(u), u from the 64-bit hash of the key and then of the shard's number."""

    def score(i):
        h = xxhash.xxh64(struct.pack("<i", i), seed=xxhash.xxh64(key.encode(), seed=42).intdigest()).intdigest()
        return -weights[i] / math.log(((h >> 11) + 0.5) / (1 << 53)), i

    return max(map(score, range(len(weights))))[1]


def test_shards_are_recomputed(spark):
    rows = queries.op8_sharding(spark, SF).collect()
    for r in rows:
        assert (r["shard"], r["grown_shard"]) == (plain_shard(str(r["doc_id"]), [1.0] * 40), plain_shard(str(r["doc_id"]), [1.0] * 41))
    weights = [1.0, 2.5, 0.5]
    for r in shard(spark.range(300).selectExpr("id doc_id", "'x' text"), weights).collect():
        assert r["shard"] == plain_shard(str(r["id"]), weights)


def test_slots_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a")] * 7 + [(None, None)] * 5 + [(2, "b")], "doc_id long, text string").repartition(3)
    slots = defaultdict(list)
    for r in shard(df, [1.0]).collect():
        slots[r["id"]].append(r["slot"])
    assert sorted(x for s in slots.values() for x in s) == list(range(13)) and {k: len(v) for k, v in slots.items()} == {1: 7, None: 5, 2: 1}


def test_languages_are_recomputed(spark):
    """Every word by itself: its own row of the model, or the mean of its longest known n-grams."""
    docs = queries.table(spark, SF, "documents")
    model = language_id.fit(docs.where(~queries.held_out()))
    got, evidence = by_id(language_id.identify(docs, model), "id"), {}

    def of(word):
        if word in model.words:
            return model.scores[model.words[word]].astype(float)
        for n in sorted(model.grams, reverse=True):
            found = [model.scores[model.grams[n][g]] for i in range(len(word) + 3 - n) if (g := f" {word} "[i : i + n]) in model.grams[n]]
            if found:
                return np.mean(found, axis=0, dtype=float)
        return np.zeros(len(model.langs))

    for d in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        words = language_id.words_of(d["text"] or "")
        if not words:
            assert (got[d["doc_id"]]["lang_pred"], got[d["doc_id"]]["score"]) == ("und", 0.0)
            continue
        total = sum(n * evidence.setdefault(w, of(w)) for w, n in Counter(words).items()) * min(1.0, 20 / len(words))
        share = np.exp(total - total.max()) / np.exp(total - total.max()).sum()
        row = got[d["doc_id"]]
        assert abs(row["score"] - share.max()) < 1e-4
        assert row["lang_pred"] == model.langs[int(total.argmax())] or np.sort(share)[-2] > share.max() - 1e-4


def summary(df):
    return Counter((r["id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in df.collect())


def test_long_headers_and_payloads_lose_no_record(spark):
    rows = [(i, "u" * (100_000 if i == 4 else 10), f"page {i % 9}" if i != 7 else "x" * 3_000_000) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = summary(warc.round_trip(df))
    assert sum(got.values()) == 12 and {k[0] for k in got} == {str(i) for i in range(12)}
    assert got["7", "response", None, 3_000_000] == 1 and got["9", "revisit", "0", 6] == 1 and got["10", "revisit", "1", 6] == 1


def test_repeated_rows_shared_and_missing_ids(spark):
    rows = [(1, "a"), (1, "a"), (2, "a"), (3, "b"), (1, "b"), (None, "a"), (None, "c"), (None, "c"), (5, None), (6, "")]
    df = spark.createDataFrame([(i, None, h, 1) for i, h in rows], "page_id long, url string, html string, key int")
    want = [("1", "response", None, 1)] * 3 + [("2", "revisit", "1", 1), ("3", "revisit", "1", 1), (None, "revisit", "1", 1)]
    want += [(None, "response", None, 1)] * 2 + [("5", "response", None, 0), ("6", "revisit", "5", 0)]
    assert summary(warc.round_trip(df)) == Counter(want)


def test_a_cut_off_archive_keeps_the_records_before(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"payload {i}") for i in range(6)], "page_id long, url string, html string").coalesce(1)
    warc.write_warc(df, str(tmp_path / "whole"))
    (archive,) = (tmp_path / "whole").rglob("*.gz")
    data = gzip.decompress(archive.read_bytes())
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "a.warc").write_bytes(data[: data.rindex(b"payload") + 3])
    last = data[data.rindex(b"<urn:page:") :][len(b"<urn:page:") :][:1].decode()
    assert sorted(r["id"] for r in warc.resolve(warc.read_warc(spark, str(tmp_path / "cut"))).collect()) == sorted({*"012345"} - {last})


def test_large_records_have_archives_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1 << 14)
    monkeypatch.setattr(warc, "RECORDS_PER_ARCHIVE", 4)
    df = spark.createDataFrame([(i, "u", chr(65 + i) * (20_000 if i < 3 else 5)) for i in range(11)], "page_id long, url string, html string").coalesce(1)
    warc.write_warc(df, str(tmp_path / "w"))
    counts = sorted(gzip.decompress(p.read_bytes()).count(b"WARC/1.1\r\n") for p in (tmp_path / "w").rglob("*.gz"))
    assert counts == [1, 1, 1, 4, 4]
    assert warc.resolve(warc.read_warc(spark, str(tmp_path / "w"))).count() == 11


def test_stages_judge_rows_that_share_an_id_by_themselves(spark):
    benchmark = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()[0]["text"]
    rows = [(1, "a common text of words"), (1, "another text of many words"), (2, "another text of many words"), (2, "Another text of many words")]
    rows += [(3, benchmark), (3, "clean words in a row"), (4, "1234"), (4, "letters here"), (None, "nobody has this id"), (None, None)]
    df = spark.createDataFrame([(i, t, "en", 1, 2) for i, t in rows], "doc_id long, text string, lang string, _key int, id int")
    stages = dict(corpus_pipeline.STAGES)
    kept = lambda name, docs: Counter((r["doc_id"], r["text"]) for r in stages[name](spark, docs, SF).collect())
    assert kept("language_id", df) == Counter(r for r in rows if r[1] not in ("1234", None))
    exact = kept("exact_dedup", df)
    assert exact == Counter(r for r in rows[:1] + rows[4:]) + Counter([next(k for k in exact if k[0] == 2)])
    clean = kept("decontamination", df)
    assert clean == Counter(r for r in rows if r[1] != benchmark)


def test_the_language_stage_loses_exactly_texts_without_letters(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, SF).select("doc_id").collect()}
    want = {r["doc_id"] for r in docs.collect() if language_id.words_of(r["text"] or "")}
    assert kept == want


def test_nothing_is_learned_without_labels(spark):
    df = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert corpus_pipeline.language_id(spark, df, SF).count() == 0
    assert corpus_pipeline.language_id(spark, df.where("false").select("doc_id", "text", "lang", F.lit(1).alias("x")), SF).columns[-1] == "x"
