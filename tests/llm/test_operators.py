"""Each operator against plain Python over whole test tables, and on a table of edge cases."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F, types as T
from tokenizers import Tokenizer

from riskspark.llm import decontaminate as decon, jaccard_join, language_id, language_model, queries, warc
from riskspark.llm.exact_dedup import directory, exact_dedup
from riskspark.llm.line_dedup import line_dedup
from riskspark.llm.packing import binary_lengths, pack
from riskspark.llm.sharding import shard
from riskspark.llm.text import letter_words, space_words
from riskspark.llm.tokens import token_counts

SF = "/root/testdata/sf0.01"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LONG = "wordé and <|endoftext|> other. " * 4000


@pytest.fixture(scope="module")
def docs():
    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    return {r["doc_id"]: r for r in rows}


@pytest.fixture(scope="module")
def edge(spark):
    """NULLs in every column, empty and long texts, ties and repeated rows, and columns that clash with inner names."""
    rows = [(1, "a b c d e f", "en"), (1, "a b c d e f", "en"), (2, "A b c d e f", None), (None, "x y", "en"), (None, None, None)]
    rows += [(3, None, "en"), (4, "", "de"), (5, LONG, "en"), (6, "\n\n", "fr"), (7, " ", "de"), (8, "1234 !?", None)]
    schema = "doc_id long, text string, lang string, id int, key int, h int, pos int, n int, bucket int, label int, n_tokens int, a int"
    return spark.createDataFrame([(*r, *range(9)) for r in rows], schema)


@pytest.fixture(scope="module")
def empty(edge):
    return edge.where("false")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def lower(text):
    return (text or "").encode().lower()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) == ""


def test_line_dedup_edges(edge, empty):
    out = line_dedup(edge, min_docs=2)
    assert out.count() == edge.count() and line_dedup(empty).count() == 0
    got = Counter((r["id"], r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect())
    assert got[1, "", 1, 1] == 2 and got[2, "", 1, 1] == 1 and got[None, "", 1, 0] == 1 and got[6, "\n\n", 3, 0] == 1 and got[3, "", 1, 0] == 1


def test_token_counts_equal_the_library(spark, docs):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    got = by_id(queries.op2_token_counts(spark, SF))
    for i, r in docs.items():
        n = len(tokenizer.encode(r["text"], add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len(r["text"].encode()), n > 2048)


def test_token_chunks_widen_until_they_agree(spark):
    texts = [LONG, "x" * 9_000, "ab " * 2_000 + "y" * 5_000 + " cd" * 900, "中文" * 3_000, " " * 5_000 + "end", "é " * 3_000, "don't <|startoftext|>" * 700]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(token_counts(df, VOCABULARY, chunk_chars=1_000, overlap=60), "id")
    tokenizer = Tokenizer.from_file(VOCABULARY)
    assert {i: r["n_tokens"] for i, r in got.items()} == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_token_counts_edges(edge, empty):
    rows = token_counts(edge, VOCABULARY).collect()
    assert len(rows) == edge.count() and token_counts(empty, VOCABULARY).count() == 0
    assert [r["n_tokens"] for r in rows if r["id"] in (3, 4, 6, 7)] == [0] * 4


def brute_windows(text, items, window=10):
    words = letter_words((text or "").encode())
    hit, found = set(), set()
    for item, item_words in items.items():
        for at in range(max(1, len(item_words) - window + 1)) if item_words else ():
            w = item_words[at : at + window]
            for start in range(len(words) - len(w) + 1):
                if words[start : start + len(w)] == w:
                    hit.update(range(start, start + len(w)))
                    found.add(item)
    return len(words), len(hit), sorted(found, key=str)


def test_decontamination_equals_brute_force(spark, docs):
    items = {r["item_id"]: letter_words(r["text"].encode()) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()}
    first = {}
    for words in items.values():
        for at in range(max(1, len(words) - 9)):
            first.setdefault(words[at], []).append(words[at : at + 10])
    got, hits = by_id(queries.op3_decontamination(spark, SF)), 0
    for i, r in docs.items():
        words = letter_words(r["text"].encode())
        if any(words[p : p + len(w)] == w for p, x in enumerate(words) for w in first.get(x, ())):
            n, hit, found = brute_windows(r["text"], items)
            hits += 1
        else:
            n, hit, found = len(words), 0, []
        digest = hashlib.sha256(",".join(map(str, found)).encode()).hexdigest()
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"], got[i]["items_sha256"], got[i]["contaminated"]) == (n, hit, len(found), digest, hit > 0)
    assert hits > 5


@pytest.mark.parametrize("block_words", [decon.BLOCK_WORDS, 5])
def test_decontamination_in_blocks(spark, edge, empty, monkeypatch, block_words):
    monkeypatch.setattr(decon, "BLOCK_WORDS", block_words)
    items = [(1, "a b c"), (2, "B c d e"), (3, None), (None, "x y"), (4, "x"), (5, "..."), (1, "a b c"), (6, " ".join("wordé and endoftext other".split() * 5))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = {i: letter_words((t or "").encode()) for i, t in items if i is not None}
    got = [(r["id"], r["n_words"], r["n_hit"], list(r["items"])) for r in decon.decontaminate(edge, benchmark).collect()]
    want = [(r["doc_id"], *brute_windows(r["text"] if r["text"] != LONG else r["text"], texts)) for r in edge.collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=str) == sorted(want, key=str) and key
    assert decon.decontaminate(empty, benchmark).count() == 0
    assert decon.decontaminate(edge, benchmark.where("false")).where("contaminated").count() == 0


def test_directory_splits_only_overfull_buckets():
    depth, entries = directory({0: 5, 1: 5, 8: 3}, 6, max_depth=4)
    assert depth == 4 and entries == [0, 1, *[2] * 2, *[3] * 4, *[4] * 8]
    assert directory({}, 6) == (0, [0]) and directory({3: 100}, 6, max_depth=2)[0] == 2


def test_exact_dedup_edges(edge, empty):
    rows = exact_dedup(edge).collect()
    assert len(rows) == edge.count() and exact_dedup(empty).count() == 0
    kept = Counter((r["keep_id"], r["group_size"]) for r in rows if r["kept"])
    assert kept == Counter({(2, 3): 1, (None, 1): 1, (4, 3): 1, (5, 1): 1, (6, 1): 1, (7, 1): 1, (8, 1): 1})


def test_exact_dedup_chains_one_hash(spark, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr("riskspark.llm.exact_dedup.F.xxhash64", lambda *c: real(*c) % 2)
    df = spark.createDataFrame([(i, f"text {i % 9}") for i in range(90)], "doc_id long, text string")
    got = by_id(exact_dedup(df), "id")
    assert all(got[i]["keep_id"] == 81 + i % 9 and got[i]["group_size"] == 10 for i in range(90))


def test_warc_round_trip(spark):
    pages = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    groups = defaultdict(list)
    for p in pages:
        groups[p["html"]].append(p["page_id"])
    got = by_id(queries.op5_warc(spark, SF), "page_id")
    assert len(got) == len(pages)
    for p in pages:
        first, raw = min(groups[p["html"]]), p["html"].encode()
        own = p["page_id"] == first
        want = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if own else "revisit", None if own else first)
        assert tuple(got[p["page_id"]])[1:] == want


def test_warc_rejects_records_inside_payloads(spark):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "u", fake, 0), (2, None, "tail " + fake + fake, 0), (3, "u\r\nx: y", None, 0), (4, "u", "", 0), (5, "u", fake, 0), (6, "u", "é" * 50_000, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, body int")
    got = by_id(warc.round_trip(df), "id")
    assert {i: (r["record_type"], r["refers_to"], r["payload_bytes"]) for i, r in got.items()} == {
        "1": ("response", None, len(fake)), "2": ("response", None, 5 + 2 * len(fake)), "3": ("response", None, 0),
        "4": ("revisit", "3", 0), "5": ("revisit", "1", len(fake)), "6": ("response", None, 100_000),
    }
    assert warc.round_trip(df, min_bytes=1).where("record_type = 'revisit'").count() == 1
    assert warc.round_trip(df.where("false")).count() == 0


def test_packing_equals_the_library(spark, docs):
    tokenizer, pieces = Tokenizer.from_file(VOCABULARY), defaultdict(list)
    rows = queries.op6_packing(spark, SF).collect()
    for r in rows:
        pieces[r["doc_id"]].append(r)
    assert len({r["sequence_id"] for r in rows}) == len(rows) and all(r["offset"] == 0 for r in rows)
    for i, d in docs.items():
        ids = tokenizer.encode(d["text"], add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            part = b"".join(x.to_bytes(4, "little") for x in ids[at : at + r["length"]])
            assert (r["start"], r["ids_crc32"], r["doc_tokens"]) == (at, zlib.crc32(part), len(ids))
            assert r["length"].bit_count() == 1 and r["length"] <= 2048
            at += r["length"]
        assert at == len(ids)


def test_packing_edges(edge, empty):
    rows = pack(edge, VOCABULARY, longest=8).collect()
    assert sorted(r["id"] for r in rows if r["doc_tokens"] == 1 and r["id"]) == [3, 4, 6, 7] and pack(empty, VOCABULARY).count() == 0
    assert all(list(r["ids"])[-1] == 1 for r in rows if r["doc_tokens"] == 1)
    assert binary_lengths(8 * 2 + 5, 8) == [8, 8, 4, 1] and binary_lengths(0, 8) == []


def test_packing_crc_is_of_the_stored_ids(edge):
    for r in pack(edge, VOCABULARY, longest=8).collect():
        assert len(r["ids"]) == r["length"]
        assert r["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in r["ids"]))


def brute_components(texts, n, percent):
    sets = {}
    for i, t in texts.items():
        words = space_words((t or "").encode())
        sets[i] = {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()
    posting, parent = defaultdict(list), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            posting[x].append(i)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in posting[x] if j > i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_jaccard_join_equals_brute_force(spark, docs):
    got = queries.op7_jaccard_join(spark, SF).collect()
    want = brute_components({i: d["text"] for i, d in docs.items()}, 4, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len({c for _, c in want.values()}) < len(want) - 50


@pytest.mark.parametrize("frequent", [0, 3, 32])
@pytest.mark.parametrize("n,percent", [(5, 80), (2, 85), (1, 75)])
def test_jaccard_join_of_changed_copies(spark, monkeypatch, frequent, n, percent):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    import random

    rng, rows = random.Random(frequent + n), []
    bases = [[f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 60))] for _ in range(6)]
    for i in range(240):
        words = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_join.near_duplicates(df, n, percent).collect()
    assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(dict(rows), n, percent)


def test_parities_never_exceed_the_difference():
    import numpy as np

    rng = np.random.default_rng(1)
    for n, m, shared in [(0, 0, 0), (1, 3, 1), (40, 45, 38), (500, 560, 480), (3000, 900, 700), (5000, 5100, 0)]:
        tokens = rng.integers(0, 1 << 63, n + m - shared, dtype=np.uint64)
        x, y = jaccard_join.parities(tokens[:n]), jaccard_join.parities(tokens[n - shared :])
        differing = n + m - 2 * shared
        assert jaccard_join.least_differing(x, y) == jaccard_join.least_differing(y, x) <= differing
        assert jaccard_join.least_differing(x, x) == 0
    # 100 tokens differ; in 1,024 classes about 512 (1 - exp(-200 / 1024)) = 91 of them are expected to show.
    assert 75 < jaccard_join.least_differing(jaccard_join.parities(tokens[:500]), jaccard_join.parities(tokens[50:550])) <= 100


def test_jaccard_join_edges(edge, empty):
    rows = jaccard_join.near_duplicates(edge).collect()
    assert len(rows) == edge.count() and jaccard_join.near_duplicates(empty).count() == 0
    got = Counter((r["id"], r["n_shingles"], r["component_id"]) for r in rows)
    assert got[1, 2, 1] == 2 and got[2, 2, 1] == 1 and got[3, 0, 3] == 1 and got[4, 0, 4] == 1 and got[None, 1, None] == 1


def test_sharding(spark, docs, edge, empty):
    rows = queries.op8_sharding(spark, SF).collect()
    slots = defaultdict(list)
    for r in rows:
        text = docs[r["doc_id"]]["text"].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 16, zlib.crc32(text)) and r["grown_shard"] in (r["shard"], 40)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(40))
    assert 5 <= sum(r["grown_shard"] == 40 for r in rows) <= 60
    assert shard(edge, [1.0, 2.0]).count() == edge.count() and shard(empty, [1.0]).count() == 0
    heavy = shard(spark.range(20_000).selectExpr("id doc_id", "'x' text"), [1.0, 3.0]).where("shard = 1").count()
    assert 14_500 < heavy < 15_500


def test_language_id_on_held_out_documents(spark, docs):
    rows = queries.op9_language_id(spark, SF).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r["held_out"]]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == r["held_out"] and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.97 * len(held)


def test_language_id_backs_off_and_edges(spark, edge, empty):
    model = language_id.fit(spark.createDataFrame([(1, "the thing", "en"), (2, "der dinge", "de"), (3, "x", None)], "doc_id long, text string, lang string"))
    assert set(model.words) == {"the", "thing", "der", "dinge"} and model.langs == ["de", "en"]
    assert model.word("thin").argmax() == 1 and model.word("dingen").argmax() == 0 and not model.word("日本").any()
    rows = language_id.identify(edge, model).collect()
    assert {(r["lang_pred"], r["score"]) for r in rows if r["id"] in (3, 4, 6, 7, 8)} == {("und", 0.0)}
    assert language_id.identify(empty, language_id.fit(empty)).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(edge, language_id.fit(empty)).collect()} == {"und"}


def brute_log_prob(text, vocab, weights):
    import numpy as np

    vectors, b, out, c = language_model.Network(weights).parts
    ranks = [vocab.rank.get(w, len(vocab.rank)) for w in letter_words((text or "").encode())]
    cell = lambda i: vocab.cell[ranks[i]] if 0 <= i < len(ranks) else language_model.EDGE_CELL
    total = 0.0
    for i, r in enumerate(ranks):
        h = np.tanh(b + sum(vectors[k][cell(i + s)] for k, s in enumerate(language_model.CONTEXT)))
        z = h @ out + c
        total += z[vocab.group[r]] - np.log(np.exp(z).sum()) + vocab.within[r]
    return len(ranks), total


def test_language_model(spark, docs, edge, empty):
    df = queries.table(spark, SF, "documents")
    model = language_model.fit(df)
    got = by_id(language_model.score(df, model), "id")
    for i in list(docs)[:40]:
        n, total = brute_log_prob(docs[i]["text"], *model)
        assert got[i]["n_tokens"] == n and abs(got[i]["log_prob"] - total) < 1e-3 * (1 + abs(total))
    untrained = by_id(language_model.score(df, (model[0], language_model.Network().flat)), "id")
    mean = lambda rows: sum(r["log_prob"] for r in rows.values()) / sum(r["n_tokens"] for r in rows.values())
    assert mean(got) > mean(untrained) + 0.5
    rows = language_model.score(edge, model).collect()
    assert len(rows) == edge.count() and all((r["log_prob"], r["mean_log_prob"]) == (0, None) for r in rows if r["id"] in (3, 4, 6, 7))
    assert language_model.score(empty, language_model.fit(empty)).count() == 0
    assert isinstance(df.schema["text"].dataType, T.StringType)
