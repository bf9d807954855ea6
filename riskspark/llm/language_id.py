"""Language identification: known words first, then shorter and shorter character n-grams."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.text import begin_task, bounded_batches, id_and_text
from riskspark.session import cut_lineage

UNKNOWN = "und"
_ASCII_WORD = re.compile(r"[a-z]+")
#: Words whose evidence a worker remembers, words that are worked out together, and words of a text that are summed together.
MEMO_WORDS, WORD_BLOCK, SUM_BLOCK = 300_000, 4_096, 4_096
#: Characters of the texts that are split into words together.
BLOCK_CHARS = 1_000_000


@dataclass
class LanguageModel:
    """Log frequencies per language. ``words`` and every entry of ``grams`` map a string to its row of ``scores``."""

    langs: list[str]
    words: dict[str, int]
    grams: dict[int, dict[str, int]]
    scores: np.ndarray

    def word(self, word: str) -> np.ndarray:
        """Scores of one word: its own, or those of its n-grams."""
        return self.scores[self.words[word]] if word in self.words else Predictor(self).backed_off([word])[0]


class Predictor:
    """A model at work, with the evidence of the words it has seen so far. A worker's tasks share it."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.clear()

    @classmethod
    def of(cls, model: LanguageModel) -> "Predictor":
        if "predictor" not in model.__dict__:
            model.__dict__["predictor"] = cls(model)
        return model.__dict__["predictor"]

    def clear(self) -> None:
        """Forget all but the model's own words, which are the first rows of its scores."""
        self.row = dict(self.model.words)
        self.scores = self.model.scores[: len(self.row)]

    def backed_off(self, words: list[str]) -> np.ndarray:
        """Rows for unseen words: the mean over a word's longest n-grams that the model knows any of, else zeros."""
        out = np.zeros((len(words), len(self.model.langs)), np.float32)
        for start in range(0, len(words), WORD_BLOCK):
            open_words = [(at, f" {w} ") for at, w in enumerate(words[start : start + WORD_BLOCK], start)]
            for n in sorted(self.model.grams, reverse=True):
                get, done, rows, counts, rest = self.model.grams[n].get, [], [], [], []
                for at, padded in open_words:
                    found = [r for i in range(len(padded) - n + 1) if (r := get(padded[i : i + n])) is not None]
                    if found:
                        done.append(at)
                        counts.append(len(found))
                        rows += found
                    else:
                        rest.append((at, padded))
                if done:
                    begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
                    out[done] = np.add.reduceat(self.model.scores[rows], begins, axis=0) / np.array(counts, np.float32)[:, None]
                open_words = rest
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """For every text the best language and its share of the evidence."""
        langs = self.model.langs
        if not langs:
            return [(UNKNOWN, 0.0)] * len(texts)
        if len(self.row) > MEMO_WORDS:
            self.clear()
        words = [words_of(t or "") for t in texts]
        unseen = list(set(chain.from_iterable(words)).difference(self.row))
        if unseen:
            self.row.update(zip(unseen, range(len(self.row), len(self.row) + len(unseen))))
            self.scores = np.concatenate([self.scores, self.backed_off(unseen)])
        out = []
        for of_text in words:
            if not of_text:
                out.append((UNKNOWN, 0.0))
                continue
            at = np.fromiter(map(self.row.__getitem__, of_text), np.int64, len(of_text))
            total = sum(self.scores[at[i : i + SUM_BLOCK]].sum(axis=0, dtype=np.float64) for i in range(0, len(at), SUM_BLOCK))
            # A word's evidence counts in full in short texts; in long ones the mean of 20 words is taken.
            total = total * min(1.0, 20.0 / len(at))
            best = int(np.argmax(total))
            out.append((langs[best], float(1.0 / np.exp(np.clip(total - total[best], -700, 0)).sum())))
        return out


def _blocks(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of about BLOCK_CHARS in all; a longer text is one by itself or ends one."""
    block, chars = [], 0
    for text in texts:
        block.append(text)
        chars += len(text or "")
        if chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    yield block


@cache
def _word() -> re.Pattern:
    """A letter and the letters and marks that follow it, with the classes of characters spelled out as ranges."""

    def ranges(kinds: str) -> str:
        mine = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] in kinds]
        ends = [c for c, d in zip(mine, [*mine[1:], -1]) if d != c + 1]
        begins = [c for c, d in zip(mine, [-1, *mine[:-1]]) if d != c - 1]
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(begins, ends))

    return re.compile(f"[{ranges('L')}][{ranges('LM')}]*")


def words_of(text: str) -> list[str]:
    """Letters with the letters and marks that follow them, in lower case."""
    return (_ASCII_WORD if text.isascii() else _word()).findall(text.lower())


def _log_frequencies(counts: dict[str, dict[int, int]], n_langs: int) -> dict[str, np.ndarray]:
    """Per string and language log((count + 1) / (total + kinds)), less the mean over languages."""
    totals = np.zeros(n_langs)
    for by_lang in counts.values():
        for i, n in by_lang.items():
            totals[i] += n
    out = {}
    for key, by_lang in counts.items():
        row = np.full(n_langs, 0.5)
        for i, n in by_lang.items():
            row[i] += n
        scores = np.log(row / (totals + 0.5 * max(len(counts), 1)))
        out[key] = (scores - scores.mean()).astype(np.float32)
    return out


def fit(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", per_lang: int = 1_000, max_words: int = 60_000, max_grams: int = 60_000, longest: int = 5) -> LanguageModel:
    """Learn from about ``per_lang`` documents of each language, those whose ids have the lowest hashes, whole texts.

    Spark counts words and n-grams; the model keeps the ``max_words`` commonest words and, for every length, the
    ``max_grams`` commonest n-grams, and so has a bounded size. Rows without language or text teach nothing. Languages
    beyond the 1,000 commonest are not learned. Every language weighs the same, however many documents it has.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    rows = rows.where("lang is not null and text is not null")
    langs = sorted(r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(1_000).collect())
    if not langs:
        return LanguageModel([], {}, {}, np.empty((0, 0), np.float32))
    number = {lang: i for i, lang in enumerate(langs)}
    order = F.xxhash64(F.col("id").cast("string"), F.lit(11))
    lowest = rows.select("lang", order.alias("h")).groupBy("lang").agg(F.count("*").alias("n"))
    share = {r["lang"]: min(1.0, per_lang / r["n"]) for r in lowest.collect()}
    limit = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(int((share[lang] * 2 - 1) * (1 << 63)), (1 << 63) - 1))])
    sample = rows.where(order <= F.element_at(limit, F.col("lang"))).select("lang", "text")

    def counted(batches):
        begin_task()
        for batch in batches:
            words: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.update((number[lang], w) for w in words_of(text))
            counts: Counter = Counter()
            for (lang, word), n in words.items():
                counts[lang, 0, word] += n
                padded = f" {word} "
                for size in range(1, longest + 1):
                    for at in range(len(padded) - size + 1):
                        counts[lang, size, padded[at : at + size]] += n
            keys = list(counts)
            columns = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.string()), pa.array(list(counts.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "size", "key", "n"])

    pairs = sample.mapInArrow(counted, "lang int, size int, key string, n long").groupBy("size", "key", "lang").agg(F.sum("n").alias("n"))
    each = pairs.groupBy("size", "key").agg(F.sum("n").alias("all"), F.collect_list(F.struct("lang", "n")).alias("by"))
    each = cut_lineage(each, "language-counts")
    rows: dict[int, dict[str, int]] = {}
    scores, filled = [np.empty((0, len(langs)), np.float32)], 0
    for size in range(longest + 1):
        kept = each.where(F.col("size") == size).orderBy(F.desc("all"), "key").limit(max_grams if size else max_words).collect()
        table = _log_frequencies({r["key"]: {x["lang"]: x["n"] for x in r["by"]} for r in kept}, len(langs))
        rows[size] = {key: filled + i for i, key in enumerate(table)}
        scores += table.values()
        filled += len(table)
    return LanguageModel(langs, rows.pop(0), rows, np.vstack(scores))


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Predict from the text alone: (id, lang_pred, score), one row per input row, without any shuffle.

    A word that the model knows scores by its log frequency in each language. An unseen word backs off to its longest
    character n-grams that the model knows, down to single characters. ``score`` is the winner's posterior. A text
    that is NULL or has no letter is ``und`` with score 0; a tie goes to the first language in sorted order.
    """
    rows = id_and_text(docs, id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches):
        predictor = Predictor.of(held.value)
        for batch in batches:
            pairs = [p for block in _blocks(batch.column(1).to_pylist()) for p in predictor.predict(block)]
            columns = [batch.column(0), pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "lang_pred", "score"])

    return rows.mapInArrow(predicted, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double")


def in_known_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The whole rows whose text is in a language of the model, stored: all but those that ``identify`` calls ``und``.

    Rows are predicted and filtered in one pass without a shuffle. A task forgets its words when it ends, and the model leaves
    the workers once the rows are stored, so that later stages find their memory free.
    """
    bounded_batches(docs.sparkSession)
    held, text_at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def kept(batches):
        begin_task()
        predictor = Predictor(held.value)
        for batch in batches:
            known = [lang != UNKNOWN for block in _blocks(batch.column(text_at).to_pylist()) for lang, _ in predictor.predict(block)]
            yield batch.filter(pa.array(known, pa.bool_()))

    stored = cut_lineage(docs.mapInArrow(kept, docs.schema), "in-language")
    held.destroy()
    return stored
