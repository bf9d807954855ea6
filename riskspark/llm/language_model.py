"""Scoring of documents by a masked language model: a bidirectional window network trained on the whole corpus."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.text import id_and_text, letter_words

#: Words to the left and right that predict the one between them.
CONTEXT = (-2, -1, 1, 2)
OWN_CELLS, CELLS, WIDTH = 192, 256, 16
UNSEEN_CELL, EDGE_CELL = CELLS - 2, CELLS - 1
CLASSES = 64
STEP_TOKENS = 2_048


@dataclass
class Vocabulary:
    """The commonest words by rank, with what the network sees of a word (``cell``) and predicts of it (``group``).

    ``within`` is the log probability of a word in its group by corpus counts; the last rank stands for all
    other words of the corpus and for words it does not have.
    """

    rank: dict[bytes, int]
    cell: np.ndarray
    group: np.ndarray
    within: np.ndarray


def vocabulary(counts: list[tuple[bytes, int]], total: int, kinds: int) -> Vocabulary:
    """From the commonest words in order, the number of all tokens and of all different words."""
    n = np.array([c for _, c in counts] + [0.0])
    n[-1] = max(total - n.sum(), 1.0)
    before = np.concatenate([[0.0], np.cumsum(n)[:-1]]) / n.sum()
    group = np.minimum((before * CLASSES).astype(np.int64), CLASSES - 1)
    mass = np.bincount(group, n, CLASSES)
    within = np.log(n / mass[group])
    within[-1] -= np.log(max(kinds - len(counts), 1))
    at = np.arange(len(n))
    # Beyond the words with a cell of their own, a cell holds ranks of one range of the logarithm.
    shared = OWN_CELLS + np.log2(np.maximum(at - OWN_CELLS, 0) + 1) * 4
    cell = np.where(at < OWN_CELLS, at, np.minimum(shared, UNSEEN_CELL - 1)).astype(np.int64)
    cell[-1] = UNSEEN_CELL
    return Vocabulary({w: i for i, (w, _) in enumerate(counts)}, cell, group, within)


class Network:
    """``softmax(tanh(sum of the context's position vectors + b) W + c)`` over word groups, in single precision."""

    SHAPES = ((len(CONTEXT), CELLS, WIDTH), (WIDTH,), (WIDTH, CLASSES), (CLASSES,))

    def __init__(self, flat: np.ndarray | None = None):
        if flat is None:
            random = np.random.default_rng(7)
            flat = np.concatenate([random.normal(0, 0.1, int(np.prod(s))) for s in self.SHAPES])
        self.flat = np.array(flat, np.float32)
        self.parts = Network.views(self.flat)

    def forward(self, cells: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden layer and log probabilities of all groups at the places ``at`` of a padded sequence."""
        vectors, b, out, c = self.parts
        hidden = np.tile(b, (len(at), 1))
        for k, shift in enumerate(CONTEXT):
            hidden += vectors[k][cells[at + shift]]
        np.tanh(hidden, out=hidden)
        logits = hidden @ out + c
        logits -= logits.max(axis=1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return hidden, logits

    def learn(self, cells: np.ndarray, at: np.ndarray, target: np.ndarray, squares: np.ndarray, rate: float = 0.1) -> None:
        """One Adagrad step on the mean loss; ``squares`` holds the sums of squared gradients."""
        hidden, log_p = self.forward(cells, at)
        error = np.exp(log_p)
        error[np.arange(len(at)), target] -= 1
        error /= len(at)
        back = (error @ self.parts[2].T) * (1 - hidden * hidden)
        gradient = np.empty_like(self.flat)
        parts = Network.views(gradient)
        for k, shift in enumerate(CONTEXT):
            places = cells[at + shift]
            for d in range(WIDTH):
                parts[0][k, :, d] = np.bincount(places, back[:, d], CELLS)
        parts[1][:], parts[2][:], parts[3][:] = back.sum(0), hidden.T @ error, error.sum(0)
        squares += gradient * gradient
        self.flat -= rate * gradient / np.sqrt(squares + 1e-8)

    @classmethod
    def views(cls, flat: np.ndarray) -> list[np.ndarray]:
        ends = np.cumsum([int(np.prod(s)) for s in cls.SHAPES])
        return [flat[e - int(np.prod(s)) : e].reshape(s) for e, s in zip(ends, cls.SHAPES)]


def _encoded(texts: list[str | None], vocab: Vocabulary):
    """Ranks of all texts behind one another, the padded cells, and for every token its place in the latter."""
    rest, get = len(vocab.rank), vocab.rank.get
    ranks = [np.array([get(w, rest) for w in letter_words((t or "").encode())], np.int64) for t in texts]
    lengths = np.array([len(r) for r in ranks], np.int64)
    flat = np.concatenate(ranks) if ranks else np.empty(0, np.int64)
    edge = max(map(abs, CONTEXT))
    at = np.arange(len(flat)) + edge * (1 + np.repeat(np.arange(len(ranks)), lengths))
    cells = np.full(len(flat) + edge * (len(ranks) + 1), EDGE_CELL, np.int64)
    cells[at] = vocab.cell[flat]
    return flat, lengths, cells, at


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over whole texts; tasks sum within a batch before rows move."""

    def counted(batches):
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                counts.update(letter_words((text or "").encode()))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return docs.select("text").mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _trained(docs: DataFrame, vocab: Vocabulary, start: np.ndarray | None) -> np.ndarray:
    """Every task trains a copy on all its texts; the weights are averaged by tokens, as an aggregate over tasks."""
    held = docs.sparkSession.sparkContext.broadcast((vocab, start))

    def trained(batches):
        known, first = held.value
        network, squares, seen = Network(first), np.full(Network().flat.shape, 1e-4, np.float32), 0
        for batch in batches:
            flat, _, cells, at = _encoded(batch.column(0).to_pylist(), known)
            for i in range(0, len(flat), STEP_TOKENS):
                network.learn(cells, at[i : i + STEP_TOKENS], known.group[flat[i : i + STEP_TOKENS]], squares)
            seen += len(flat)
        if seen:
            weights = network.flat.astype(np.float64)
            columns = [pa.array(np.arange(len(weights), dtype=np.int32)), pa.array(weights * seen), pa.array(np.full(len(weights), seen))]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "weighted", "tokens"])

    parts = docs.select("text").mapInArrow(trained, "place int, weighted double, tokens long")
    mean = parts.groupBy("place").agg((F.sum("weighted") / F.sum("tokens")).alias("w")).orderBy("place").collect()
    held.unpersist()
    return np.array([r["w"] for r in mean], np.float32) if mean else Network(start).flat


def fit(docs: DataFrame, text_col: str = "text", max_words: int = 20_000, rounds: int = 2) -> tuple[Vocabulary, np.ndarray]:
    """Count the words of all texts, then train on all tokens in ``rounds`` parts, averaging the tasks' networks after each.

    The model has a bounded size: ``max_words`` words and about 18,000 weights. NULL texts teach nothing.
    """
    rows = id_and_text(docs, text_col, text_col).select("text").where("text is not null")
    counts = count_words(rows)
    top = counts.orderBy(F.desc("n"), "word").limit(max_words).collect()
    sums = counts.agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).first()
    vocab = vocabulary([(bytes(r["word"]), r["n"]) for r in top], sums["total"] or 0, sums["kinds"] or 0)
    weights = None
    for part in range(rounds):
        mine = F.pmod(F.xxhash64("text", F.lit(3)), F.lit(rounds)) == part
        weights = _trained(rows.where(mine), vocab, weights)
    return vocab, weights


def score(docs: DataFrame, model: tuple[Vocabulary, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, log_prob, mean_log_prob), one row per input row, without a shuffle.

    ``log_prob`` is the pseudo-likelihood: every word is hidden in turn and predicted from the two words on either side, its
    group by the network and the word in its group by counts; the logarithms are summed. Text edges are part of the
    context. A NULL text, or one without words, has no tokens, log_prob 0 and no mean.
    """
    rows = id_and_text(docs, id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        vocab, weights = held.value
        network = Network(weights)
        for batch in batches:
            flat, lengths, cells, at = _encoded(batch.column(1).to_pylist(), vocab)
            log_p = vocab.within[flat]
            for i in range(0, len(flat), STEP_TOKENS):
                part = slice(i, i + STEP_TOKENS)
                target = vocab.group[flat[part]]
                log_p[part] += network.forward(cells, at[part])[1][np.arange(len(target)), target]
            ends = np.concatenate([[0.0], np.cumsum(log_p)])[np.concatenate([[0], np.cumsum(lengths)])]
            columns = [batch.column(0), pa.array(lengths), pa.array(np.diff(ends))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_tokens", "log_prob"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(scored, f"id {kind}, n_tokens long, log_prob double")
    return out.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
