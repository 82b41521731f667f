"""Operator 8: a byte convolutional network for language identification, trained and applied in numpy."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, free_name
from .textbytes import buffer_of, slices

WINDOW, WIDTHS, FILTERS = 128, (2, 3, 4), 16
LETTERS = re.compile(r"[^\W\d_]+")


def lettered(text: str | None) -> bool:
    """Whether a text has a letter, that is a character of a Unicode class L: of the pattern's, ½, ² and ① are numbers."""
    return text is not None and any(any(map(str.isalpha, m.group())) for m in LETTERS.finditer(text))


class ByteNetwork:
    """Filters of several widths over bytes, the largest response of each, and a softmax over labels.

    A filter of width w is w tables of a weight for each byte value: the embedding of bytes is folded into it.
    """

    def __init__(self, labels: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(labels))).astype(np.float32)
        self.out_bias = np.zeros(len(labels), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables, *self.bias, self.out, self.out_bias]

    def pooled(self, windows: np.ndarray, places: bool = False):
        """Largest response of each filter in each window, and where it is."""
        values, where = [], []
        for table, bias in zip(self.tables, self.bias):
            n = windows.shape[1] - len(table) + 1
            response = table[0][windows[:, :n]]
            for j in range(1, len(table)):
                response += table[j][windows[:, j : j + n]]
            values.append(response.max(axis=1) + bias)
            if places:
                where.append(response.argmax(axis=1))
        return np.concatenate(values, axis=1), where

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        scores = np.maximum(self.pooled(windows)[0], 0) @ self.out + self.out_bias
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)

    def gradient(self, windows: np.ndarray, answers: np.ndarray) -> list[np.ndarray]:
        pooled, where = self.pooled(windows, places=True)
        hidden = np.maximum(pooled, 0)
        scores = hidden @ self.out + self.out_bias
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        error = scores / scores.sum(axis=1, keepdims=True)
        error[np.arange(len(answers)), answers] -= 1
        error /= len(answers)
        back = (error @ self.out.T) * (pooled > 0)
        tables, biases, rows = [], [], np.arange(len(windows))[:, None]
        for k, (table, at) in enumerate(zip(self.tables, where)):
            share = back[:, k * FILTERS : (k + 1) * FILTERS]
            slope = np.zeros_like(table)
            for j in range(len(table)):
                np.add.at(slope[j], (windows[rows, at + j], np.arange(FILTERS)[None, :]), share)
            tables.append(slope)
            biases.append(share.sum(axis=0))
        return [*tables, *biases, hidden.T @ error, error.sum(axis=0)]

    def fit(self, windows: np.ndarray, answers: np.ndarray, rounds: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 7) -> None:
        """Adam on the cross-entropy, in an order that the seed fixes."""
        rng, params = np.random.default_rng(seed), self.parameters()
        first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(rounds):
            order = rng.permutation(len(windows))
            for lo in range(0, len(order), batch):
                pick, t = order[lo : lo + batch], t + 1
                for p, g, m, v in zip(params, self.gradient(windows[pick], answers[pick]), first, second):
                    m *= 0.9
                    m += 0.1 * g
                    v *= 0.999
                    v += 0.001 * g * g
                    p -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)


def windows_of(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fixed-length windows that cover every byte of each text (the last filled up with zeros), and the text of each."""
    sizes = np.diff(at)
    each = np.maximum(1, -(-sizes // WINDOW))
    owner = np.repeat(np.arange(len(sizes)), each)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
    start = at[:-1][owner] + nth * WINDOW
    size = np.minimum(WINDOW, at[1:][owner] - start)
    grid = start[:, None] + np.arange(WINDOW)[None, :]
    inside = np.arange(WINDOW)[None, :] < size[:, None]
    return np.where(inside, body[np.minimum(grid, max(len(body) - 1, 0))] if len(body) else 0, 0).astype(np.uint8), owner


def train(labelled: DataFrame, per_label: int = 600, most_rows: int = 60_000) -> ByteNetwork | None:
    """Fit a network on (doc_id, text, lang) rows: about per_label of each label, fewer where that would be over most_rows in all.

    Rows are taken by a hash of doc_id and text, 1.2 times as many as wanted at first, and one window from the middle of each text is used. The driver gets
    at most 1.25 * most_rows windows; with more labels than rows some labels go unlearnt. None if there is no labelled text.
    """
    known = labelled.where("lang is not null and text is not null and text rlike '\\\\p{L}'")
    place = F.greatest(F.lit(1), F.floor(F.length("text") / 2).cast("int") - WINDOW // 2)
    chance = F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(1_000_003)) / 1_000_003
    parts = known.select("lang", F.substring("text", place, F.lit(WINDOW)).alias("part"), chance.alias("chance"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    labels = counts.count()
    if not labels:
        return None
    each = max(1, min(per_label, most_rows // labels))
    # 1.2 times as many as wanted, for what chance leaves out; of a label with few rows all
    picked = parts.join(counts, "lang").where(F.col("chance") < 1.2 * each / F.col("n"))
    most = min(int(1.25 * most_rows), int(1.25 * each * labels) + 100)
    rows = picked.select("lang", "part", "chance").orderBy("chance", "part").limit(most).collect()
    if not rows:
        rows = parts.orderBy("chance", "part").limit(each).collect()
    network = ByteNetwork(sorted({r.lang for r in rows}))
    number = {name: i for i, name in enumerate(network.labels)}
    body = np.zeros((len(rows), WINDOW), np.uint8)
    for i, r in enumerate(rows):
        raw = np.frombuffer(r.part.encode()[:WINDOW], np.uint8)
        body[i, : len(raw)] = raw
    network.fit(body, np.array([number[r.lang] for r in rows]))
    return network


def predict(docs: DataFrame, network: ByteNetwork | None, name: str = "language") -> DataFrame:
    """docs with a column `name`, struct<label, score>: the label with the largest mean probability over all windows of the whole text, and that mean.

    A text that is null or has no letter, or a network that saw no text, gives 'und' and 0. Only
    text is read for it; rows and other columns stay as they are. A column that has the name already is an error (free_name finds another).
    """
    if free_name(docs, name) != name:
        raise ValueError(f"there is a column {name} already")
    arrow_batches(docs.sparkSession)

    @F.arrow_udf("struct<label:string,score:double>")
    def label(texts: pa.Array) -> pa.Array:
        labels, scores = [], []
        for first, count in slices(texts, 1 << 20):
            part = texts.slice(first, count)
            if network is None:
                labels += ["und"] * count
                scores += [0.0] * count
                continue
            windows, owner = windows_of(*buffer_of(part))
            sums = np.zeros((count, len(network.labels)))
            for lo in range(0, len(windows), 512):
                np.add.at(sums, owner[lo : lo + 512], network.probabilities(windows[lo : lo + 512]))
            means = sums / np.bincount(owner, minlength=count)[:, None]
            for text, mean in zip(part.to_pylist(), means):
                told = lettered(text)
                labels.append(network.labels[int(mean.argmax())] if told else "und")
                scores.append(min(1.0, float(mean.max())) if told else 0.0)
        return pa.StructArray.from_arrays([pa.array(labels, pa.string()), pa.array(scores, pa.float64())], ["label", "score"])

    return docs.withColumn(name, label(F.col("text")))


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def language_digest(docs: DataFrame) -> DataFrame:
    facts = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out())
    network = train(facts.where(~F.col("held_out")))
    told = predict(facts.select("doc_id", "text", "held_out"), network)
    return told.select("doc_id", "held_out", F.col("language.label").alias("lang_pred"), F.col("language.score").alias("score"))
