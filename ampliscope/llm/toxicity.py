"""Toxicity by a factorization machine over hashed terms.

A term is a word of letters in lower case, or its first 4, 5 or 6 letters where it is
longer; a text's features are the terms it has, hashed into 2^`BITS` features. The
machine adds a weight for each feature and, for each pair, the product of their
vectors, so that two terms that are harmless alone can count together, as an insult
and a group that it is aimed at.

Every feature is trained, none is chosen beforehand: vectors begin as small random ones,
so that each pair of terms pulls at both, weights as zero. Steps are per feature and
shrink with what it has seen. As there are far more features than labelled texts, a
weight or vector moves off its start only as far as the pull on it stands out by more
than `APART` standard deviations (`APART_PAIR` for vectors) from what chance would give.
The pulls are of what the machine doesn't explain yet, so a pair counts though neither
term does. What has moved is then fitted further without that threshold, which also
holds back what it lets through; features that never moved have no part in a score.

It is fitted on a bounded sample, the `SAMPLE` labelled documents of the training
fold with the smallest hash of doc_id, on their whole texts.

Defined cases: a null or empty text, or one without letters, has no feature and gets
the score of the machine's offset, as does every text if nothing could be learned
(0 then). Several labels for one doc_id: toxic if any says so. Repeated rows keep a
row each. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampliscope.llm.common import held_out, ship

WORDS = regex.compile(r"\p{L}+")
PREFIXES = (4, 5, 6)
BITS = 22
SAMPLE, APART, APART_PAIR = 8000, 4.0, 5.0
FACTORS, BATCH, START = 8, 128, 0.01
#: Passes and steps over all features, then over those that moved.
EPOCHS, RATE = 6, 0.1
AGAIN, AGAIN_RATE, DECAY = 12, 0.01, 2e-3
SEED = 11
#: Words that a Python worker keeps the features of.
MOST_WORDS = 300_000


def hashes(word: str) -> list[int]:
    """The hashed terms of a word."""
    terms = [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]
    return [xxhash.xxh32_intdigest(t.encode()) >> (32 - BITS) for t in terms]


def words_of(text: str | None) -> set[str]:
    return set(WORDS.findall(text.lower())) if text else set()


@dataclass
class Machine:
    terms: np.ndarray  # sorted hashes of the features
    offset: float
    weights: np.ndarray
    vectors: np.ndarray

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        """rows: the feature numbers of each text."""
        out = np.full(len(rows), self.offset)
        for i, own in enumerate(rows):
            v = self.vectors[own]
            out[i] += self.weights[own].sum() + 0.5 * (v.sum(0) ** 2 - (v**2).sum(0)).sum()
        return out


def _moved(total: np.ndarray, spread: np.ndarray, apart: float, epoch: int) -> np.ndarray:
    """How far a parameter (a row each) is from its start: what the pull is over that which chance may give in so many passes."""
    size = np.sqrt((total**2).sum(1))
    over = np.maximum(1 - apart * np.sqrt(spread * epoch) / np.maximum(size, 1e-30), 0)
    return -total * (over / (1 + np.sqrt(spread) / RATE))[:, None]


def _over_all(rows: list[np.ndarray], y: np.ndarray, epochs: int) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """The features that moved, the offset, and the weights and vectors of these."""
    every = np.unique(np.concatenate([*rows, np.zeros(0, np.int64)])).astype(np.int64)
    rng = np.random.default_rng(SEED)
    base = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    offset, pulled = np.log(base / (1 - base)), 1e-9
    # weights and vectors: where they begin and are, the sum of the pulls and of their squares
    first = [np.zeros((len(every), 1), np.float32), rng.normal(0, START, (len(every), FACTORS)).astype(np.float32)]
    now, pull, spread = [p.copy() for p in first], [np.zeros_like(p) for p in first], [np.zeros(len(every), np.float32) for _ in first]
    order, batches = rng.permutation(len(y)), []
    for i in range(0, len(y), BATCH):
        own = [rows[k] for k in order[i : i + BATCH]]
        terms, column = np.unique(np.concatenate([*own, np.zeros(0, np.int64)]), return_inverse=True)
        batches.append((y[order[i : i + BATCH]], np.searchsorted(every, terms), np.repeat(np.arange(len(own)), [len(r) for r in own]), column.astype(np.int32)))
    for epoch in range(1, epochs + 1):
        for k in rng.permutation(len(batches)):
            label, at, row, column = batches[k]
            x = np.zeros((len(label), len(at)), np.float32)
            x[row, column] = 1
            w, v = now[0][at], now[1][at]
            sums = x @ np.concatenate((w, v, (v**2).sum(1, keepdims=True)), 1)
            xv = sums[:, 1:-1]
            z = offset + sums[:, 0] + 0.5 * ((xv**2).sum(1) - sums[:, -1])
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label).astype(np.float32)
            pulled += float(g.sum()) ** 2
            offset -= RATE * float(g.sum()) / np.sqrt(pulled)
            back = x.T @ np.column_stack((g, g[:, None] * xv, g**2, g**2 * (xv**2).sum(1)))
            for p, d, d2, apart in ((0, back[:, :1], back[:, -2], APART), (1, back[:, 1:-2] - back[:, :1] * v, back[:, -1], APART_PAIR)):
                was = np.sqrt(spread[p][at])
                spread[p][at] += d2
                slower = (np.sqrt(spread[p][at]) - was) / RATE
                pull[p][at] += d - slower[:, None] * ((w, v)[p] - first[p][at])
                now[p][at] = first[p][at] + _moved(pull[p][at], spread[p][at], apart, epoch)
    moved = np.flatnonzero((now[0] != first[0]).any(1) | (now[1] != first[1]).any(1))
    return every[moved], float(offset), now[0][moved, 0].astype(float), now[1][moved].astype(float)


def train(rows: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, again: int = AGAIN) -> Machine:
    """rows: the hashed terms of each text, each once; y: its label. The machine has the features that moved."""
    terms, offset, w, v = _over_all(rows, y, epochs)
    own = [np.searchsorted(terms, np.intersect1d(r, terms)) for r in rows]
    rng = np.random.default_rng(SEED)
    params = [np.array([offset]), w, v]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(again):
        order = rng.permutation(len(y))
        for i in range(0, len(y), BATCH):
            batch = order[i : i + BATCH]
            x = np.zeros((len(batch), len(terms)))
            for k, r in enumerate(batch):
                x[k, own[r]] = 1
            xv = x @ v
            z = params[0][0] + x @ w + 0.5 * (xv**2 - x @ v**2).sum(1)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]) / len(batch)
            seen = x.T @ g
            grads = [np.array([g.sum()]), seen + DECAY * w, x.T @ (g[:, None] * xv) - seen[:, None] * v + DECAY * v]
            step += 1
            for p, d, m, s in zip(params, grads, first, second):
                m += 0.1 * (d - m)
                s += 0.001 * (d * d - s)
                p -= AGAIN_RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Machine(terms, float(params[0][0]), w, v)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted({h for w in words_of(t) for h in hashes(w)}) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.int32()))], names=["doc_id", "y", "terms"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine | None:
    """The machine of the training fold's labelled texts, or None where there are none."""
    ship(docs.sparkSession)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    found = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")
    rows = found.mapInArrow(_features, "doc_id long, y int, terms array<int>").orderBy("doc_id").limit(sample).toArrow()
    if not len(rows):
        return None
    terms = rows.column("terms").combine_chunks()
    at, flat = terms.offsets.to_numpy(), terms.values.to_numpy()
    return train([flat[a:b].astype(np.int64) for a, b in zip(at, at[1:])], rows.column("y").to_numpy().astype(float))


def _score(machine: Machine | None):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        number = {int(h): i for i, h in enumerate(machine.terms)} if machine else {}
        for batch in batches:
            own = []
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                new = [w for w in words if w not in known]  # not words - known.keys(), which walks all of known
                if len(known) + len(new) > MOST_WORDS:
                    known.clear()
                    new = list(words)
                for w in new:
                    known[w] = tuple(number[h] for h in hashes(w) if h in number)
                own.append(np.array(sorted({i for w in words for i in known[w]}), dtype=np.int64))
            score = 1 / (1 + np.exp(-np.clip(machine.logits(own), -30, 30))) if machine else np.zeros(len(own))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return rows


def score(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every text."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(_score(machine), "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
