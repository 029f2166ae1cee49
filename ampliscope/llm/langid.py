"""Language ID by a byte convolutional network, trained in numpy on labelled text.

Bytes are embedded; filters of several widths run over a window, each keeps its
maximum (through a ReLU), and a softmax over these maxima gives the language. A text
is cut into windows of `WINDOW` bytes that overlap by the widest filter less one, so
no byte sequence is missed; its language is that of the mean of its windows' logits,
weighted by their bytes. For speed, embedding and filter are folded into one table
for each pair of bytes.

The network is fitted on a bounded sample: `SAMPLE` documents of the training fold,
those with the smallest hash of doc_id, with all windows of their whole texts.

Defined cases: a null text, or one without a letter, is `und` with score 0, as is
every text if nothing could be learned. Repeated rows keep a row each. Null langs
aren't learned from. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampliscope.llm.common import held_out, ship, slices, trimmed, utf8

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS, DEPTH = 16, 8
SAMPLE = 2000
EPOCHS, BATCH, RATE = 3, 64, 0.01
SEED = 7
UNKNOWN = "und"
#: Windows that a numpy pass takes at a time.
PASS = 256
#: Texts are padded by spaces.
PAD = 32
LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    langs: list[str]
    embedding: np.ndarray  # 256 x DEPTH
    filters: list[np.ndarray]  # for each width: width x DEPTH x FILTERS
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.dense, self.offset]

    def scorer(self):
        """A function from windows (n x WINDOW bytes) to logits."""
        single = [[(self.embedding @ f).astype(np.float32) for f in w] for w in self.filters]
        tables = []
        for own in single:
            pairs = [(np.repeat(own[i + 1], 256, 0) + np.tile(own[i], (256, 1)), i) for i in range(0, len(own) - 1, 2)]
            tables.append((pairs, own[-1] if len(own) % 2 else None))

        def logits(windows: np.ndarray) -> np.ndarray:
            pair = windows[:, :-1].astype(np.uint16) | (windows[:, 1:].astype(np.uint16) << np.uint16(8))
            pooled = []
            for width, (pairs, odd) in zip(WIDTHS, tables):
                n = WINDOW - width + 1
                total = np.take(pairs[0][0], pair[:, :n], axis=0)
                for table, at in pairs[1:]:
                    total += np.take(table, pair[:, at : at + n], axis=0)
                if odd is not None:
                    total += np.take(odd, windows[:, width - 1 : width - 1 + n], axis=0)
                pooled.append(total.max(1))
            # einsum, as a matrix product may round a row by what else is in its batch
            return np.einsum("nf,fl->nl", np.maximum(np.concatenate(pooled, 1) + self.bias, 0).astype(float), self.dense.astype(float)) + self.offset

        return logits


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(windows: np.ndarray, labels: list[str], epochs: int = EPOCHS) -> Network:
    """Adam on the cross-entropy, each language weighted by the root of its rarity."""
    langs = sorted(set(labels))
    y = np.searchsorted(langs, labels)
    rng = np.random.default_rng(SEED)
    normal = lambda *shape, by: rng.normal(0, by, shape).astype(np.float32)
    net = Network(langs, normal(256, DEPTH, by=0.5), [normal(w, DEPTH, FILTERS, by=0.3) for w in WIDTHS], np.zeros(len(WIDTHS) * FILTERS, np.float32), normal(len(WIDTHS) * FILTERS, len(langs), by=0.1), np.zeros(len(langs), np.float32))
    share = np.bincount(y, minlength=len(langs)) / max(1, len(y))
    weight = (1 / np.sqrt(np.maximum(share, 1e-9)))[y]
    weight = (weight / weight.mean()).astype(np.float32)
    params = net.parameters()
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(y), BATCH):
            rows = order[i : i + BATCH]
            step += 1
            for p, g, m, v in zip(params, _gradients(net, windows[rows], y[rows], weight[rows]), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _gradients(net: Network, b: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    n, pooled, tops = len(b), [], []
    for w, f in zip(WIDTHS, net.filters):
        total = sum(np.take(net.embedding @ f[k], b[:, k : WINDOW - w + 1 + k], axis=0) for k in range(w))
        tops.append(total.argmax(1))
        pooled.append(np.take_along_axis(total, tops[-1][:, None], 1)[:, 0])
    z = np.concatenate(pooled, 1) + net.bias
    h = np.maximum(z, 0)
    p = _softmax(h @ net.dense + net.offset)
    p[np.arange(n), y] -= 1
    p *= weight[:, None] / n
    back = (p @ net.dense.T) * (z > 0)
    embedding, filters = np.zeros_like(net.embedding), []
    for i, (w, f) in enumerate(zip(WIDTHS, net.filters)):
        own, df = back[:, i * FILTERS : (i + 1) * FILTERS], np.zeros_like(f)
        for k in range(w):
            at = np.take_along_axis(b, tops[i] + k, 1)
            df[k] = np.einsum("nfd,nf->df", net.embedding[at], own)
            np.add.at(embedding, at.ravel(), (own[:, :, None] * f[k].T).reshape(-1, DEPTH))
        filters.append(df)
    return [embedding, *filters, back.sum(0), h.T @ p, p.sum(0)]


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of the texts data[start:end]: (windows, row of each, bytes of each). An empty text has none."""
    stride = WINDOW - max(WIDTHS) + 1
    lengths = ends - starts
    # a new window only where the one before leaves bytes over
    each = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // stride)), 0)
    row = np.repeat(np.arange(len(starts)), each)
    begin = starts[row] + (np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)) * stride
    size = np.minimum(WINDOW, ends[row] - begin)
    at = begin[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < size[:, None]
    return np.where(inside, data[np.where(inside, at, 0)], PAD).astype(np.uint8), row, size


def fit(docs: DataFrame, label: str = "lang", sample: int = SAMPLE) -> Network | None:
    """The network of the training fold's labelled texts, or None where there are none."""
    labelled = docs.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    chosen = labelled.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).distinct()
    rows = labelled.join(F.broadcast(chosen), "doc_id").where("length(text) > 0").select("doc_id", label, "text").orderBy("doc_id").limit(sample).toArrow()
    labels, windows = [], []
    for lang, text in zip(rows.column(label).to_pylist(), rows.column("text")):
        data = np.frombuffer(text.as_py().encode(), dtype=np.uint8)
        own, _, _ = cut(data, np.array([0]), np.array([len(data)]))
        windows.append(own)
        labels += [lang] * len(own)
    return train(np.concatenate(windows), labels) if labels else None


def _judge(net: Network | None, score, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    at, data = utf8(texts)
    langs, out = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if net:
        total = np.zeros((len(texts), len(net.langs)))
        for a, b in slices(at):
            _add(total[a:b], data, at[a : b + 1], score)
        p = _softmax(total)
        best = p.argmax(1)
        for i, text in enumerate(texts.to_pylist()):
            if text and LETTER.search(text):
                langs[i], out[i] = net.langs[best[i]], p[i, best[i]]
    return langs, out


def _rows(net: Network | None):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = net.scorer() if net else None
        for batch in batches:
            langs, out = _judge(net, score, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(langs), pa.array(out)], names=["doc_id", "held_out", "lang_pred", "score"])

    return rows


def _accepted(net: Network | None, text: int, least: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = net.scorer() if net else None
        for batch in batches:
            langs, out = _judge(net, score, batch.column(text))
            yield batch.filter(pa.array([lang != UNKNOWN and s >= least for lang, s in zip(langs, out)], pa.bool_()))

    return rows


def _add(total: np.ndarray, data: np.ndarray, at: np.ndarray, score) -> None:
    """Add to each row its windows' mean logits. Long texts go window block by window block."""
    stride = WINDOW - max(WIDTHS) + 1
    sizes = np.zeros(len(total))
    # a text's blocks of whole windows start where its next window would
    block = PASS * stride
    starts, ends, rows = [], [], []
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        while b - a > block + WINDOW:
            starts.append(a), ends.append(a + block + WINDOW - stride), rows.append(i)
            a += block
        starts.append(a), ends.append(b), rows.append(i)
    starts, ends, rows = np.array(starts), np.array(ends), np.array(rows)
    upto = np.cumsum(np.maximum(1, (ends - starts) // stride))
    first = 0
    while first < len(rows):
        last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + PASS, side="right")))
        windows, row, size = cut(data, starts[first:last], ends[first:last])
        if len(row):
            np.add.at(total, rows[first:last][row], score(windows) * size[:, None])
            np.add.at(sizes, rows[first:last][row], size)
        first = last
    total /= np.maximum(sizes, 1)[:, None]


def predict(docs: DataFrame, net: Network | None, held: Column | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every text."""
    ship(docs.sparkSession)
    return docs.select("doc_id", "text", (held_out() if held is None else held).alias("held_out")).select(F.col("doc_id").cast("long"), "text", "held_out").mapInArrow(_rows(net), "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))


def accept(docs: DataFrame, net: Network | None, least: float) -> DataFrame:
    """The documents, all columns, whose language is known with a score of `least` or more."""
    ship(docs.sparkSession)
    return docs.mapInArrow(trimmed(_accepted(net, docs.columns.index("text"), least)), docs.schema)
