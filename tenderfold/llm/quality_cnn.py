"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded and convolved with learnt filters (width 6, every second
byte). The document is covered whole by overlapping chunks; each chunk keeps
the greatest response of every filter, and self-match channels (how much of
the chunk repeats the bytes a short lag before), which a convolution over byte
values cannot see. The chunk vectors are pooled over the document by mean and
by maximum and combined into one probability.

Training runs on the driver over a bounded sample of labelled documents (rows,
text length and chunks per text are bounded there); scoring covers every byte
of every text. After training the embedding and the filters are multiplied out
into one table per filter position, so that a convolution is a sum of table
rows.

Defined results: NULL and empty text are one chunk of padding and score like
it. Equal texts get equal scores. With labelled rows of one class only the
score is that class's share, smoothed. An empty table gives no rows. Columns
other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tenderfold.llm.labelled import training_texts

TRAIN_PER_CLASS = 600       # bound of the training sample
TRAIN_MAX_CHARS = 20_000    # longer texts are not used for training
TRAIN_CHUNKS = 8            # chunks drawn from a text at each training step
STEPS, BATCH, RATE = 250, 48, 0.01

EMBED, FILTERS, WIDTH, STRIDE = 6, 16, 6, 2
CHUNK, HOP = 256, 192       # bytes; neighbouring chunks overlap by 64
LAGS = range(2, 17)
BLOCK = 6                   # responses per block when chunks are pooled
SPAN = (CHUNK - WIDTH) // STRIDE + 1        # responses per chunk
SECTION = 1 << 20           # bytes of a document that are convolved at once


@dataclass
class Model:
    tables: np.ndarray      # (WIDTH, 256, FILTERS)
    bias: np.ndarray        # (FILTERS,)
    out: np.ndarray         # weights of the pooled features
    out_bias: float


def _padded(data: bytes) -> np.ndarray:
    """The bytes, padded with zeros so that the chunks cover them all."""
    chunks = max(1, -(-(len(data) - CHUNK) // HOP) + 1)
    out = np.zeros((chunks - 1) * HOP + CHUNK, np.uint8)
    out[:len(data)] = np.frombuffer(data, np.uint8)
    return out


def _self_match(b: np.ndarray, chunks: int) -> np.ndarray:
    """Greatest share of bytes, over the lags, that equal the byte a lag before; for each chunk, in halves."""
    best = np.zeros(chunks)
    starts = np.arange(chunks) * HOP
    for lag in LAGS:
        same = np.zeros(len(b) + 1, np.int32)
        np.cumsum(b[lag:] == b[:-lag], out=same[lag + 1:])
        best = np.maximum(best, (same[starts + CHUNK] - same[starts + lag]) / (CHUNK - lag))
    return best


def _match_features(b: np.ndarray, n: int, chunks: int) -> np.ndarray:
    """Self-match of each chunk, as a plain and a steep channel; chunks that are mostly padding count by their text."""
    filled = np.clip((n - np.arange(chunks) * HOP) / CHUNK, 0.0, 1.0)
    match = np.where(filled > 0.5, _self_match(b, chunks), 0.0)
    return np.stack([match, match > 0.35], axis=1).astype(np.float32)


def _responses(model: Model, b: np.ndarray) -> np.ndarray:
    """Filter responses at every second byte."""
    at = (len(b) - WIDTH) // STRIDE + 1
    z = np.take(model.tables[0], b[0:STRIDE * at:STRIDE], axis=0)
    for k in range(1, WIDTH):
        z += np.take(model.tables[k], b[k:k + STRIDE * at:STRIDE][:at], axis=0)
    return z


def chunk_features(model: Model, data: bytes) -> np.ndarray:
    """(chunks, FILTERS + 2) features of a whole document."""
    b = _padded(data)
    chunks = (len(b) - CHUNK) // HOP + 1
    pooled = np.empty((chunks, FILTERS), np.float32)
    per = max(1, SECTION // HOP)
    for first in range(0, chunks, per):          # sections bound the memory of very long texts
        last = min(chunks, first + per)
        z = _responses(model, b[first * HOP:(last - 1) * HOP + CHUNK])
        whole = len(z) // BLOCK * BLOCK
        blocks = z[:whole].reshape(-1, BLOCK, FILTERS).max(axis=1)
        view = np.lib.stride_tricks.sliding_window_view(blocks, SPAN // BLOCK, axis=0)[::HOP // STRIDE // BLOCK]
        pooled[first:last] = view.max(axis=2)
    pooled = np.maximum(pooled + model.bias, 0.0)
    return np.hstack([pooled, _match_features(b, len(data), chunks)])


def _combine(h: np.ndarray) -> np.ndarray:
    return np.concatenate([h.mean(axis=0), h.max(axis=0)])


def score_text(model: Model, text: str | None) -> float:
    f = _combine(chunk_features(model, (text or "").encode("utf-8", "surrogatepass")))
    return float(1.0 / (1.0 + np.exp(-np.clip(f @ model.out + model.out_bias, -30, 30))))


class _Net:
    """The network in training: parameters, gradients by hand, Adam steps."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        self.p = {"emb": r.normal(0, 0.5, (256, EMBED)), "conv": r.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)),
                  "bias": np.zeros(FILTERS), "out": r.normal(0, 0.1, 2 * (FILTERS + 2)), "out_bias": np.zeros(1)}
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0

    def step(self, x: np.ndarray, match: np.ndarray, owner: np.ndarray, y: np.ndarray) -> None:
        """One step on chunks x (n, CHUNK) of documents ``owner`` (ascending) with labels y."""
        p, n, docs = self.p, len(x), len(y)
        at = np.arange(SPAN)[:, None] * STRIDE + np.arange(WIDTH)
        cols = p["emb"][x][:, at].reshape(n, SPAN, WIDTH * EMBED)
        z = cols @ p["conv"] + p["bias"]
        top = z.argmax(axis=1)
        zmax = np.take_along_axis(z, top[:, None, :], axis=1)[:, 0]
        h = np.hstack([np.maximum(zmax, 0.0), match])
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        count = np.diff(np.r_[first, n])[:, None]
        mean, most = np.add.reduceat(h, first) / count, np.maximum.reduceat(h, first)
        f = np.hstack([mean, most])
        prob = 1.0 / (1.0 + np.exp(-np.clip(f @ p["out"] + p["out_bias"], -30, 30)))
        dlogit = (prob - y) / docs
        df = dlogit[:, None] * p["out"]
        dmean, dmost = df[:, :h.shape[1]] / count, df[:, h.shape[1]:]
        is_most = (h == most[owner]) / np.maximum(1, np.add.reduceat(h == most[owner], first))[owner]
        dh = dmean[owner] + dmost[owner] * is_most
        dz = dh[:, :FILTERS] * (zmax > 0)
        chosen = np.take_along_axis(cols, top[:, :, None], axis=1)                   # (n, FILTERS, WIDTH * EMBED)
        dcols = dz[:, :, None] * p["conv"].T[None]
        places = x[np.arange(n)[:, None, None], at[top]]                             # (n, FILTERS, WIDTH)
        demb = np.zeros_like(p["emb"])
        np.add.at(demb, places.ravel(), dcols.reshape(-1, EMBED))
        grads = {"emb": demb, "conv": np.einsum("nf,nfk->kf", dz, chosen), "bias": dz.sum(axis=0),
                 "out": f.T @ dlogit + 1e-4 * p["out"], "out_bias": np.array([dlogit.sum()])}
        self.t += 1
        for k, g in grads.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            p[k] = p[k] - RATE * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)

    def model(self) -> Model:
        conv = self.p["conv"].reshape(WIDTH, EMBED, FILTERS)
        tables = np.einsum("be,kef->kbf", self.p["emb"], conv).astype(np.float32)
        return Model(tables, self.p["bias"].astype(np.float32), self.p["out"].copy(), float(self.p["out_bias"][0]))


def train(texts: list[tuple[str, int]], seed: int = 5) -> Model:
    """Fit the filters on drawn chunks, then the combination on all chunks of the sample."""
    net, r = _Net(seed), np.random.default_rng(seed)
    by_class = [[_as_chunks(t) for t, label in texts if label == c] for c in (0, 1)]
    if not all(by_class):
        share = (len(by_class[1]) + 1) / (len(texts) + 2)
        model = net.model()
        return Model(model.tables, model.bias, np.zeros_like(model.out), float(np.log(share / (1 - share))))
    for _ in range(STEPS):
        xs, matches, owners, ys = [], [], [], []
        for d in range(BATCH):
            c = d % 2
            chunks, match = by_class[c][r.integers(len(by_class[c]))]
            pick = np.sort(r.choice(len(chunks), min(TRAIN_CHUNKS, len(chunks)), replace=False))
            xs.append(chunks[pick])
            matches.append(match[pick])
            owners += [d] * len(pick)
            ys.append(c)
        net.step(np.vstack(xs), np.vstack(matches), np.array(owners), np.array(ys, float))
    model = net.model()
    x = np.array([_combine(chunk_features(model, t.encode("utf-8", "surrogatepass"))) for t, _ in texts])
    y = np.array([label for _, label in texts], float)
    model.out, model.out_bias = _logistic(x, y)
    return model


def _as_chunks(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = text.encode("utf-8", "surrogatepass")
    b = _padded(data)
    chunks = np.lib.stride_tricks.sliding_window_view(b, CHUNK)[::HOP]
    return chunks, _match_features(b, len(data), len(chunks))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[np.ndarray, float]:
    """Regularised logistic regression by damped Newton steps, classes weighted equally."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * 100.0
    theta, keep = np.zeros(x1.shape[1]), np.eye(x1.shape[1]) * ridge

    def loss(th: np.ndarray) -> float:
        z = x1 @ th
        return float((weight * (np.logaddexp(0.0, z) - y * z)).sum() + 0.5 * th @ keep @ th)

    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x1 @ theta, -30, 30)))
        step = np.linalg.solve((x1 * (weight * p * (1 - p))[:, None]).T @ x1 + keep, x1.T @ (weight * (p - y)) + keep @ theta)
        now, size = loss(theta), 1.0
        while loss(theta - size * step) > now and size > 1e-6:
            size /= 2
        theta = theta - size * step
    return theta[:-1], float(theta[-1])


def _score_task(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score_text(model, batch.column(1)[i].as_py()) for i in range(batch.num_rows)]
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])
    return run


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, score and predicted (1 from the threshold on) for every whole text."""
    model = train(training_texts(docs, labels, "quality", TRAIN_PER_CLASS, TRAIN_MAX_CHARS))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score_task(model), "doc_id long, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
