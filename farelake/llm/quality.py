"""Quality classifier: a byte-level convolutional network in numpy.

The whole document, as UTF-8 bytes, is covered by overlapping chunks. Learned
byte embeddings and filters run over each chunk, every filter is max-pooled
over the chunk, and a hidden layer combines the mean of the chunks' pooled
values into one probability.

Training uses a bounded sample: at most ``SAMPLE_DOCS`` labelled documents and
``SAMPLE_BYTES`` of text of each class, each document with its whole text, as
scoring reads it. Scoring reads every byte of every document, a long text in
pieces of ``PIECE`` chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_or_empty, written

SAMPLE_DOCS = 2500
SAMPLE_BYTES = 64 << 20

CHUNK, OVERLAP = 512, 64
WIDTH, EMBEDDING, FILTERS, HIDDEN = 4, 8, 16, 8
EPOCHS, BATCH, RATE, SEED = 10, 32, 0.01, 7
#: Chunks that go through the network at once.
BLOCK = 48
#: Chunks of a text that are cut out of it at once.
PIECE = 4096


def chunk_bytes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``CHUNK`` bytes that overlap by ``OVERLAP`` and cover each text (zeros after its end), and each row's text."""
    step = CHUNK - OVERLAP
    lengths = np.array([len(t) for t in texts], np.int64)
    chunks = np.maximum(1, -(-(lengths - OVERLAP) // step))
    owner = np.repeat(np.arange(len(texts)), chunks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    pool = np.frombuffer(b"".join(texts) + bytes(CHUNK), np.uint8)
    at = (offsets[owner] + nth * step)[:, None] + np.arange(CHUNK)
    rows = pool[np.minimum(at, len(pool) - 1)]
    rows[at >= offsets[owner + 1][:, None]] = 0
    return rows, owner


@dataclass
class Network:
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: np.ndarray  # WIDTH * EMBEDDING x FILTERS
    filter_bias: np.ndarray
    hidden: np.ndarray  # FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.filter_bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def responses(self, rows: np.ndarray) -> np.ndarray:
        """Chunks x positions x FILTERS, before the bias."""
        embedded = self.embedding[rows]
        n, length, width = embedded.shape
        patches = np.lib.stride_tricks.as_strided(
            embedded, (n, length - WIDTH + 1, WIDTH * width), (*embedded.strides[:2], embedded.strides[2]), writeable=False)
        return (np.ascontiguousarray(patches).reshape(-1, WIDTH * width) @ self.filters).reshape(n, -1, self.filters.shape[1])

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """Each chunk's largest response to each filter."""
        parts = [self.responses(rows[i : i + BLOCK]).max(axis=1) for i in range(0, len(rows), BLOCK)]
        return np.maximum(np.concatenate(parts) + self.filter_bias, 0)

    def _pooled_sums(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The sum of each text's pooled values, and its chunks."""
        rows, owner = chunk_bytes(texts)
        pooled = self.pooled(rows).astype(np.float64)
        return np.stack([np.bincount(owner, column, len(texts)) for column in pooled.T], axis=1), np.bincount(owner, minlength=len(texts))

    def _long_sums(self, text: bytes) -> tuple[np.ndarray, int]:
        """The same of one long text, in pieces of whole chunks."""
        step = CHUNK - OVERLAP
        chunks = max(1, -(-(len(text) - OVERLAP) // step))
        total, view = np.zeros(self.filters.shape[1]), memoryview(text)
        for first in range(0, chunks, PIECE):
            last = min(first + PIECE, chunks)
            sums, counts = self._pooled_sums([bytes(view[first * step : (last - 1) * step + CHUNK])])
            total += sums[0]
        return total, chunks

    def scores(self, texts: list[bytes]) -> np.ndarray:
        long = [len(t) > PIECE * CHUNK for t in texts]
        sums, counts = self._pooled_sums([b"" if x else t for t, x in zip(texts, long)])
        for i in np.flatnonzero(long):
            sums[i], counts[i] = self._long_sums(texts[i])
        mean = sums / counts[:, None]
        combined = np.maximum(mean @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(combined, -30, 30)))


def fit(texts: list[bytes], labels: np.ndarray, weights: np.ndarray | None = None) -> Network:
    """Adam on the weighted log loss; the same rows in the same order give the same network."""
    rng = np.random.default_rng(SEED)
    normal = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
    net = Network(
        normal(0.5, 256, EMBEDDING), normal((WIDTH * EMBEDDING) ** -0.5, WIDTH * EMBEDDING, FILTERS), np.zeros(FILTERS, np.float32),
        normal(FILTERS**-0.5, FILTERS, HIDDEN), np.zeros(HIDDEN, np.float32), normal(HIDDEN**-0.5, HIDDEN), np.zeros(1, np.float32))
    if len(texts) == 0:
        return net
    y = np.asarray(labels, np.float32)
    weight = np.ones(len(y), np.float32) if weights is None else np.asarray(weights, np.float32)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step, last = 0, EPOCHS * -(-len(texts) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            pick = order[i : i + BATCH]
            step += 1
            gradients = _gradients(net, [texts[k] for k in pick], y[pick], weight[pick])
            for p, g, (m, v) in zip(net.parameters(), gradients, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                rate = RATE * (1 - (step - 1) / last)  # falls to nothing at the end
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    return net


def _gradients(net: Network, texts: list[bytes], y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    rows, owner = chunk_bytes(texts)
    best = [(r.argmax(axis=1), r.max(axis=1)) for r in (net.responses(rows[i : i + BLOCK]) for i in range(0, len(rows), BLOCK))]
    where = np.concatenate([at for at, _ in best])  # chunks x FILTERS
    raw = np.concatenate([most for _, most in best]) + net.filter_bias
    pooled = np.maximum(raw, 0)
    share = (1 / np.bincount(owner, minlength=len(texts)))[owner].astype(np.float32)
    mean = np.zeros((len(texts), FILTERS), np.float32)
    np.add.at(mean, owner, pooled * share[:, None])
    before = mean @ net.hidden + net.hidden_bias
    hidden = np.maximum(before, 0)
    p = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.out_bias, -30, 30)))
    d_out = ((p - y) * weight / len(y)).astype(np.float32)
    d_before = d_out[:, None] * net.out * (before > 0)
    d_pooled = (d_before @ net.hidden.T)[owner] * share[:, None] * (raw > 0)
    # the gradient reaches only the patch where a filter answered most
    at = where[:, :, None] + np.arange(WIDTH)  # chunks x FILTERS x WIDTH
    patch = rows[np.arange(len(rows))[:, None, None], at]
    embedded = net.embedding[patch].reshape(len(rows), FILTERS, -1)
    d_filters = np.einsum("cfk,cf->kf", embedded, d_pooled)
    d_patch = (d_pooled[:, :, None] * net.filters.T).reshape(-1, EMBEDDING)
    d_embedding = np.zeros_like(net.embedding)
    np.add.at(d_embedding, patch.reshape(-1), d_patch)
    return [d_embedding, d_filters, d_pooled.sum(0), mean.T @ d_before, d_before.sum(0), hidden.T @ d_out, d_out.sum(keepdims=True)]


def held_out(id_column: str | Column) -> Column:
    """Rows that training never sees: crc32 of the id as text, mod 5, is 0 (a null id counts as empty text)."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> Network:
    """Fits the network to the sample; only rows that are not held out, with a label of 0 or 1, are read."""
    usable = (
        labels.where(~held_out(id_column) & F.col(label_column).isin(0, 1))
        .groupBy(id_column).agg(F.min(label_column).alias("_y"), F.max(label_column).alias("_same"))
        .where(F.col("_y") == F.col("_same"))  # contradictory labels teach nothing
        .select(F.col(id_column).alias("_id"), F.col("_y").cast("int").alias("_y"))
    )
    sizes = dict(usable.groupBy("_y").count().collect())
    picks = [usable.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_DOCS) for y in (0, 1)]
    sample = picks[0].unionByName(picks[1])  # at most 2 * SAMPLE_DOCS rows
    text = text_or_empty(text_column)
    texts = written(
        docs.select(F.col(id_column).alias("_id"), text.alias("_text"))
        .join(F.broadcast(sample), "_id")
        .groupBy("_id", "_y").agg(F.min("_text").alias("_text")), "quality-sample")
    # in the sample's order, as many as fit; their ids and sizes are two numbers a row
    chosen, held = [], [0, 0]
    for r in sorted(texts.select("_id", "_y", F.xxhash64("_id").alias("h"), F.octet_length("_text").alias("n")).collect(), key=lambda r: (r["h"], r["_id"])):
        if held[r["_y"]] + r["n"] <= SAMPLE_BYTES:
            held[r["_y"]] += r["n"]
            chosen.append(r["_id"])
    found = texts.where(F.col("_id").isin(chosen)).collect()
    rows = sorted((r["_id"], r["_y"], r["_text"]) for r in found)
    y = np.array([r[1] for r in rows], np.float32)
    total, counts = sum(sizes.values()), np.bincount(y.astype(int), minlength=2)
    prior = np.array([sizes.get(k, 0) / max(1, total) / max(1, counts[k]) * len(rows) for k in (0, 1)])
    return fit([r[2].encode() for r in rows], y, prior[y.astype(int)] if len(rows) else None)


def score(docs: DataFrame, network: Network, carried: tuple[str, ...] = ("doc_id",), text_column: str = "text") -> DataFrame:
    """One row per document: the ``carried`` columns and ``score`` (0 to 1) of its whole text.

    Null and empty texts are scored as one chunk of zeros; repeated rows are
    scored each on its own, alike up to rounding; an empty table gives no rows. No other
    column plays a part, and a carried one called ``score`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)
    names = [c for c in carried if c != "score"]
    rows = docs.select(*(F.col(f"`{c}`") for c in names), text_or_empty(text_column).alias("_qc_text"))
    schema = T.StructType([*(rows.schema[c] for c in names), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            scores, texts, size = [], [], 0
            for text in batch.column(len(names)):
                texts.append(text.as_py().encode())
                size += len(texts[-1])
                if size > 2_000_000:
                    scores.append(net.scores(texts))
                    texts, size = [], 0
            if texts:
                scores.append(net.scores(texts))
            if scores:
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(np.concatenate(scores), pa.float64())], [*names, "score"])

    return rows.mapInArrow(run, schema)
