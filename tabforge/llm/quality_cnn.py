"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tabforge.llm.common import text_bytes

STRIDE = 8          # a chunk is two strides wide, so each byte but the outermost is in two chunks
PAD = 256
LAGS = 24
RUN = 4
SLICE = 1 << 20


@dataclass
class Net:
    """``embed`` (257 x e), ``first`` and ``second`` ((stride * (e + 1)) x filters: a chunk's two
    halves), ``bias``, ``out`` (filters), ``shift``."""

    embed: np.ndarray
    first: np.ndarray
    second: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: float


def new_net(filters: int = 24, dims: int = 5, seed: int = 7) -> Net:
    rng = np.random.default_rng(seed)
    wide = STRIDE * (dims + 1)
    draw = lambda *s: rng.normal(0, 1 / np.sqrt(2 * wide), s).astype(np.float32)
    return Net(rng.normal(0, 1, (257, dims)).astype(np.float32), draw(wide, filters),
               draw(wide, filters), np.zeros(filters, np.float32),
               rng.normal(0, 0.3, filters).astype(np.float32), 0.0)


def repeats(x: np.ndarray) -> np.ndarray:
    """1 where the RUN bytes from here equal those 1 to LAGS bytes further on: an input channel
    that lets linear filters see stutter."""
    out = np.zeros(len(x), bool)
    for lag in range(1, LAGS + 1):
        if len(x) < lag + RUN:
            break
        same = x[lag:] == x[:-lag]
        run = same[:len(same) - RUN + 1].copy()
        for k in range(1, RUN):
            run &= same[k:len(same) - RUN + 1 + k]
        out[:len(run)] |= run
    return out


def halves(net: Net, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A text as (n, stride) byte codes and (n, stride * (e + 1)) inputs; at least two halves,
    the last one padded."""
    x = np.frombuffer(raw, np.uint8)
    n = max(2, -(-len(x) // STRIDE))
    codes = np.full(n * STRIDE, PAD, np.int16)
    codes[:len(x)] = x
    rows = np.empty((n * STRIDE, net.embed.shape[1] + 1), np.float32)
    rows[:, :-1] = net.embed[codes]
    rows[:, -1] = 0
    rows[:len(x), -1] = repeats(x)
    return codes.reshape(n, STRIDE), rows.reshape(n, -1)


def pooled(net: Net, raw: bytes) -> np.ndarray:
    """Each filter's largest answer over all chunks of the text, taken slice by slice; slices
    overlap by half a chunk, so memory doesn't grow with the text."""
    best = np.full(len(net.bias), -np.inf, np.float32)
    for lo in range(0, max(1, len(raw)), SLICE):
        _, h = halves(net, raw[lo:lo + SLICE + STRIDE])
        best = np.maximum(best, ((h @ net.first)[:-1] + (h @ net.second)[1:]).max(axis=0))
    return np.maximum(best + net.bias, 0)


def probability(net: Net, raw: bytes) -> float:
    return float(1 / (1 + np.exp(-(pooled(net, raw) @ net.out + net.shift))))


def train(texts: list[bytes], labels: list[int], filters: int = 24, dims: int = 5,
          steps: int = 900, batch: int = 32, rate: float = 0.01, seed: int = 7) -> Net:
    """Adam on the logistic loss over whole texts.  With max pooling the gradient of a text comes
    from one chunk per filter.  One class only, or no texts: a constant probability."""
    net, y = new_net(filters, dims, seed), np.array(labels, np.float32)
    if len(set(labels)) < 2:
        net.out[:] = 0
        net.shift = 0.0 if not labels else (4.0 if labels[0] else -4.0)
        return net
    rng, wide = np.random.default_rng(seed), STRIDE * (dims + 1)
    net.shift = float(np.log(y.mean() / (1 - y.mean())))
    params = [net.embed, net.first, net.second, net.bias, net.out, np.array([net.shift], np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    order = np.zeros(0, int)
    for step in range(1, steps + 1):
        if len(order) < batch:
            order = np.concatenate([order, rng.permutation(len(y))])
        pick, order = order[:batch], order[batch:]
        grads = [np.zeros_like(p) for p in params]
        for i in pick:
            codes, h = halves(net, texts[i])
            z = (h @ net.first)[:-1] + (h @ net.second)[1:]
            at = z.argmax(axis=0)
            top = z[at, np.arange(filters)] + net.bias
            act = np.maximum(top, 0)
            p = 1 / (1 + np.exp(-(act @ net.out + params[5][0])))
            d = (p - y[i]) / len(pick)
            grads[4] += d * act
            grads[5] += d
            back = np.where(top > 0, d * net.out, 0)
            grads[3] += back
            for side, weight in ((0, net.first), (1, net.second)):
                grads[1 + side] += h[at + side].T * back
                into = (weight * back).T.reshape(filters, STRIDE, dims + 1)[:, :, :dims]
                np.add.at(grads[0], codes[at + side].ravel(), into.reshape(-1, dims))
        fade = rate * min(1, 2 * (1 - (step - 1) / steps))
        for k, p in enumerate(params):
            first[k] += 0.1 * (grads[k] - first[k])
            second[k] += 0.01 * (grads[k] ** 2 - second[k])
            p -= fade * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
    net.shift = float(params[5][0])
    return net


def held_out(id_col: Column, folds: int = 5) -> Column:
    """Rows that no training may see: crc32 of the id as text is a multiple of ``folds`` (null
    ids: always)."""
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == 0


def training_rows(docs: DataFrame, labels: DataFrame, max_docs: int, max_doc_bytes: int,
                  id_col: str, text_col: str, label_col: str) -> list[tuple[bytes, int]]:
    """At most ``max_docs`` labelled rows that aren't held out, in the order of their ids' hash,
    with texts of at most ``max_doc_bytes`` (a longer one is left out, not cut)."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)
                          & ~held_out(F.col(id_col)))
             .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("_y"))
             .withColumn("_o", F.xxhash64("_id")).orderBy("_o", "_id").limit(max_docs))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_t"))
    # ``known`` has at most max_docs rows of three numbers.
    rows = (texts.where(F.octet_length("_t") <= max_doc_bytes).join(F.broadcast(known), "_id")
            .orderBy("_o", "_id", F.sha1("_t")).limit(max_docs).collect())
    return [(bytes(r["_t"]), r["_y"]) for r in rows]


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 3000, max_doc_bytes: int = 16384,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **kwargs) -> Net:
    """Fit on the bounded sample of :func:`training_rows` (48 MB at the defaults)."""
    rows = training_rows(docs, labels, max_docs, max_doc_bytes, id_col, text_col, label_col)
    return train([t for t, _ in rows], [y for _, y in rows], **kwargs)


def score(docs: DataFrame, net: Net, threshold: float = 0.3, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``docs`` with ``held_out``, ``score`` (the probability of label 1) and ``predicted``
    (score >= threshold); columns of these names are replaced.

    One scan, no shuffle; the network of some ten thousand numbers goes with the task.  Every byte
    of the text is in a chunk.  Null and empty texts are padding only and get that score.
    """

    @arrow_udf("double")
    def quality(text: pa.Array) -> pa.Array:
        return pa.array([probability(net, raw) for raw in text_bytes(text)], pa.float64())

    scored = docs.withColumns({"held_out": held_out(F.col(id_col)), "score": quality(F.col(text_col))})
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, net: Net, threshold: float = 0.3, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The documents that the classifier doesn't reject, with the columns of ``docs``."""
    tagged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                         F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return (score(tagged, net, threshold, "_id", "_text").where(F.col("predicted") == 1)
            .select("_row.*"))
