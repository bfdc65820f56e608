"""Language ID by a byte convolutional network: filters of several widths, max pooling and softmax, in numpy.

A text is folded (A-Z lower-cased, white space to blanks) and cut into windows of WINDOW bytes, the whole of it; the last is
filled up with zeros. A filter of width w adds one learned number for each of w bytes, so a convolution is a table look-up
at every tap; each filter's largest value in the window goes to a softmax over the languages. A document's prediction is the
language with the largest sum of log-probabilities over its windows, weighted by their bytes; its score is that language's
mean probability.

The network is fitted on the driver to a bounded sample: one window of each of at most TRAIN_DOCS texts of a language, and at most
TRAIN_WINDOWS windows in all, which the languages share alike (one each, should there be more of them than that). Texts are chosen by
a hash of id and text, and the window's place in the whole text by another. Prediction runs where the texts are.

A null text, or one without letters, is `und` with score 0. Rows without a language train nothing; without any labelled row
every text is `und`. Rows that repeat are predicted alike, and train once; ids may be of any type; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm.frames import map_text
from foliary.llm.kernels import LOWER, spread

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Bounds of the training sample.
TRAIN_DOCS = 800
TRAIN_WINDOWS = 6000
EPOCHS = 8
UNKNOWN = "und"

_FOLD = LOWER.copy()
_FOLD[[9, 10, 11, 12, 13]] = 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[97:123] = True


def windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded windows (n, WINDOW), the text of each and its bytes."""
    data, offsets = spread(texts)
    data = _FOLD[data]
    sizes = np.diff(offsets)
    count = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    held = np.minimum(sizes[owner] - nth * WINDOW, WINDOW)
    out = np.zeros((len(owner), WINDOW), np.uint8)
    filled = np.arange(WINDOW) < held[:, None]
    out[filled] = data
    return out, owner, held


@dataclass
class Network:
    """taps[i]: (width, 256, FILTERS) numbers of the filters of WIDTHS[i]; bias; the softmax layer; the languages."""

    languages: list[str]
    taps: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def features(self, x: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Pooled filter values (n, filters), and where each one's maximum lies."""
        values, places = [], []
        for w, taps in zip(WIDTHS, self.taps, strict=True):
            total = np.take(taps[0], x[:, : WINDOW - w + 1], axis=0)
            for j in range(1, w):
                total += np.take(taps[j], x[:, j : WINDOW - w + 1 + j], axis=0)
            if where:
                places.append(total.argmax(1))
                values.append(np.take_along_axis(total, places[-1][:, None], 1)[:, 0])
            else:
                values.append(total.max(1))
        return np.maximum(np.concatenate(values, 1) + self.bias, 0), np.concatenate(places, 1) if where else None

    def log_probabilities(self, x: np.ndarray, batch: int = 128) -> np.ndarray:
        out = np.empty((len(x), len(self.languages)), np.float64)
        for a in range(0, len(x), batch):
            z = (self.features(x[a : a + batch])[0] @ self.weights + self.offset).astype(np.float64)
            z -= z.max(1, keepdims=True)
            out[a : a + batch] = z - np.log(np.exp(z).sum(1, keepdims=True))
        return out


def fit(x: np.ndarray, y: np.ndarray, languages: Sequence[str], *, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.01, seed: int = 5) -> Network:
    """Adam on the cross-entropy; gradients of a pooled filter go to the bytes at its maximum."""
    r = np.random.default_rng(seed)
    n = FILTERS * len(WIDTHS)
    net = Network(list(languages), [r.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS], np.zeros(n, np.float32), r.normal(0, 0.1, (n, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))
    params = [*net.taps, net.bias, net.weights, net.offset]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = r.permutation(len(x))
        for a in range(0, len(x), batch):
            rows = order[a : a + batch]
            own = x[rows]
            f, places = net.features(own, where=True)
            z = f @ net.weights + net.offset
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            back = (p @ net.weights.T) * (f > 0)
            grads = []
            for i, w in enumerate(WIDTHS):
                part, at, g = back[:, i * FILTERS : (i + 1) * FILTERS], places[:, i * FILTERS : (i + 1) * FILTERS], np.zeros_like(net.taps[i])
                for j in range(w):
                    np.add.at(g[j], (np.take_along_axis(own, at + j, 1), np.arange(FILTERS)[None]), part)
                grads.append(g)
            grads += [back.sum(0), f.T @ p, p.sum(0)]
            step += 1
            for q, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def held_out(doc_id: str = "doc_id") -> Column:
    """True for documents that never train: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", docs: int = TRAIN_DOCS, most: int = TRAIN_WINDOWS) -> Network | None:
    """A network fitted to a sample of the labelled rows that are not held out; None if there are none."""
    rows = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")).where(~held_out("doc_id") & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    each = max(1, min(docs, most // len(counts)))
    top = 1 << 30
    limit = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(top * min(1.0, each / n)))])[F.col("lang")]
    drawn = rows.withColumn("draw", F.pmod(F.xxhash64("doc_id", "text"), F.lit(top))).where(F.col("draw") < limit)

    def make():
        return lambda texts: [pa.array([_drawn(t.as_py()) for t in texts], pa.binary())]

    picked = map_text(drawn.select("lang", "draw", "text"), make, [("window", "binary")], keep=("lang", "draw"))
    once = picked.groupBy("lang", "draw").agg(F.min("window").alias("window")).groupBy("lang").agg(F.slice(F.array_sort(F.collect_list(F.struct("draw", "window"))), 1, each).alias("own"))
    got = sorted((r["lang"], w["draw"], bytes(w["window"])) for r in once.collect() for w in r["own"])
    languages = sorted({g[0] for g in got})
    if not languages:
        return None
    x = np.frombuffer(b"".join(g[2] for g in got), np.uint8).reshape(-1, WINDOW)
    return fit(x, np.array([languages.index(g[0]) for g in got]), languages)


def _drawn(text: bytes) -> bytes:
    """A folded window from anywhere in the text, as its hash has it; a short text is one window."""
    start = zlib.crc32(text) % max(len(text) - WINDOW + 1, 1)
    return windows(pa.array([text[start : start + WINDOW]], pa.large_binary()))[0][0].tobytes()


def _lettered(texts: pa.Array) -> np.ndarray:
    data, offsets = spread(texts)
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_ASCII_LETTER[_FOLD[data]], out=total[1:])
    has = total[offsets[1:]] > total[offsets[:-1]]
    for i in np.flatnonzero(~has).tolist():
        t = texts[i].as_py()
        has[i] = not t.isascii() and any(unicodedata.category(c)[0] == "L" for c in set(t.decode("utf-8", "replace")))
    return has


def identify(documents: DataFrame, network: Network | None, *, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, lang_pred and score of every document."""
    sent = documents.sparkSession.sparkContext.broadcast(network)

    def make():
        net = sent.value

        def kernel(texts):
            n = len(texts)
            if net is None:
                return [pa.array([UNKNOWN] * n, pa.string()), pa.array(np.zeros(n))]
            x, owner, held = windows(texts)
            logs = net.log_probabilities(x)
            total, mean, size = np.zeros((n, logs.shape[1])), np.zeros((n, logs.shape[1])), np.maximum(np.bincount(owner, held, n), 1)
            for k in range(logs.shape[1]):
                total[:, k] = np.bincount(owner, logs[:, k] * held, n)
                mean[:, k] = np.bincount(owner, np.exp(logs[:, k]) * held, n) / size
            best, known = total.argmax(1), _lettered(texts)
            names = [net.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            return [pa.array(names, pa.string()), pa.array(np.where(known, np.clip(mean[np.arange(n), best], 0, 1), 0.0))]

        return kernel

    return map_text(documents, make, [("lang_pred", "string"), ("score", "double")], text=text, keep=keep)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(documents, train(documents)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
