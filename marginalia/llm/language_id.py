"""Language of whole texts by a convolutional network over bytes.

Bytes are embedded; filters of several widths run over a fixed-length window, each keeps its
largest response, and a softmax over these says which language the window is in. The
network is trained in numpy on windows of a bounded sample of labelled texts. A text is
covered by windows from its start to its end, each overlapping the next by the widest filter; its
probabilities are the mean of its windows', weighted by their bytes.

In use the embedding and a filter's weights at one position are one table of 256 rows, so a response
is a sum of looked-up rows.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0, and so are all
texts where nothing labelled is there to learn from; rows that repeat get the same answer; an
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.batches import pieces
from marginalia.llm.samples import per_class

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
PAD = 256
# Bounds of the training sample: texts of each language, and windows of each text.
TEXTS_PER_CLASS = 600
WINDOWS_PER_TEXT = 3
EPOCHS = 6
LEAST_STEPS = 600
BATCH = 64
# Texts of more doubt are in no known language; so many bytes without doubt are put to each text.
MOST_DOUBT = 0.5
DOUBT_BYTES = 20

_STEP = WINDOW - max(WIDTHS) + 1


def windows(text: bytes) -> np.ndarray:
    """All windows of a text, one per row; the last is padded."""
    n = max(1, -(-(len(text) - max(WIDTHS) + 1) // _STEP))
    padded = np.full((n - 1) * _STEP + WINDOW, PAD, np.int16)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::_STEP]


def _sizes(text: bytes) -> np.ndarray:
    """Bytes in each window."""
    n = max(1, -(-(len(text) - max(WIDTHS) + 1) // _STEP))
    return np.minimum(WINDOW, len(text) - _STEP * np.arange(n))


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class Network:
    classes: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    seen: np.ndarray  # of all pairs of bytes, those that the training windows hold

    def unseen(self, text: bytes) -> float:
        """Share of a text's neighbouring bytes that training never met side by side."""
        raw = np.frombuffer(text, np.uint8).astype(np.int32)
        return 1 - float(self.seen[raw[:-1] * 256 + raw[1:]].mean()) if len(raw) > 1 else 0.0

    def tables(self) -> list[np.ndarray]:
        """For each width, (position in the filter, byte, filter) responses."""
        return [
            np.stack([self.embedding @ w[o * EMBEDDING : (o + 1) * EMBEDDING] for o in range(width)])
            for width, w in zip(WIDTHS, self.filters)
        ]

    def predictor(self) -> Callable[[np.ndarray], np.ndarray]:
        tables = self.tables()

        def predict(x: np.ndarray) -> np.ndarray:
            pooled = []
            for width, table in zip(WIDTHS, tables):
                span = WINDOW - width + 1
                response = table[0].take(x[:, :span], axis=0)
                for o in range(1, width):
                    response += table[o].take(x[:, o : o + span], axis=0)
                pooled.append(response.max(axis=1))
            hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
            return _softmax(hidden @ self.dense + self.dense_bias)

        return predict


def train(texts: list[bytes], labels: list[str], seed: int = 0) -> Network | None:
    """Adam on the cross-entropy of windows drawn from all over each text."""
    classes = sorted(set(labels))
    if not classes:
        return None
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    for text, label in zip(texts, labels):
        found = windows(text)
        for row in rng.permutation(len(found))[:WINDOWS_PER_TEXT]:
            xs.append(found[row])
            ys.append(classes.index(label))
    x, y = np.array(xs), np.array(ys)
    hidden = FILTERS * len(WIDTHS)
    shapes = [(257, EMBEDDING), *((w * EMBEDDING, FILTERS) for w in WIDTHS), (hidden,), (hidden, len(classes)), (len(classes),)]
    params = [rng.normal(0, 0.5 / np.sqrt(s[0]) if i else 0.5, s).astype(np.float32) for i, s in enumerate(shapes)]
    params[0][PAD] = 0
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    weight = len(y) / (len(classes) * np.bincount(y, minlength=len(classes)))
    step = 0
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // len(y)))):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // BATCH)):
            step += 1
            grads = _gradients(params, x[rows], y[rows], weight[y[rows]].astype(np.float32))
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            params[0][PAD] = 0
    embedding, *filters, bias, dense, dense_bias = params
    seen = np.zeros(1 << 16, bool)
    for row in xs:
        real = row[row != PAD].astype(np.int32)
        seen[real[:-1] * 256 + real[1:]] = True
    return Network(classes, embedding, filters, bias, dense, dense_bias, seen)


def _gradients(params: list[np.ndarray], x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    embedding, *filters, bias, dense, dense_bias = params
    n = len(y)
    embedded = embedding[x]
    pooled, where = [], []
    for width, w in zip(WIDTHS, filters):
        span = WINDOW - width + 1
        response = sum(embedded[:, o : o + span] @ w[o * EMBEDDING : (o + 1) * EMBEDDING] for o in range(width))
        where.append(response.argmax(axis=1))
        pooled.append(np.take_along_axis(response, where[-1][:, None], axis=1)[:, 0])
    before = np.concatenate(pooled, axis=1) + bias
    hidden = np.maximum(before, 0)
    out = _softmax(hidden @ dense + dense_bias)
    out[np.arange(n), y] -= 1
    out *= weight[:, None] / n
    back = (out @ dense.T) * (before > 0)
    d_embedding = np.zeros_like(embedding)
    d_filters = []
    for k, (width, w) in enumerate(zip(WIDTHS, filters)):
        flow = back[:, k * FILTERS : (k + 1) * FILTERS]  # only the largest response has a gradient
        d_w = np.empty_like(w)
        for o in range(width):
            part = slice(o * EMBEDDING, (o + 1) * EMBEDDING)
            seen = x[np.arange(n)[:, None], where[k] + o]
            d_w[part] = np.einsum("nfe,nf->ef", embedding[seen], flow)
            np.add.at(d_embedding, seen, flow[:, :, None] * w[part].T[None])
        d_filters.append(d_w)
    return [d_embedding, *d_filters, back.sum(axis=0), hidden.T @ out, out.sum(axis=0)]


def fit(docs: DataFrame, label: str = "lang", text: str = "text", key: str = "doc_id") -> Network | None:
    """Train on at most TEXTS_PER_CLASS labelled texts of each language."""
    known = docs.filter(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(label).cast("string").alias("label"), F.col(key).alias("key"), F.col(text).alias("text")
    )
    rows = sorted(per_class(known, "label", "key", TEXTS_PER_CLASS).collect(), key=lambda r: (r["label"], str(r["key"]), r["text"]))
    return train([r["text"].encode() for r in rows], [r["label"] for r in rows])


def identify(docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score of every whole text."""
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = network.predictor() if network else None
        for piece in pieces(batches):
            found = [_one(t, predict, network) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("key"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["key", "lang_pred", "score"],
            )

    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {key_type}, lang_pred string, score double"
    )
    return out.withColumnRenamed("key", key)


def _one(
    text: str | None, predict: Callable | None, network: Network | None, doubted: bool = False
) -> tuple[str, float, float]:
    """Language, score, and, if ``doubted``, doubt: 0 where every window is sure of its language, 1 where none tells any.

    Sure is what the network makes of a window, by the entropy of its answer as a share of the largest
    possible, times the share of the text's byte pairs that training met: an answer about letters never
    seen is none. The mean over windows is shrunk by DOUBT_BYTES, since a few letters are no
    sign that a text is in no known language.
    """
    # Letters as in ``fit``: numerals such as "²", which are word characters, are none.
    if predict is None or text is None or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, 1.0
    raw = text.encode()
    x, sizes = windows(raw), _sizes(raw)
    total, entropy = np.zeros(len(network.classes)), 0.0
    for i in range(0, len(x), BATCH):
        found, weight = predict(x[i : i + BATCH]), sizes[i : i + BATCH]
        total = total + weight @ found
        if doubted:
            entropy -= float(weight @ (found * np.log(np.maximum(found, 1e-12))).sum(axis=1))
    mean = total / sizes.sum()
    best = int(mean.argmax())
    if not doubted:
        return network.classes[best], min(1.0, float(mean[best])), 0.0
    unsure = max(0.0, entropy) / np.log(max(2, len(network.classes))) / sizes.sum()
    doubt = (1 - (1 - unsure) * (1 - network.unseen(raw))) * sizes.sum() / (sizes.sum() + DOUBT_BYTES)
    return network.classes[best], min(1.0, float(mean[best])), float(doubt)


def keep_identified(docs: DataFrame, network: Network | None, most_doubt: float = MOST_DOUBT) -> DataFrame:
    """Documents, with all their columns, whose language is told with at most ``most_doubt``.

    Doubt is a share of the largest possible, whatever the number of languages. A text in two known
    languages is kept: its windows tell one each, or two of several. Texts without letters go;
    where no language was learned, all go. Answers come back to their rows as a column, so nothing is
    joined and no text moves.
    """
    return docs.filter(_accepted(network, most_doubt)(F.col("text")))


def _accepted(network: Network | None, most_doubt: float):
    @F.pandas_udf("boolean")
    def accepted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = network.predictor() if network else None
        for texts in batches:
            found = (_one(t, predict, network, doubted=True) for t in texts)
            yield pd.Series([lang != UNKNOWN and doubt <= most_doubt for lang, _, doubt in found], dtype=bool)

    return accepted
