"""Quality classifier with supervised subword embeddings.

Every n-gram of 3 to 5 bytes of UTF-8 (of characters, where they are ASCII; n-grams run over the spaces between words), every word and
every word pair of a text is hashed to a learned vector; a document is the mean of its vectors, a softmax
over two classes turns that into probabilities. Vectors and softmax weights are trained together by stochastic gradient descent in
numpy, one document after the other. As the output is linear in the mean, scoring needs one number a bucket: the difference of the
two classes' weights applied to its vector.

The fit takes a bounded sample of labelled rows (`rows`, those with the least hash of their id), the scores take every text whole.

Defined cases: a null or empty text has no features and scores as the bias alone; a text of any length is averaged whole; rows with a
null id are scored; repeated rows score alike; labels without a row, or null labels, aren't used; without labels of both classes the
score is 0.5 for all; other columns are dropped, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import hash_words, map_batches, mixed, text_bytes, words_of

ORDERS = (3, 4, 5)
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def held_out(key: Column) -> Column:
    """The rows that no fit may see: crc32 of the id's text leaves 2 when divided by 4."""
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


class Features:
    """Bucket numbers of a batch of texts: one array for each kind of feature, with the bounds of each document in it."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)

    def of(self, raw: np.ndarray, offsets: np.ndarray):
        with np.errstate(over="ignore"):
            wide, packed, n = raw.astype(np.uint64), None, len(raw)
            ends = offsets[1:]
            for order in range(1, max(ORDERS) + 1):
                size = max(0, n - order + 1)
                tail = wide[order - 1 :] << np.uint64(8 * (order - 1))
                packed = tail if packed is None else packed[:size] + tail
                if order in ORDERS:
                    inside = np.ones(size, bool)  # n-grams don't cross documents
                    for back in range(1, order):
                        at = ends - back
                        inside[at[(at >= 0) & (at < size)]] = False
                    counts = np.r_[0, np.cumsum(inside)]
                    yield ((packed[inside] + np.uint64(order)) * FACTOR) >> self.shift, counts[np.minimum(offsets, size)]
            starts, stops, first = words_of(raw, offsets)
            one = hash_words(raw, starts, stops, 3)
            yield one >> self.shift, first
            pair = mixed(one[:-1] * FACTOR + one[1:]) >> self.shift if len(one) else one
            pair[one[1:] == one[:-1]] = 0  # a word and itself again: one vector for all such pairs
            inside = np.ones(len(pair), bool)
            inside[first[1:-1][(first[1:-1] > 0) & (first[1:-1] <= len(pair))] - 1] = False
            counts = np.r_[0, np.cumsum(inside)]
            yield pair[inside], counts[np.minimum(first, len(pair))]


@dataclass
class QualityModel:
    bits: int
    weights: np.ndarray  # one number a bucket
    bias: float

    def scores(self, column: pa.Array, features: Features) -> np.ndarray:
        """The probability of label 1 for each text."""
        raw, offsets = text_bytes(column)
        total, count = np.zeros(len(column)), np.zeros(len(column))
        for buckets, bounds in features.of(raw, offsets):
            sums = np.r_[0.0, np.cumsum(self.weights[buckets], dtype=np.float64)]
            total += sums[bounds[1:]] - sums[bounds[:-1]]
            count += np.diff(bounds)
        return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + self.bias)))


def train(texts: list[str | None], labels: list[int], bits: int = 17, dim: int = 8, epochs: int = 4, rate: float = 40.0, seed: int = 5) -> QualityModel:
    """Stochastic gradient descent over (text, 0 or 1); the rate falls to nought."""
    if len(set(labels)) < 2:
        return QualityModel(bits, np.zeros(1 << bits, np.float32), 0.0)
    features, rng = Features(bits), np.random.default_rng(seed)
    docs = []
    for text in texts:
        raw, offsets = text_bytes(pa.array([text], pa.string()))
        buckets = np.concatenate([b for b, _ in features.of(raw, offsets)])
        found, counts = np.unique(buckets.astype(np.int64), return_counts=True)
        docs.append((found.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)))
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    weights, bias = rng.normal(0, 0.5, (dim, 2)).astype(np.float32), np.zeros(2, np.float32)
    targets = np.array(labels)
    for epoch in range(epochs):
        for step, i in enumerate(rng.permutation(len(docs))):
            now = rate * (1 - (epoch + step / len(docs)) / epochs)
            found, share = docs[i]
            mean = share @ vectors[found] if len(found) else np.zeros(dim, np.float32)
            logits = mean @ weights + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[targets[i]] -= 1
            if len(found):
                vectors[found] -= now * np.outer(share, weights @ p)
            weights -= 0.02 * now / rate * np.outer(mean, p)
            bias -= 0.02 * now / rate * p
    return QualityModel(bits, (vectors @ (weights[:, 1] - weights[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = 2000) -> QualityModel:
    """The model of at most `rows` labelled rows that aren't held out, with the least hash of their id; only they reach the driver."""
    chosen = labels.filter(~held_out(F.col(key)) & F.col(label).isNotNull()).select(key, label)
    chosen = chosen.orderBy(F.xxhash64(key), key, label).limit(rows)
    sample = docs.select(key, text).join(F.broadcast(chosen), key).orderBy(F.xxhash64(key), key, text).limit(rows).collect()
    return train([r[text] for r in sample], [int(r[label]) for r in sample])


def score(docs: DataFrame, model: QualityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score double for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits numbers, whatever the data

    def make():
        here = shared.value
        features = Features(here.bits)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = [here.scores(batch.column(1).slice(i, 128), features) for i in range(0, batch.num_rows, 128)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out))], [key, "score"])

        return work

    return map_batches(docs.select(key, text), make, f"`{key}` {docs.schema[key].dataType.simpleString()}, score double")


def with_score(docs: DataFrame, model: QualityModel, text: str = "text", out: str = "score") -> DataFrame:
    """docs as they are, and the score of each row; a column that has the name already raises ValueError."""
    if out in docs.columns:
        raise ValueError(f"docs has a column {out} already")
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def make():
        here = shared.value
        features = Features(here.bits)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = [here.scores(batch.column(at).slice(i, 128), features) for i in range(0, batch.num_rows, 128)]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores))], [*batch.schema.names, out])

        return work

    return map_batches(docs, make, StructType([*docs.schema.fields, StructField(out, DoubleType())]))
