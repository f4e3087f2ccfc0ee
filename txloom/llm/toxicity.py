"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Which n-grams a text holds (not how often) are its features. From a bounded sample of labelled rows come,
for each n-gram, the smoothed log ratio of its share in toxic and in other texts (Wang and Manning 2012);
the n-grams that tell the labels apart best are kept, their ratios scale the features, and logistic
regression is fitted on these. Scoring reads every text whole, in the task that holds it.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from txloom.llm.shared import mix64, rows, stored, texts

#: Lengths of n-grams, in characters of the lower-cased text.
SIZES = (4, 5)
#: Labelled rows the classifier is fitted on, at most; of more, those whose hashed ids are smallest.
FIT_ROWS = 12_000
#: N-grams that are kept, at most, and texts of the sample that must hold one.
FEATURES = 4_096
MIN_TEXTS = 3
SMOOTHING = 1.0
PENALTY = 2e-3
STEPS = 250
RATE = 0.02
_SLOTS = 1 << 20


def ngrams(text: str) -> np.ndarray:
    """64-bit hashes of all n-grams of the text, with repeats."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    found = []
    for n in SIZES:
        m = len(points) - n + 1
        if m > 0:
            h = np.full(m, n, np.uint64)
            for k in range(n):
                h = h * np.uint64(0x9E3779B97F4A7C15) + points[k : k + m]
            found.append(mix64(h))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


@dataclass(frozen=True)
class Model:
    """Kept n-grams in ascending order of their hashes, their weights, and the intercept."""

    hashes: np.ndarray
    weights: np.ndarray
    intercept: float

    def present(self, text: str) -> np.ndarray:
        """Which kept n-grams the text holds."""
        found = ngrams(text)
        found = found[self._slots()[found >> np.uint64(44)]]
        at = np.minimum(np.searchsorted(self.hashes, found), max(0, len(self.hashes) - 1))
        return np.unique(at[self.hashes[at] == found]) if len(found) and len(self.hashes) else np.empty(0, np.int64)

    def _slots(self) -> np.ndarray:
        """By the upper bits of a hash: whether a kept n-gram has them."""
        if "slots" not in self.__dict__:
            slots = np.zeros(_SLOTS, bool)
            slots[self.hashes >> np.uint64(44)] = True
            object.__setattr__(self, "slots", slots)
        return self.__dict__["slots"]

    def score(self, text: str | None) -> float:
        z = self.intercept + float(self.weights[self.present(text or "")].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def fit_sample(docs: DataFrame, labels: DataFrame, fit_rows: int, id_column: str, text_column: str, label_column: str) -> DataFrame:
    """text, toxic of at most `fit_rows` labelled rows, stored. Rows without id or label are left out."""
    named = labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label_column).cast("int").alias("toxic"))
    chosen = named.dropna().distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(fit_rows)
    joined = texts(docs, id_column, text_column).join(F.broadcast(chosen), "doc_id")  # at most fit_rows rows
    # of several texts of an id the first by hash stands for it, so that neither copies nor an id used again outweigh others
    one = joined.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("first"))
    return stored(one.select("first.text", "toxic"), "toxicity-sample")


def _ratios(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and log-count ratios of the n-grams that tell the labels apart best."""

    def count(batches: Iterable) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(np.unique(ngrams(text)), toxic) for text, toxic in rows([batch], "text", "toxic")]
            every = np.concatenate([h for h, _ in found]) if found else np.empty(0, np.uint64)
            toxic = np.repeat([t for _, t in found], [len(h) for h, _ in found])
            h, at = np.unique(every, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(np.bincount(at, toxic == 1, len(h)).astype(np.int64)), pa.array(np.bincount(at, toxic != 1, len(h)).astype(np.int64))],
                ["h", "toxic", "other"],
            )

    counts = sample.mapInArrow(count, "h long, toxic long, other long").groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    totals = sample.agg(F.sum((F.col("toxic") == 1).cast("long")).alias("t"), F.sum((F.col("toxic") != 1).cast("long")).alias("o")).first()
    t, o = float(totals["t"] or 0), float(totals["o"] or 0)
    if not t or not o:
        return np.empty(0, np.uint64), np.empty(0)
    a, b = F.col("toxic"), F.col("other")
    apart = (a * (o - b) - b * (t - a)) ** 2 / ((a + b) * (t + o - a - b + 1))  # chi-square but for a constant
    best = counts.where(a + b >= MIN_TEXTS).orderBy(apart.desc(), "h").limit(FEATURES).toArrow().to_pandas()  # at most FEATURES rows
    best = best.assign(u=best["h"].to_numpy().view(np.uint64)).sort_values("u")
    p, q = best["toxic"].to_numpy() + SMOOTHING, best["other"].to_numpy() + SMOOTHING
    return best["u"].to_numpy(), np.log(p / (t + 2 * SMOOTHING)) - np.log(q / (o + 2 * SMOOTHING))


def _logistic(present: list[np.ndarray], toxic: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights on features scaled by `ratios`, and the intercept: penalised likelihood by Adam steps over all rows."""
    n, features = len(present), len(ratios)
    text = np.repeat(np.arange(n), [len(x) for x in present])
    feature = np.concatenate(present).astype(np.int64)
    value = ratios[feature]
    share = np.clip(toxic.mean(), 1e-6, 1 - 1e-6)
    w = np.append(np.zeros(features), np.log(share / (1 - share)))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = w[-1] + np.bincount(text, value * w[feature], n)
        error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - toxic) / n
        slope = np.append(np.bincount(feature, value * error[text], features) + PENALTY * w[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w[:-1] * ratios, float(w[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    fit_rows: int = FIT_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> Model:
    """A model from the labelled rows of `docs`, at most `fit_rows` of them.

    Null texts count as empty. Without rows of both labels the model scores every text by the share of
    toxic rows, 0 without any row. Only hashes of the kept n-grams per sampled text reach the driver.
    """
    sample = fit_sample(docs, labels, fit_rows, id_column, text_column, label_column)
    hashes, ratios = _ratios(sample)
    bare = Model(hashes, np.zeros(len(hashes)), 0.0)
    shared = sample.sparkSession.sparkContext.broadcast(bare)  # at most FEATURES numbers

    def features(batches: Iterable) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.present(x).astype("<u2").tobytes() for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column("toxic")], ["present", "toxic"])

    # at most fit_rows rows of at most FEATURES 16-bit numbers
    held = sample.mapInArrow(features, "present binary, toxic int").toArrow().to_pandas().sort_values(["toxic", "present"])
    toxic = (held["toxic"].to_numpy() == 1).astype(float)
    if not len(hashes):
        share = float(toxic.mean()) if len(toxic) else 0.0
        return Model(hashes, np.zeros(0), float(np.log(max(share, 1e-12) / max(1 - share, 1e-12))))
    weights, intercept = _logistic([np.frombuffer(x, "<u2") for x in held["present"]], toxic, ratios)
    return Model(hashes, weights, intercept)


def score(docs: DataFrame, model: Model, text_column: str = "text", into: str = "score") -> DataFrame:
    """`docs` with a column `into` from 0 to 1. A null text is scored as an empty one; no row is added or dropped."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def scores(column: pd.Series) -> pd.Series:
        return column.map(shared.value.score).astype(float)

    return docs.withColumn(into, scores(F.coalesce(F.col(text_column), F.lit(""))))
