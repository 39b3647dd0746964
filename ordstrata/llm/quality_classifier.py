"""Quality of documents by co-training a text view and a metadata view."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordstrata.llm.common import shared, stored
from ordstrata.llm.quality_rules import FUNCTION_WORDS

MEASURES = [f"m{i}" for i in range(14)]
BINS = 12
SOURCES, LANGS, SIZES = 64, 16, 24
MARKS = re.compile(r"[^\w\s]")
RUNS = re.compile(r"[^\w\s]{2,}")
KNOWN = frozenset(FUNCTION_WORDS)


def measures(text: str | None) -> list[float]:
    """Numbers of a whole text that tell prose from noise."""
    text = text or ""
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, re.findall(r"[^\W\d_]+", text)))
    twice = sum(a == b for a, b in zip(words, words[1:]))
    upper = sum(map(len, re.findall(r"[A-ZÀ-ÖØ-Þ]+", text)))
    return [
        math.log1p(len(words)),
        len(text) / n,
        letters / chars,
        upper / max(1, letters),
        sum(map(len, re.findall(r"[0-9]+", text))) / chars,
        len(MARKS.findall(text)) / n,
        len(RUNS.findall(text)) / n,
        len(re.findall(r"[.!?](?:\s|$)", text)) / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        twice / n,
        sum(counts[w] for w in KNOWN) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        len(lines) / n,
    ]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, the measures of the text, and the metadata as numbers of fixed range."""

    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [measures(t) for t in texts]
            yield pd.DataFrame(rows, columns=MEASURES).astype("float64")

    schema = ", ".join(f"{m} double" for m in MEASURES)

    def bucket(column: str, n: int):
        return F.pmod(F.xxhash64(F.coalesce(column, F.lit(""))), F.lit(n)).cast("int")

    chars = F.greatest(F.coalesce(F.col("n_chars").cast("double"), F.lit(0.0)), F.lit(0.0))
    size = F.least(F.floor(F.log2(chars + 1)), F.lit(SIZES - 1)).cast("int")
    return docs.select(
        "doc_id",
        bucket("source", SOURCES).alias("source_bucket"),
        bucket("lang", LANGS).alias("lang_bucket"),
        size.alias("size_bucket"),
        F.pandas_udf(measure, schema)("text").alias("m"),
    ).select("doc_id", "source_bucket", "lang_bucket", "size_bucket", "m.*")


class TextView:
    """Measures cut into bins of equal cardinality, one indicator per bin."""

    def __init__(self, rows: pd.DataFrame):
        steps = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(rows[m], steps)) for m in MEASURES]

    def columns(self, rows: pd.DataFrame) -> np.ndarray:
        found = [np.searchsorted(e, rows[m].to_numpy()) for e, m in zip(self.edges, MEASURES)]
        return np.stack([f + i * BINS for i, f in enumerate(found)], axis=1)

    size = len(MEASURES) * BINS


class PageView:
    """Indicators of source, language and size as the metadata give them."""

    def columns(self, rows: pd.DataFrame) -> np.ndarray:
        return np.stack(
            [
                rows.source_bucket.to_numpy(),
                SOURCES + rows.lang_bucket.to_numpy(),
                SOURCES + LANGS + rows.size_bucket.to_numpy(),
            ],
            axis=1,
        )

    size = SOURCES + LANGS + SIZES


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Logistic:
    """Logistic regression on indicators, by full gradient steps with adaptive size."""

    def __init__(self, size: int):
        self.weights, self.bias = np.zeros(size), 0.0

    def fit(self, columns: np.ndarray, y: np.ndarray, rounds: int = 200) -> Logistic:
        squares, bias_square = np.full(len(self.weights), 1e-8), 1e-8
        self.bias = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        for _ in range(rounds):
            miss = sigmoid(self.logits(columns)) - y
            slope = np.bincount(columns.ravel(), np.repeat(miss, columns.shape[1]), len(squares))
            slope = (slope + 0.5 * self.weights) / len(y)
            squares += slope**2
            self.weights -= 0.3 * slope / np.sqrt(squares)
            bias_square += miss.mean() ** 2
            self.bias -= 0.1 * miss.mean() / math.sqrt(bias_square)
        return self

    def logits(self, columns: np.ndarray) -> np.ndarray:
        return self.weights[columns].sum(axis=1) + self.bias


def calibrate(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make logits fit outcomes, by Newton steps with a weak prior."""
    a, b = 1.0, 0.0
    for _ in range(25):
        p = sigmoid(a * logits + b)
        w = np.maximum(p * (1 - p), 1e-6)
        slope = np.array([((y - p) * logits).sum() - (a - 1), (y - p).sum() - 0.01 * b])
        bend = np.array(
            [
                [(w * logits**2).sum() + 1, (w * logits).sum()],
                [(w * logits).sum(), w.sum() + 0.01],
            ]
        )
        step = np.linalg.solve(bend, slope)
        a, b = a + np.clip(step[0], -1, 1), b + np.clip(step[1], -1, 1)
    return float(np.clip(a, 0.0, 5.0)), float(b)


class CoTrained:
    """Two views that label for each other, then are calibrated on labelled rows kept aside."""

    def __init__(
        self, labelled: pd.DataFrame, y: np.ndarray, pool: pd.DataFrame, rounds: int, share: float
    ):
        self.views = [TextView(pd.concat([labelled, pool])), PageView()]
        aside = np.array([xxhash.xxh32_intdigest(str(i)) % 5 == 0 for i in labelled.doc_id])
        if not 10 <= aside.sum() <= len(aside) - 10:
            aside = np.zeros(len(y), bool)
        columns = [v.columns(labelled[~aside]) for v in self.views]
        pools = [v.columns(pool) for v in self.views]
        # Pseudo-labels that each view was given by the other: row of the pool -> label.
        given: list[dict[int, float]] = [{}, {}]
        self.models = self._fit(columns, y[~aside], pools, given)
        good_share = y.mean()
        for _ in range(rounds):
            if not len(pool):
                break
            for view in (0, 1):
                p = sigmoid(self.models[view].logits(pools[view]))
                n = int(share * len(pool))
                surest = np.argsort(-p, kind="stable")[: int(n * good_share)]
                poorest = np.argsort(p, kind="stable")[: int(n * (1 - good_share))]
                given[1 - view].update({int(i): 1.0 for i in surest if p[i] > 0.9})
                given[1 - view].update({int(i): 0.0 for i in poorest if p[i] < 0.1})
            self.models = self._fit(columns, y[~aside], pools, given)
        check = aside if aside.any() else np.ones(len(y), bool)
        tests = [v.columns(labelled[check]) for v in self.views]
        self.scales = [
            calibrate(m.logits(t), y[check]) for m, t in zip(self.models, tests)
        ]
        self.prior = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))

    def _fit(self, columns, y, pools, given) -> list[Logistic]:
        models = []
        for view, own, pool, extra in zip(self.views, columns, pools, given):
            rows = np.array(sorted(extra), np.int64)
            x = np.concatenate([own, pool[rows]])
            models.append(
                Logistic(view.size).fit(x, np.concatenate([y, [extra[int(i)] for i in rows]]))
            )
        return models

    def scores(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Calibrated probabilities of each view, and of both: evidence beyond the prior adds."""
        logits = [
            a * m.logits(v.columns(rows)) + b
            for m, v, (a, b) in zip(self.models, self.views, self.scales)
        ]
        both = logits[0] + logits[1] - self.prior
        return pd.DataFrame(
            {
                "text_score": sigmoid(logits[0]),
                "page_score": sigmoid(logits[1]),
                "score": sigmoid(both),
            }
        )


def _least_hashes(rows: DataFrame, most: int) -> pd.DataFrame:
    """About ``most`` rows, or all if there are fewer: those whose hash falls in that share."""
    share = 1_000_000
    n = rows.count()
    if n > most:
        rows = rows.filter(F.pmod("h", F.lit(share)) < F.lit(share * most // n))
    return rows.orderBy("h").toPandas()


SCORES = "doc_id long, text_score double, page_score double, score double"


def classify(
    docs: DataFrame,
    labels: DataFrame,
    most_labelled: int = 10_000,
    most_pool: int = 10_000,
    rounds: int = 4,
    share: float = 0.1,
) -> DataFrame:
    """doc_id, score, kept, text_score and page_score of every row of ``docs`` (doc_id, text, lang,
    source, n_chars), learned from ``labels`` (doc_id, quality).

    One classifier sees measures of the whole text, the other source, language and size as recorded.
    Both start from at most ``most_labelled`` labelled rows; for some rounds each labels the rows of
    a pool of at most ``most_pool`` others that it is surest of, for the other one to learn from.
    Each is calibrated on a fifth of the labelled rows kept aside, and their evidence beyond the
    share of good documents adds up. Samples take the rows of least hash; all rows are scored.

    Null texts and metadata count as empty. A document labelled twice takes the mean label. Repeated
    rows, and rows without doc_id, are scored like others. Without labels of both kinds every score
    is a half. An empty table gives no rows. Further columns are not read.
    """
    rows = stored(measured(docs))
    known = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("quality"))
    )
    joined = rows.join(known, "doc_id", "left").withColumn("h", F.xxhash64("doc_id"))
    sample = _least_hashes(joined.filter("quality IS NOT NULL"), most_labelled)
    pool = _least_hashes(joined.filter("quality IS NULL"), most_pool)
    y = (sample.quality.to_numpy() >= 0.5).astype(float)
    load = None
    if 0 < y.sum() < len(y):
        load = shared(docs.sparkSession, CoTrained(sample, y, pool, rounds, share))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load() if load else None
        for batch in batches:
            if model is None:
                found = pd.DataFrame({c: 0.5 for c in ("text_score", "page_score", "score")}, batch.index)
            else:
                found = model.scores(batch)
            found.insert(0, "doc_id", batch.doc_id.astype("Int64"))
            yield found

    scored = rows.mapInPandas(score, SCORES)
    return scored.select(
        "doc_id", "score", (F.col("score") >= 0.5).alias("kept"), "text_score", "page_score"
    )
