"""Quality by positive-unlabelled learning.

Trusted positives (labelled good rows) stand against unlabelled text; labels
of bad rows are never used. The class prior of the unlabelled text comes from
the best-bin estimate: a first classifier of positives against unlabelled ranks
a held-out part of both, and the smallest ratio (unlabelled share / positive
share above a cut), with confidence bounds, is the prior. The final classifier
minimises the non-negative unbiased risk

    prior * R+(positives)  +  max(0, R-(unlabelled) - prior * R-(positives))

with the logistic loss, whose minimiser is the probability of a good text. The
model is additive: every feature is cut at quantiles into indicator columns.

Features are form statistics over the whole text (characters, words, lines,
repetition). They are computed where the rows lie, in one pass, and written
once; the fit takes at most ``positives`` and ``unlabelled`` rows of them, the
first by a hash of the id. Ids, labels, language and source are no inputs.

A null or empty text has all-zero statistics and a score like any other. Equal
rows are scored alike; labels that are null, or disagree for an id, are left
out. Without a trusted positive every score is 0.5. Other columns are left
alone; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import first_by_hash, materialise, prepare, table
from .registry import register
from .toxicity import held_out, one_label

MARKS = "|!?.,:;\"'()-#*/\\<>=_{}[]%&@~"
NAMES = ("log_chars", "log_words", "upper", "digit", "space", "mark", "non_ascii", "other_control", "word_length", "word_length_dev",
         "distinct_words", "top_word", "title_words", "shouted_words", "marked_words", "log_lines", "repeated_lines", "line_words",
         "ended_lines", "repeated_pairs", "sentence_words", "longest_word", *[f"mark_{i}" for i in range(len(MARKS))])


def statistics(text: str) -> list[float]:
    """The features of a whole text, in the order of NAMES."""
    n = len(text)
    if not n:
        return [0.0] * len(NAMES)
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), 255)
    hist = np.bincount(codes, minlength=256)
    words = text.split()
    nw = max(len(words), 1)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1, dtype=np.int64)
    counts = Counter(words)
    lines = [s for s in (x.strip() for x in text.split("\n")) if s]
    nl = max(len(lines), 1)
    pairs = set(zip(words, words[1:]))
    upper, marks = hist[65:91].sum(), [hist[ord(c)] for c in MARKS]
    ends = hist[ord(".")] + hist[ord("!")] + hist[ord("?")]
    return [math.log1p(n), math.log1p(len(words)), upper / n, hist[48:58].sum() / n, (hist[32] + hist[9:14].sum()) / n, sum(marks) / n,
            hist[128:].sum() / n, (hist[:9].sum() + hist[14:32].sum()) / n, sizes.mean(), sizes.std(), len(counts) / nw,
            max(counts.values(), default=0) / nw, sum(w[0].isupper() for w in words) / nw,
            sum(w.isupper() and len(w) > 1 for w in words) / nw, sum(not w[-1].isalnum() for w in words) / nw, math.log1p(len(lines)),
            1 - len(set(lines)) / nl if lines else 0.0, len(words) / nl, sum(s[-1] in ".!?" for s in lines) / nl,
            1 - len(pairs) / max(len(words) - 1, 1), len(words) / (ends + 1), float(sizes.max()), *[m / n for m in marks]]


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, stats (array of float in the order of NAMES)."""
    @F.pandas_udf("array<float>")
    def stats(texts: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(statistics(t), dtype=np.float32) for t in texts])

    return docs.select(F.col("`doc_id`").alias("doc_id"), stats(F.coalesce(F.col("`text`"), F.lit(""))).alias("stats"))


class Additive:
    """Quantile indicators of every feature, one weight each."""

    def __init__(self, sample: np.ndarray, bins: int = 12):
        self.cuts = [np.unique(np.quantile(sample[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(sample.shape[1])]
        self.at = np.cumsum([0] + [len(c) + 1 for c in self.cuts])
        self.w, self.bias = np.zeros(self.at[-1]), 0.0

    def columns(self, x: np.ndarray) -> np.ndarray:
        """Index of the indicator of every feature, (rows, features)."""
        return np.column_stack([self.at[j] + np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)])

    def margin(self, cols: np.ndarray) -> np.ndarray:
        return self.bias + self.w[cols].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.columns(x)), -30, 30)))

    def minimise(self, pos: np.ndarray, unl: np.ndarray, prior: float | None, steps: int = 400, rate: float = 0.05, ridge: float = 1e-4) -> None:
        """Adam on the non-negative risk (``prior``) or, without a prior, on the
        plain logistic risk of positives against unlabelled."""
        p_cols, u_cols, size = self.columns(pos), self.columns(unl), len(self.w)
        m, v = np.zeros(size + 1), np.zeros(size + 1)

        def pull(cols: np.ndarray, g: np.ndarray) -> np.ndarray:
            return np.append(np.bincount(cols.ravel(), np.repeat(g, cols.shape[1]), minlength=size), g.sum())

        for t in range(1, steps + 1):
            sp = 1 / (1 + np.exp(-np.clip(self.margin(p_cols), -30, 30)))
            su = 1 / (1 + np.exp(-np.clip(self.margin(u_cols), -30, 30)))
            if prior is None:
                grad = pull(p_cols, (sp - 1) / len(sp)) + pull(u_cols, su / len(su))
            else:
                # logistic loss of z: log(1 + e^-z) for good, log(1 + e^z) for bad
                bad_u, bad_p = -np.log(1 - su + 1e-12).mean(), -np.log(1 - sp + 1e-12).mean()
                rest = pull(u_cols, su / len(su)) - prior * pull(p_cols, sp / len(sp))
                # below zero the bad-class risk is overfitted: step back on it alone
                grad = prior * pull(p_cols, (sp - 1) / len(sp)) + rest if bad_u - prior * bad_p >= 0 else -rest
            grad[:-1] += ridge * self.w
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
            step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            self.w -= step[:-1]
            self.bias -= step[-1]


def best_bin_prior(pos_scores: np.ndarray, unl_scores: np.ndarray, delta: float = 0.1) -> float:
    """Smallest upper bound of (unlabelled share) / (positive share) above a cut."""
    cuts = np.unique(np.quantile(pos_scores, np.linspace(0, 0.99, 100)))
    slack = math.sqrt(math.log(4 / delta) / 2) * (1 / math.sqrt(len(pos_scores)) + 1 / math.sqrt(len(unl_scores)))
    best, at = math.inf, 1.0
    for c in cuts:
        p, u = (pos_scores >= c).mean(), (unl_scores >= c).mean()
        if p > 0 and (u + slack) / p < best:
            best, at = (u + slack) / p, u / p
    return float(min(max(at, 0.01), 0.99))


class QualityModel:
    """Fitted on statistics: ``prior`` and the final additive model."""

    def __init__(self, pos: np.ndarray, unl: np.ndarray):
        both = np.vstack([pos, unl])
        first = Additive(both)
        first.minimise(pos[::2], unl[::2], None)
        # scores of the halves the first classifier has not seen
        p, u = (first.margin(first.columns(x[1::2] if len(x) > 1 else x)) for x in (pos, unl))
        self.prior = best_bin_prior(p, u)
        self.model = Additive(both)
        self.model.bias = math.log(self.prior / (1 - self.prior))
        self.model.minimise(pos, unl, self.prior)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.model.probability(x)


def fit(measured: DataFrame, labels: DataFrame, positives: int = 20_000, unlabelled: int = 20_000) -> QualityModel | None:
    """Only rows outside the held-out fold are read, and of labels only who is good."""
    good = one_label(labels, "quality").where("label = 1").select("doc_id")
    train = measured.where(~held_out(F.col("doc_id"), 5, 0))
    key = [F.xxhash64("doc_id", "stats"), F.col("doc_id")]

    def sample(rows: DataFrame, n: int) -> np.ndarray:
        # about n rows leave the tasks, n reach the driver
        got = first_by_hash(rows, key[0], n).orderBy(*key).limit(n).select("stats").toPandas()["stats"]
        return np.vstack(got.to_list()).astype(float) if len(got) else np.zeros((0, len(NAMES)))

    # the unlabelled text is drawn from all training rows, labelled or not, without their labels
    pos, web = sample(train.join(good, "doc_id", "left_semi"), positives), sample(train, unlabelled)
    return QualityModel(pos, web) if len(pos) and len(web) else None


def score(measured: DataFrame, model: QualityModel | None) -> DataFrame:
    if model is None:
        return measured.select("doc_id", F.lit(0.5).alias("score"))
    told = measured.sparkSession.sparkContext.broadcast(model)  # quantiles and weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.vstack(pdf["stats"].to_list()).astype(float)
                yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": told.value.probability(x)})

    return measured.mapInPandas(run, "doc_id long, score double")


@register("op7_quality_pu")
def op7_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    prepare(spark)
    measured = materialise(measure(table(spark, sf_dir, "documents")))
    got = score(measured, fit(measured, table(spark, sf_dir, "labels")))
    return got.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))
