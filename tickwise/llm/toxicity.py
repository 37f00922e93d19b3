"""Toxicity by a weighted finite-state pattern grammar.

Small machines read the same stream of token classes: targets, negation,
reported speech, insults and threats. ``compose`` multiplies them into one
transducer whose transitions carry what an insult or threat is worth in that
state (more beside a target, less when negated or reported), so a matched
clause is scored, not a word. Clauses end at sentence marks; only clauses that
hold a trigger can score, so an Aho-Corasick pass over the whole text finds
these and the transducer reads just them.

The insult lexicon has a public seed list and learnt entries: words and stems
(word beginnings) whose document log-odds in labelled training rows are high,
picked greedily while each explains further toxic rows. Its weights are those
log-odds. A logistic curve over (total, strongest clause) turns grammar scores
into probabilities. The fit sees a bounded sample of labelled rows, the first
by hash (``positives`` and ``negatives``, parameters), weighted back to the
labels' own shares; ids, labels, language and source are no inputs of a score.

A null or empty text has no clause and gets the curve's floor. Equal rows are
scored alike; rows without a label are scored too; labels that are null, or
that disagree for an id, are left out. Without labels of both kinds the seed
lexicon and a default curve serve. The curve's floor is below 0.25, so a text
without a match is never marked. Other columns are left alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, prepare, table
from .registry import register

SEED_INSULTS = ("idiot moron stupid loser scum trash pathetic worthless disgusting clown fool jerk dumb imbecile "
                "degenerate filth vermin coward cretin dimwit").split()
TARGETS = set("you your yours youre he she they him her them his their we us everyone these those this that who".split())
NEGATIONS = set("not no never neither nor without isnt arent wasnt werent dont doesnt didnt cannot cant wont hardly".split())
REPORTS = set("said says say called calls wrote writes quoted reported claimed claims alleged according told".split())
MODALS = set("will gonna shall must should ll going".split())
THREATS = set("kill hurt destroy beat smash shoot burn attack punish".split())
TOKEN = re.compile(r"[^\W\d_]+|[\"“”«»]")
CLAUSE_END = re.compile(r"[.!?;\n]")
CLASSES = ("insult", "threat", "target", "negation", "report", "modal", "quote", "other")
STEMS = (4, 5, 6)


@dataclass
class Machine:
    """Transitions (state, class) -> state and factors (state, class) -> number;
    what is missing stays in place with factor 1."""
    start: object
    step: dict = field(default_factory=dict)
    factor: dict = field(default_factory=dict)


def within(openers: set[str], reach: int, factors: dict[str, float]) -> Machine:
    """Machine that for ``reach`` tokens after an opener applies ``factors``."""
    m = Machine(0)
    for n in range(reach + 1):
        for c in CLASSES:
            m.step[n, c] = reach if c in openers else max(n - 1, 0)
            if n and c in factors:
                m.factor[n, c] = factors[c]
    return m


def until_end(openers: set[str], factors: dict[str, float]) -> Machine:
    """Machine that applies ``factors`` from an opener to the clause's end."""
    m = Machine(0)
    for n in (0, 1):
        for c in CLASSES:
            m.step[n, c] = 1 if n or c in openers else 0
            if n and c in factors:
                m.factor[n, c] = factors[c]
    return m


def grammar() -> list[Machine]:
    return [within({"target"}, 5, {"insult": 1.5, "threat": 1.5}),
            within({"negation"}, 3, {"insult": 0.25, "threat": 0.25}),
            until_end({"report", "quote"}, {"insult": 0.6, "threat": 0.6}),
            within({"modal"}, 3, {"threat": 3.0})]


def compose(machines: list[Machine]) -> tuple[list[dict[str, tuple[int, float]]], int]:
    """Product transducer over the states reachable from the start:
    table[state][class] = (next state, factor)."""
    start = tuple(m.start for m in machines)
    number, todo, out = {start: 0}, [start], []
    for state in todo:
        row = {}
        for c in CLASSES:
            after = tuple(m.step.get((s, c), s) for m, s in zip(machines, state))
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row[c] = (number[after], math.prod(m.factor.get((s, c), 1.0) for m, s in zip(machines, state)))
        out.append(row)
    return out, 0


class Grammar:
    """The composed transducer with a lexicon: {word or stem + '*': weight}."""

    def __init__(self, lexicon: dict[str, float], curve: tuple[float, float, float]):
        self.table, self.start = compose(grammar())
        self.words = {w: v for w, v in lexicon.items() if not w.endswith("*")}
        self.stems = {w[:-1]: v for w, v in lexicon.items() if w.endswith("*")}
        self.curve = curve
        self.finder = None

    def __getstate__(self):
        return self.__dict__ | {"finder": None}

    def _find(self):
        import ahocorasick
        finder = ahocorasick.Automaton()
        for w in {*self.words, *self.stems, *THREATS}:
            finder.add_word(w, len(w))
        finder.make_automaton()
        self.finder = finder
        return finder

    def classify(self, token: str) -> tuple[str, float]:
        if token in self.words:
            return "insult", self.words[token]
        for n in STEMS:
            if token[:n] in self.stems and len(token) >= n:
                return "insult", self.stems[token[:n]]
        if token in THREATS:
            return "threat", 0.5
        if token in TARGETS:
            return "target", 0.0
        if token in NEGATIONS:
            return "negation", 0.0
        if token in REPORTS:
            return "report", 0.0
        if token in MODALS:
            return "modal", 0.0
        return ("other" if token[0].isalpha() else "quote"), 0.0

    def clause(self, text: str) -> float:
        at, total = self.start, 0.0
        for token in TOKEN.findall(text):
            c, weight = self.classify(token)
            at, factor = self.table[at][c]
            total += weight * factor
        return total

    def clauses(self, text: str) -> list[float]:
        """Scores of the clauses that hold a trigger at a word's beginning."""
        low = text.lower()
        out, done = [], 0
        for end, n in (self.finder or self._find()).iter(low):
            begin = end - n + 1
            if begin < done or (begin and (low[begin - 1].isalnum() or low[begin - 1] == "_")):
                continue
            left = max((low.rfind(c, done, begin) for c in ".!?;\n"), default=-1)
            close = CLAUSE_END.search(low, end)
            right = close.start() if close else len(low)
            got = self.clause(low[max(left + 1, done):right])
            done = right
            if got > 0:
                out.append(got)
        return out

    @staticmethod
    def inputs(clauses: list[float]) -> tuple[float, float]:
        return math.log1p(sum(clauses)), max(clauses, default=0.0)

    def score(self, text: str) -> float:
        a, b, c = self.curve
        x, y = self.inputs(self.clauses(text))
        z = max(-30.0, min(30.0, a + b * x + c * y))
        return 1.0 / (1.0 + math.exp(-z))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def one_label(labels: DataFrame, name: str) -> DataFrame:
    """doc_id, label: ids whose labels are null or disagree are left out."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(name).isin(0, 1)).groupBy("doc_id")
            .agg(F.min(name).alias("label"), F.max(name).alias("__most")).where("label = __most").drop("__most"))


def training_sample(docs: DataFrame, labels: DataFrame, positives: int, negatives: int) -> tuple[pd.DataFrame, dict[int, int]]:
    """(text, label) rows, at most ``positives`` and ``negatives`` of them, the
    first by a hash of the id, and how many labelled rows there are of each."""
    picks = materialise(one_label(labels, "toxic").where(~held_out(F.col("doc_id"), 4, 2)))
    counts = {r["label"]: r["count"] for r in picks.groupBy("label").count().collect()}
    ids = materialise(picks.where("label = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(positives).unionAll(
        picks.where("label = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(negatives)))
    # at most positives + negatives ids: a proven bound for the broadcast
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    return materialise(rows.dropDuplicates(["doc_id"])), counts


def words_of(text: str) -> set[str]:
    return {t for t in TOKEN.findall(text.lower()) if t[0].isalpha()}


def entries(words: set[str]) -> set[str]:
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


def learn_lexicon(sample: DataFrame, n_pos: int, n_neg: int, least: int = 4, most: int = 400) -> dict[str, float]:
    """Entries with high document log-odds, picked greedily. The counts are
    partial sums per task over the bounded sample; only entries that occur in
    ``least`` toxic rows and hardly elsewhere come to the driver."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = {0: Counter(), 1: Counter()}
        for pdf in batches:
            for text, label in zip(pdf["text"], pdf["label"]):
                seen[label].update(entries(words_of(text)))
        for label, counter in seen.items():
            yield pd.DataFrame({"entry": list(counter), "pos": [v * label for v in counter.values()],
                                "neg": [v * (1 - label) for v in counter.values()]})

    counts = sample.select("text", "label").mapInPandas(count, "entry string, pos long, neg long").groupBy("entry").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    floor = max(least, n_pos // 150)
    good = materialise(counts.withColumn("odds", odds).where((F.col("pos") >= floor) & (F.col("odds") >= 2.0))
                       .orderBy(F.desc("pos"), "entry").limit(most * 5))
    odds_of = {r["entry"]: min(r["odds"], 6.0) for r in good.collect()}

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"hits": [sorted(entries(words_of(t)) & odds_of.keys()) for t in pdf["text"]]})

    rows = [set(r["hits"]) for r in sample.where("label = 1").select("text").mapInPandas(hits, "hits array<string>").collect()]
    chosen: dict[str, float] = {w: odds_of[w] for w in SEED_INSULTS if w in odds_of}
    cover = Counter(e for r in rows for e in r)
    open_rows = rows
    while cover and len(chosen) < most:
        # of equal cover, the entry with the higher odds, then the longer one: a stem no shorter than needed
        entry = max(cover, key=lambda e: (cover[e], odds_of[e], len(e), e))
        if cover[entry] < floor:
            break
        chosen[entry] = odds_of[entry]
        open_rows = [r for r in open_rows if entry not in r]
        cover = Counter(e for r in open_rows for e in r)
    return chosen


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> tuple[float, float, float]:
    """Weighted ridge logistic regression by Newton steps."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    keep = np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = a.T @ (a * (weight * p * (1 - p) + 1e-9)[:, None]) + keep
        step = np.linalg.solve(h, a.T @ (weight * (y - p)) - keep @ w)
        w = w + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, positives: int = 3000, negatives: int = 6000) -> Grammar:
    seeds = {w: 3.0 for w in SEED_INSULTS}
    default = Grammar(seeds, (-3.0, 2.0, 0.3))
    sample, counts = training_sample(docs, labels, positives, negatives)
    got = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not got.get(0) or not got.get(1):
        return default
    lexicon = seeds | learn_lexicon(sample, got[1], got[0])
    plain = Grammar(lexicon, default.curve)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            xy = [plain.inputs(plain.clauses(t)) for t in pdf["text"]]
            yield pd.DataFrame({"x": [v[0] for v in xy], "y": [v[1] for v in xy], "label": pdf["label"]})

    rows = sample.select("text", "label").mapInPandas(measure, "x double, y double, label int").toPandas()
    share = rows["label"].map(lambda k: counts[k] / got[k]).to_numpy(float)
    curve = fit_curve(rows[["x", "y"]].to_numpy(float), rows["label"].to_numpy(float), share / share.mean())
    # a text in which nothing matches stays below 0.25, however common the label is
    return Grammar(lexicon, (min(curve[0], math.log(0.25 / 0.75)), max(curve[1], 0.0), max(curve[2], 0.0)))


def score(docs: DataFrame, model: Grammar, keep: list[str] | None = None) -> DataFrame:
    """doc_id, score per row (and ``keep`` columns)."""
    told = docs.sparkSession.sparkContext.broadcast(model)  # some hundred lexicon entries

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([told.value.score(t) for t in texts], dtype=float)

    text = F.coalesce(F.col("`text`"), F.lit(""))
    return docs.select("doc_id", scored(text).alias("score"), *[F.col(f"`{c}`") for c in keep or []])


def clean_documents(docs: DataFrame, labels: DataFrame, reject: float = 0.3, **how) -> DataFrame:
    """``docs`` without the rows that score ``reject`` or more."""
    model = fit(docs, labels, **how)
    row = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    return score(row, model, keep=["__row"]).where(F.col("score") < reject).select(
        *[F.col("__row")[c].alias(c) for c in docs.columns])


@register("op6_toxicity_grammar")
def op6_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    got = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return got.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))
