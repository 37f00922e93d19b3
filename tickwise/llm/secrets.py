"""Secret scans: base patterns plus formats learnt by grammar inference.

The base patterns find assignments, access keys and hex strings. Their values
are the labelled credentials: a bounded, hash-ordered sample of the distinct
ones (``per_kind``, a parameter) becomes one prefix tree per kind over character
classes, whose statistically compatible states are merged (state merging in
red-blue order with Hoeffding bounds, folding to keep the automaton
deterministic) into a probabilistic automaton. Long ordinary tokens give a
background automaton the same way. Every long token of every text outside the
base spans is then a candidate: its score is the log-likelihood ratio of the
best format against the background, per character; thresholds come from
credentials held out of the merging.

Texts are read once; credentials and candidates go to a table in the shared
checkpoint folder, of which both the fit and the scoring read.

A null or empty text has no spans (digest of the empty string). Equal rows and
ids are rows of their own. Without credentials there are no automata and only
base spans; an empty table gives no rows; other columns are left alone.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, prepare, table
from .registry import register

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
CLASSES = str.maketrans({c: k for k, group in {"a": "abcdef", "l": "ghijklmnopqrstuvwxyz", "A": "ABCDEF",
                                               "L": "GHIJKLMNOPQRSTUVWXYZ", "d": "0123456789"}.items() for c in group})
ALPHABET = "alALd+/_.=-"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) by start, then kind. ACCESS and HEX hold
    their length limits in the pattern: a run that is too short has no longer
    match inside it. A too short assignment is dropped after it was consumed."""
    out = [("assign", m.start(), m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6] \
        if ":" in text or "=" in text else []
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.group()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end(), m.group()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base: list[tuple[str, int, int, str]]) -> list[tuple[int, int, str]]:
    """Every long token that no base span touches: (start, end, token)."""
    out, k, reached = [], 0, 0  # base spans come by start; reached: the furthest end of those begun so far
    for m in TOKEN.finditer(text):
        while k < len(base) and base[k][1] < m.end():
            reached, k = max(reached, base[k][2]), k + 1
        if reached <= m.start():
            out.append((m.start(), m.end(), m.group()))
    return out


class Automaton:
    """Deterministic probabilistic automaton learnt by state merging."""

    def __init__(self, words: list[str], alpha: float = 0.05):
        # prefix tree: visits, ends and children by class symbol
        self.n, self.end, self.next, self.through = [0], [0], [{}], [{}]
        for word in words:
            at = 0
            self.n[0] += 1
            for c in word:
                self.through[at][c] = self.through[at].get(c, 0) + 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.n)
                    self.n.append(0)
                    self.end.append(0)
                    self.next.append({})
                    self.through.append({})
                at = self.next[at][c]
                self.n[at] += 1
            self.end[at] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge()

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        if not n1 or not n2:
            return False
        return abs(f1 / n1 - f2 / n2) > self.bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        """Whether two states and all that follows them look alike."""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            if self._differ(self.end[x], self.n[x], self.end[y], self.n[y]):
                return False
            for c in {*self.through[x], *self.through[y]}:
                if self._differ(self.through[x].get(c, 0), self.n[x], self.through[y].get(c, 0), self.n[y]):
                    return False
                if c in self.next[x] and c in self.next[y] and self.next[x][c] != self.next[y][c]:
                    todo.append((self.next[x][c], self.next[y][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add tree state b and what hangs below it to state a."""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            self.n[x] += self.n[y]
            self.end[x] += self.end[y]
            for c, v in self.through[y].items():
                self.through[x][c] = self.through[x].get(c, 0) + v
            for c, z in self.next[y].items():
                if c in self.next[x]:
                    todo.append((self.next[x][c], z))
                else:
                    self.next[x][c] = z

    def _merge(self) -> None:
        red, blue = [0], deque((0, c) for c in sorted(self.next[0]))
        while blue:
            parent, c = blue.popleft()
            state = self.next[parent][c]
            if state in red:
                continue
            for r in red:
                if self._compatible(r, state):
                    self.next[parent][c] = r
                    self._fold(r, state)
                    # folding may hang new tree states below red ones
                    blue = deque((q, k) for q in red for k in sorted(self.next[q]) if self.next[q][k] not in red)
                    break
            else:
                red.append(state)
                blue.extend((state, k) for k in sorted(self.next[state]))
        self.states = len(red)
        size = len(ALPHABET) + 1
        self.table = {q: ({c: (math.log((self.through[q].get(c, 0) + 0.1) / (self.n[q] + 0.1 * size)),
                               self.next[q].get(c, 0)) for c in ALPHABET},
                          math.log((self.end[q] + 0.1) / (self.n[q] + 0.1 * size))) for q in red}

    def log_likelihood(self, classes: str) -> float:
        at, total = 0, 0.0
        for c in classes:
            p, at = self.table[at][0][c]
            total += p
        return total + self.table[at][1]


class Formats:
    """The automata of all kinds, the background and the thresholds."""

    def __init__(self, credentials: dict[str, list[str]], background: list[str]):
        part = lambda ws, held: [w.translate(CLASSES) for i, w in enumerate(ws) if (i % 5 == 0) == held]
        self.background = Automaton(part(background, False)) if background else None
        self.kinds: dict[str, tuple[Automaton, float]] = {}
        for kind, words in credentials.items():
            if len(words) < 20 or self.background is None:
                continue
            automaton = Automaton(part(words, False))
            held = sorted((automaton.log_likelihood(w) - self.background.log_likelihood(w)) / len(w) for w in part(words, True))
            self.kinds[kind] = (automaton, max(held[len(held) // 50], 0.1))

    def score(self, classes: str) -> float:
        """Best log-likelihood ratio per character, over its kind's threshold;
        1 or more is a finding. A total below 10 nats never is."""
        if not self.kinds:
            return 0.0
        ground, best = self.background.log_likelihood(classes), 0.0
        for automaton, least in self.kinds.values():
            ratio = automaton.log_likelihood(classes) - ground
            if ratio >= 10:
                best = max(best, ratio / len(classes) / least)
        return best


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kinds / starts / ends / values of the base spans, and the
    candidates (c_starts, c_ends, c_values): the one pass over the texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            base = [base_spans(t) for t in pdf["text"]]
            cands = [candidates(t, b) for t, b in zip(pdf["text"], base)]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"),
                                **{name: [[s[i] for s in b] for b in base] for i, name in enumerate(("kinds", "starts", "ends", "values"))},
                                **{name: [[s[i] for s in c] for c in cands] for i, name in enumerate(("c_starts", "c_ends", "c_values"))}})

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, kinds array<string>, starts array<long>, ends array<long>, values array<string>, "
                                 "c_starts array<long>, c_ends array<long>, c_values array<string>")


def fit(scanned: DataFrame, per_kind: int = 2000, background: int = 4000) -> Formats:
    """Automata from at most ``per_kind`` distinct credentials of each kind and
    ``background`` distinct candidates, the first by hash (so a rerun takes the
    same). These bounds hold whatever the corpus; values over 400 characters
    are scored but not learnt from."""
    def sample(rows: DataFrame, n: int) -> list[str]:
        rows = rows.where(F.length("value") <= 400).distinct()
        return [r["value"] for r in rows.orderBy(F.xxhash64("value"), "value").limit(n).collect()]

    spans = scanned.select(F.explode(F.arrays_zip("kinds", "values")).alias("s")).select("s.kinds", F.col("s.values").alias("value"))
    return Formats({k: sample(spans.where(F.col("kinds") == k).select("value"), per_kind) for k in KINDS},
                   sample(scanned.select(F.explode("c_values").alias("value")), background))


def score(scanned: DataFrame, formats: Formats) -> DataFrame:
    """Counts and digest of the base spans, and all spans, per document."""
    told = scanned.sparkSession.sparkContext.broadcast(formats)  # automata over bounded samples

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, known = told.value, {}

        def found(value: str) -> bool:
            classes = value.translate(CLASSES)
            if classes not in known:
                if len(known) > 200_000:
                    known.clear()
                known[classes] = model.score(classes) >= 1
            return known[classes]

        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                base = [(s, KINDS.index(k), k, e) for k, s, e in zip(r.kinds, r.starts, r.ends)]
                more = [(s, len(KINDS), "inferred", e) for s, e, v in zip(r.c_starts, r.c_ends, r.c_values) if found(v)]
                text = lambda spans: ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans))
                n = [sum(k == kind for _, _, k, _ in base) for kind in KINDS]
                rows.append((r.doc_id, *n, hashlib.sha256(text(base).encode()).hexdigest(), text(base + more), len(more)))
            got = pd.DataFrame(rows, columns=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_inferred"])
            yield got.astype({"doc_id": "Int64"})

    return scanned.drop("values").mapInPandas(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                                                   "spans string, n_inferred long")


def find_secrets(docs: DataFrame, **how) -> DataFrame:
    scanned = materialise(scan(docs, **how))
    return score(scanned, fit(scanned))


@register("op9_secret_grammar")
def op9_secret_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    prepare(spark)
    return find_secrets(table(spark, sf_dir, "documents"))
