"""Personal data: base patterns plus spans proposed by high-recall generators
and selected by gradient-boosted trees with calibrated thresholds.

Everything on the path of a text is a column expression in one projection:
a pattern's matches get marks, the text is split at the marks, and a fold over
the parts turns them into (start, end, value, context). Generators are wider
patterns of the same kinds, so their spans overlap each other and the base
spans. The boosted trees are fitted by Spark's GBTClassifier on all labelled
candidates, those of equal features as one row with their number as its weight.
The labels are those the base rules give (a candidate that is a valid base span
is 1; one that overlaps a valid base span with other bounds, or breaks its
kind's rules, is 0; the rest are what there is to decide). The fitted trees are
written out as nested CASE expressions. A threshold per kind is the lowest score at which the held-out
labels reach the wanted precision; a kind that never does adds nothing.

A null or empty text has no spans (digest of the empty string). Equal rows and
ids are rows of their own; an empty table, or one without personal data, gives
base results only. Other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, prepare, table
from .registry import register

KINDS = ("email", "ip", "card", "phone")
#: Fixed by the contract, with atomic groups and look-behinds where a match can only begin at a run's start: the same
#: matches in linear time. Card runs below 13 characters can't pass and have no longer match inside, so they are skipped.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+"
              r"(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}+){1,4}+",),
    "ip": (r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}){3}(?![0-9])",),
    "card": (r"(?<![A-Za-z0-9])[0-9]{13,19}(?![A-Za-z0-9])",
             r"(?<![A-Za-z0-9])[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![A-Za-z0-9])"),
    "phone": (r"(?<![A-Za-z0-9])(?:\+[0-9]{1,3}[\x20.-]?)?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![A-Za-z0-9])",
              r"\+[0-9]{1,3}(?:[\x20.-]?\(?[0-9]{1,4}\)?){2,5}(?![A-Za-z0-9])"),
}
#: What a text must hold for a kind's patterns to be worth running.
HINT = {"email": r"@|at[)\]]|\x20at\x20", "ip": "[0-9][.\\[(]", "card": "[0-9]{4}|[0-9][\\x20-][0-9]", "phone": "[0-9]{4}|\\+[0-9]"}
CONTEXT = 16
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
SPAN = "struct<kind:string,base:boolean,start:long,end:long,value:string,before:string,after:string>"


def matches(text: Column, pattern: str, kind: str, base: bool) -> Column:
    """Leftmost non-overlapping matches of a pattern as an array of SPAN.
    ``text`` holds no \\x01 or \\x02 (see ``cleaned``)."""
    parts = F.split(F.regexp_replace(text, F.lit(pattern), F.lit("\x01$0\x02")), "[\x01\x02]", -1)

    def step(acc: Column, i: Column) -> Column:
        gap, value = F.get(acc["parts"], i * 2), F.get(acc["parts"], i * 2 + 1)
        start = acc["at"] + F.length(gap)
        end = start + F.length(value)
        span = F.struct(F.lit(kind).alias("kind"), F.lit(base).alias("base"), start.cast("long").alias("start"),
                        end.cast("long").alias("end"), value.alias("value"), F.right(gap, F.lit(CONTEXT)).alias("before"),
                        F.left(F.get(acc["parts"], i * 2 + 2), F.lit(CONTEXT)).alias("after"))
        return F.struct(end.cast("long").alias("at"), acc["parts"].alias("parts"), F.concat(acc["out"], F.array(span)).alias("out"))

    none = F.array().cast(f"array<{SPAN}>")
    begin = F.struct(F.lit(0).cast("long").alias("at"), parts.alias("parts"), none.alias("out"))
    count = F.call_function("div", F.size(parts) - 1, F.lit(2)).cast("int")
    # nullability of the fold's state must not change between steps
    found = F.reduce(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")), begin,
                     step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Luhn's check over up to 19 digits."""
    padded = F.lpad(number, 19, "0")
    doubled = F.translate(padded, "0123456789", "0246813579")
    total = sum((F.substring(padded if i % 2 == 0 else doubled, 19 - i, 1).cast("int") for i in range(19)), F.lit(0))
    return (total % 10) == 0


def valid(s: Column) -> Column:
    """Whether a span keeps its kind's rules."""
    number = digits(s["value"])
    n = F.length(number)
    return (F.when(s["kind"] == "email", F.lit(True))
            .when(s["kind"] == "ip", F.regexp_replace(s["value"], r"[\[\]()]", "").rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
            .when(s["kind"] == "card", n.between(13, 19) & luhn(number))
            .otherwise(n.between(9, 15)))


def features(s: Column) -> dict[str, Column]:
    """Format and context of a span; plain numbers only."""
    v, number = s["value"], digits(s["value"])
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    count = lambda c: c.cast("double")
    f = {f"is_{k}": flag(s["kind"] == k) for k in KINDS}
    f |= {"length": count(F.length(v)), "digits": count(F.length(number)), "valid": flag(valid(s)),
          "groups": count(F.size(F.split(v, "[^0-9]+"))), "separators": count(F.length(F.regexp_replace(v, "[A-Za-z0-9]", ""))),
          "letters": count(F.length(F.regexp_replace(v, "[^A-Za-z]", ""))), "plus": flag(F.substring(v, 1, 1) == "+"),
          "paren": flag(v.rlike(r"\(")), "paired": flag(F.length(F.regexp_replace(v, r"[^(]", "")) == F.length(F.regexp_replace(v, r"[^)]", ""))),
          "spaces": count(F.length(F.regexp_replace(v, "[^ ]", ""))), "us_shape": flag(v.rlike(r"^\+?[0-9]{0,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}$")),
          "mark_before": flag(s["before"].rlike(r"[^\s]$")), "mark_after": flag(s["after"].rlike(r"^[^\s.,;:)]")),
          "digit_before": flag(s["before"].rlike(r"[0-9][ ().-]*$")), "digit_after": flag(s["after"].rlike(r"^[ ().-]*[0-9]")),
          "cue": flag(s["before"].rlike(r"(?i)(mail|phone|tel|call|fax|card|visa|account|server|host|address|ip)\W*$"))}
    return f


def cleaned(text: Column) -> Column:
    """The text with null as empty and the two marks replaced one for one, so
    that places stay as they are (no pattern has either character)."""
    return F.translate(F.coalesce(text, F.lit("")), "\x01\x02", "\x03\x03")


def propose(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """doc_id, base (valid base spans), proposed (all other candidates of the
    generators and failed base matches, without repeats) per document."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), cleaned(F.col(f"`{text_col}`")).alias("__text"),
                       *[F.col(f"`{c}`") for c in keep or []])
    none = F.array().cast(f"array<{SPAN}>")
    t = F.col("__text")
    found = lambda kind, patterns, base: F.when(t.rlike(HINT[kind]), F.concat(*[
        matches(t, p, kind, base) for p in patterns])).otherwise(none)
    rows = rows.select("*", F.concat(*[found(k, (BASE[k],), True) for k in KINDS]).alias("__b"),
                       F.concat(*[found(k, GENERATORS[k], False) for k in KINDS]).alias("__g")).drop("__text")
    rows = rows.withColumn("base", F.filter("__b", valid))
    same = lambda a, b: (a["kind"] == b["kind"]) & (a["start"] == b["start"]) & (a["end"] == b["end"])
    other = F.filter(F.concat("__g", F.filter("__b", lambda s: ~valid(s))), lambda s: ~F.exists("base", lambda b: same(s, b)))
    return rows.withColumn("proposed", F.array_distinct(F.transform(other, lambda s: s.withField("base", F.lit(False))))).drop("__b", "__g")


def candidates(proposed: DataFrame) -> DataFrame:
    """One row per candidate with its label (null: to be decided) and features."""
    touched = lambda s: F.exists("base", lambda b: (b["kind"] == s["kind"]) & (b["start"] < s["end"]) & (s["start"] < b["end"]))
    wrong = F.transform("proposed", lambda s: F.struct(s.alias("s"), F.when(touched(s) | ~valid(s), F.lit(0.0)).alias("label")))
    right = F.transform("base", lambda s: F.struct(s.alias("s"), F.lit(1.0).alias("label")))
    rows = proposed.where((F.size("base") > 0) | (F.size("proposed") > 0)).select("doc_id", F.explode(F.concat(right, wrong)).alias("c"))
    return rows.select("doc_id", F.col("c.s").alias("s"), F.col("c.label").alias("label"))


def tree_column(node, names: list[str], f: Column) -> Column:
    """A fitted regression tree (a JVM node) as nested conditions over a struct."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(f[names[split.featureIndex()]] <= float(split.threshold()), tree_column(node.leftChild(), names, f)) \
        .otherwise(tree_column(node.rightChild(), names, f))


class Selector:
    """Fitted trees (margin = weighted sum) and a threshold per kind; a kind
    without one adds nothing."""

    def __init__(self, names: list[str], trees: list, weights: list[float], thresholds: dict[str, float]):
        self.names, self.trees, self.weights, self.thresholds = names, trees, weights, thresholds

    def score(self, f: Column) -> Column:
        """Probability from a struct of features: the logistic of twice the margin."""
        margin = sum((tree_column(t, self.names, f) * F.lit(float(w)) for t, w in zip(self.trees, self.weights)), F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(margin * -2.0))

    def selected(self, spans: Column, base: Column) -> Column:
        """Of an array of spans, those the trees select and no base span touches."""
        if not self.thresholds:
            return F.filter(spans, lambda s: F.lit(False))
        with_f = F.transform(spans, lambda s: F.struct(s.alias("s"), F.struct(*[c.alias(n) for n, c in features(s).items()]).alias("f")))

        def reaches(x: Column) -> Column:
            least = F.lit(2.0)
            for kind, t in self.thresholds.items():
                least = F.when(x["s"]["kind"] == kind, F.lit(t)).otherwise(least)
            free = ~F.exists(base, lambda b: (b["start"] < x["s"]["end"]) & (x["s"]["start"] < b["end"]))
            return (self.score(x["f"]) >= least) & free

        return F.transform(F.filter(with_f, reaches), lambda x: x["s"])


def labelled_features(proposed: DataFrame) -> DataFrame:
    """All labelled candidates as (held, label, kind, features, n): n of them are
    alike in everything a model sees. Every fourth, by hash, is held out."""
    labelled = candidates(proposed).where("label IS NOT NULL")
    held = F.pmod(F.xxhash64("doc_id", "s.kind", "s.start", "s.end", "s.value"), F.lit(4)) == 0
    keyed = labelled.select(held.alias("held"), "label", F.col("s.kind").alias("kind"), *[c.alias(n) for n, c in features(F.col("s")).items()])
    return keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).cast("double").alias("n"))


def fit(proposed: DataFrame, rounds: int = 12, depth: int = 4, precision: float = 0.95) -> Selector:
    """Boosted trees on all labelled candidates but every fourth; these are held
    out for the thresholds."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = materialise(labelled_features(proposed))
    names = [c for c in rows.columns if c not in ("held", "label", "kind", "n")]
    train = rows.where("NOT held")
    if {r["label"] for r in train.select("label").distinct().collect()} != {0.0, 1.0}:
        return Selector(names, [], [], {})
    model = GBTClassifier(maxIter=rounds, maxDepth=depth, seed=7, stepSize=0.3, weightCol="n").fit(
        VectorAssembler(inputCols=names, outputCol="features").transform(train).select("features", "label", "n"))
    selector = Selector(names, [t._call_java("rootNode") for t in model.trees], list(model.treeWeights), {})
    held = rows.where("held").select("kind", "label", "n", F.round(selector.score(F.struct(*names)), 2).alias("p"))
    at = held.groupBy("kind", "p").agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n")).collect()  # 4 x 101 rows
    for kind in KINDS:
        right = n = 0
        for r in sorted((r for r in at if r["kind"] == kind), key=lambda r: -r["p"]):
            right, n = right + r["right"], n + r["n"]
            if right >= precision * n and r["p"] >= 0.5:
                selector.thresholds[kind] = max(r["p"] - 0.005, 0.5)
    return selector


def listed(spans: Column) -> Column:
    """kind:start:end by kind as listed, then start; comma-joined."""
    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("a"),
                                                               s["end"].alias("b"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["b"].cast("string"))), ",")


def find_pii(docs: DataFrame, keep: list[str] | None = None, **how) -> DataFrame:
    """doc_id, base, added (arrays of spans) per document, and ``keep``."""
    proposed = materialise(propose(docs, keep=keep))
    selector = fit(proposed, **how)
    return proposed.withColumn("added", selector.selected(F.col("proposed"), F.col("base"))).drop("proposed")


def merged(spans: Column) -> Column:
    """Sorted spans with overlapping ones put together: struct<start, end, kind>."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] > s["start"]),
                      F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(acc, F.array(s)))

    return F.reduce(ordered, F.array().cast("array<struct<start:long,end:long,kind:string>>"), step)


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets."""
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    end = F.reduce(merged(spans), state, lambda acc, s: F.struct(s["end"].alias("at"), F.concat(
        acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out")),
        lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"))))
    return F.when(F.size(spans) > 0, end).otherwise(text)


def redact_documents(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with personal data replaced in the text (and n_chars, if there,
    brought up to date). The selector is fitted on a table of spans; the texts
    go through one projection that finds and replaces, without a shuffle."""
    selector = fit(materialise(propose(docs)), **how)
    # the row travels as one struct, so its columns clash with none of the names here
    row = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    both = propose(row, keep=["__row"])
    spans = F.concat("base", selector.selected(F.col("proposed"), F.col("base")))
    text = redacted(F.col("__row")["text"], spans)
    return both.select(*[(text if c == "text" else F.length(text).cast("long") if c == "n_chars" else F.col("__row")[c]).alias(c)
                         for c in docs.columns])


@register("op5_pii_boosted_spans")
def op5_pii_boosted_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    prepare(spark)
    found = find_pii(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[number(k).alias(f"n_{k}") for k in KINDS], F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        listed(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
