"""Grammar and quality model: rules, and accuracy on rows held out."""

import numpy as np
import pandas as pd
import pytest

from conftest import SF
from tickwise.llm import quality, toxicity
from tickwise.llm.common import table

SF1 = SF.replace("sf0.001", "sf0.1")


def auc(y, s):
    rank = pd.Series(s).rank().to_numpy()
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def held(rows, labels, name):
    m = rows.merge(labels, on="doc_id")
    return m[m.held_out], name


@pytest.fixture(scope="module")
def grammar():
    return toxicity.Grammar({w: 4.0 for w in toxicity.SEED_INSULTS} | {"zork*": 4.0}, (-4.0, 2.0, 0.3))


def test_clauses_are_scored_in_context(grammar):
    total = lambda t: sum(grammar.clauses(t))
    assert total("You are an idiot.") > total("An idiot came by.") > total("An idiot it is not, a fool") / 2
    assert total("he is not an idiot") < total("he is an idiot")
    assert total('she said "idiot"') < total("idiot")
    assert total("I will kill you") > total("the kill of it") > 0
    assert total("zorkling") == total("zorka") == 4.0 and total("azork") == 0
    assert total("idiotic") == 0 and total("") == 0 and total("nothing. here; at all") == 0
    # a clause is scored once, and the next clause starts afresh
    assert grammar.clauses("not idiot. idiot") == [1.0, 4.0]
    assert len(grammar.clauses("idiot moron stupid")) == 1


def test_skipping_clean_clauses_changes_nothing(grammar):
    import re
    text = "You said he is no fool; idiot! Zorked, they will beat us\nnot a moron? fine. CLOWN " * 30
    whole = [s for s in (grammar.clause(c) for c in re.split(r"[.!?;\n]", text.lower())) if s > 0]
    assert grammar.clauses(text) == pytest.approx(whole)


def test_composition_multiplies_factors():
    table_, start = toxicity.compose(toxicity.grammar())
    at, factor = start, None
    for c in ("target", "negation", "insult"):
        at, factor = table_[at][c]
    assert factor == pytest.approx(1.5 * 0.25)


def test_toxicity_held_out(ready):
    rows = toxicity.op6_toxicity_grammar(ready, SF1).toPandas()
    labels = table(ready, SF1, "labels").toPandas()
    import zlib
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(rows.doc_id[:500], rows.held_out[:500]))
    h, _ = held(rows, labels, "toxic")
    assert auc(h.toxic.to_numpy(), h.score) > 0.93
    assert (h.predicted == h.toxic).mean() > 0.97 and ((rows.score >= 0.3) == (rows.predicted == 1)).all()


def test_quality_held_out(ready):
    rows = quality.op7_quality_pu(ready, SF1).toPandas()
    h, _ = held(rows, table(ready, SF1, "labels").toPandas(), "quality")
    assert auc(h.quality.to_numpy(), h.score) > 0.98 and (h.predicted == h.quality).mean() > 0.95


def test_held_out_labels_change_no_score(ready):
    docs, labels = table(ready, SF, "documents"), table(ready, SF, "labels")
    from pyspark.sql import functions as F
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id"), 4, 2), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.score(docs, toxicity.fit(docs, x)).orderBy("doc_id").collect() for x in (labels, turned))
    assert a == b


def test_prior_and_risk():
    rng = np.random.default_rng(5)
    good, bad = rng.normal(2, 1, (3000, 2)), rng.normal(-2, 1, (3000, 2))
    web = np.vstack([good[1000:2400], bad[:600]])
    model = quality.QualityModel(good[:1000], web)
    assert abs(model.prior - 0.7) < 0.07
    new_good, new_bad = rng.normal(2, 1, (500, 2)), rng.normal(-2, 1, (500, 2))
    assert (model.probability(new_good) >= 0.5).mean() > 0.95 and (model.probability(new_bad) < 0.5).mean() > 0.9


def test_statistics_of_odd_texts():
    for t in ("", " ", "\n\n", "a", "x" * 100_000, "日本\ud800", "A!! B!!\nA!! B!!"):
        s = quality.statistics(t)
        assert len(s) == len(quality.NAMES) and np.isfinite(s).all()
    shout = dict(zip(quality.NAMES, quality.statistics("ABC!! DEF!!\nABC!! DEF!!")))
    assert shout["shouted_words"] == 1 and shout["repeated_lines"] == 0.5


def test_odd_rows(odd_docs, no_docs, labels, ready):
    none = labels.where("false")
    for lab in (labels, none):
        got = toxicity.score(odd_docs, toxicity.fit(odd_docs, lab))
        assert got.count() == odd_docs.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
        measured = quality.measure(odd_docs)
        got = quality.score(measured, quality.fit(measured, lab))
        assert got.count() == odd_docs.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxicity.score(no_docs, toxicity.fit(no_docs, labels)).count() == 0
    assert quality.score(quality.measure(no_docs), quality.fit(quality.measure(no_docs), labels)).count() == 0
    kept = toxicity.clean_documents(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_first_by_hash_holds_the_first_rows(ready):
    from pyspark.sql import functions as F
    from tickwise.llm.common import first_by_hash
    rows = ready.range(20_000).select("id", F.xxhash64("id").alias("h"))
    want = [r.id for r in rows.orderBy("h").limit(500).collect()]
    part = first_by_hash(rows, F.col("h"), 500)
    assert [r.id for r in part.orderBy("h").limit(500).collect()] == want and part.count() < 1000
    # a third of all rows share one key above the threshold: nothing is lost
    same = rows.withColumn("h", F.when(F.col("id") % 3 > 0, (1 << 62)).otherwise(F.col("h")))
    assert first_by_hash(same, F.col("h"), 9000).count() >= 9000
