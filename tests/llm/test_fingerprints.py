"""I-Match fingerprints: order, edits and digests by loop, likeness against the terms themselves."""

import hashlib
import re

from conftest import SF
from pyspark.sql import functions as F
from tickwise.llm import fingerprints as I
from tickwise.llm.common import table


def edits(docs):
    """[(doc_id, n_chars, sha256 of the edited text)] by the plain definition."""
    docs = sorted(((i, t or "") for i, t in docs), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, text) in enumerate(docs):
        cut = len(text) // 3
        after = docs[(k + 1) % len(docs)][1]
        out.append((i, len(text), hashlib.sha256((text[:len(text) - cut] + after[:cut]).encode()).hexdigest()))
    return out


def rows_of(df):
    return df.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()


def test_edits_follow_descending_ids_over_buckets(ready, monkeypatch):
    monkeypatch.setattr(I, "BUCKET", 7)
    docs = [(r.doc_id, r.text) for r in table(ready, SF, "documents").collect()]
    rows = rows_of(I.fingerprints(ready.createDataFrame(docs, "doc_id long, text string").repartition(3)))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == sorted(edits(docs))


def test_likeness_is_near_the_share_of_common_terms(ready):
    docs = table(ready, SF, "documents").select("doc_id", "text")
    rows = {r.doc_id: r for r in rows_of(I.fingerprints(docs, most=2, least=10**9))}
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.term for r in I.lexicon(docs, most=2, least=10**9).collect()}
    sets = {r.doc_id: set(r.t) & kept for r in docs.select("doc_id", I.terms("text").alias("t")).collect()}
    order = sorted(texts, reverse=True)
    errors, known = [], 0
    for i, k in zip(order, order[1:] + order[:1]):
        if len(sets[i] | sets[k]) and sets[i] and sets[k]:
            errors.append(abs(rows[i].near_next - len(sets[i] & sets[k]) / len(sets[i] | sets[k])))
            known += 1
    assert known > 100
    assert sum(errors) / known < 0.1


def test_edited_texts_are_nearer_than_next_ones(ready):
    docs = table(ready, SF.replace("0.001", "0.01"), "documents")
    rows = [r for r in rows_of(I.fingerprints(docs)) if r.n_chars >= 200]
    assert len(rows) > 500
    assert sum(r.near_edited > r.near_next for r in rows) > 0.97 * len(rows)
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))


def test_equal_texts_have_equal_fingerprints(ready):
    docs = [(i, t) for i, t in enumerate(["one two three four", "five six seven", "one two three four", "", None, "!!", "!!", "?"] * 3)]
    rows = {r.doc_id: r for r in rows_of(I.fingerprints(ready.createDataFrame(docs, "doc_id long, text string").repartition(4)))}
    by_text = {}
    for i, t in docs:
        by_text.setdefault(t or "", set()).add(rows[i].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert len({next(iter(v)) for v in by_text.values()}) == len(by_text)


def test_terms_are_distinct_lower_case_runs(ready):
    text = "The naïve CAFÉ, the café; 日本 x1 --"
    words = {w for w in re.split(r"[^\w]+", text.lower()) if w}
    df = ready.createDataFrame([(text,)], "text string")
    want = {r.h for r in ready.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w").alias("h")).collect()}
    assert set(df.select(I.terms("text").alias("t")).first().t) == want


def test_band_leaves_out_common_and_rare_terms(ready):
    docs = ready.createDataFrame([(i, f"common word{i % 4} rare{i}") for i in range(20)], "doc_id long, text string")
    kept = {r.term for r in I.lexicon(docs, most=2, least=10).collect()}
    want = {r.h for r in ready.createDataFrame([(f"word{i}",) for i in range(4)], "w string").select(F.xxhash64("w").alias("h")).collect()}
    assert kept == want


def test_shuffled_lexicon_gives_the_same(ready, monkeypatch):
    docs = table(ready, SF, "documents")
    want = sorted(map(tuple, rows_of(I.fingerprints(docs))))
    monkeypatch.setattr(I, "BROADCAST_TERMS", 0)
    assert sorted(map(tuple, rows_of(I.fingerprints(docs)))) == want


def test_odd_rows(odd_docs, no_docs):
    rows = rows_of(I.fingerprints(odd_docs))
    assert len(rows) == odd_docs.count()
    n = {r.doc_id: len(r.text or "") for r in odd_docs.select("doc_id", "text").collect()}
    assert all(r.n_chars == n[r.doc_id] for r in rows)
    single = [r for r in rows if r.doc_id in (1, 2, 3, 5, 8, 9)]
    assert len({r.fingerprint for r in single if not n[r.doc_id]}) == 1
    assert rows_of(I.fingerprints(no_docs)) == []
    one = rows_of(I.fingerprints(odd_docs.where("doc_id = 1")))
    assert len(one) == 1 and one[0].near_next == 1.0
