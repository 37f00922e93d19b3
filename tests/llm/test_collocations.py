"""Collocations against counting phrase by phrase, and the graph against its texts."""

import re
from collections import Counter

import pytest

from conftest import SF
from tickwise.llm import collocations as C
from tickwise.llm.common import table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def pieces_of(text):
    text = (text or "").translate(str.maketrans(UPPER, UPPER.lower()))
    for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
        words = [w for w in re.split("[ \t]", piece) if w]
        if words:
            yield words


def by_counting(docs, least, top, cover):
    """{(lang, rank): row} by the plain definition."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for w in pieces_of(text):
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    longer = {}
    for (lang, q), b in found.items():
        for size in range(2, len(q)):
            for i in range(len(q) - size + 1):
                longer[lang, q[i:i + size]] = max(longer.get((lang, q[i:i + size]), 0), b)
    rows = {}
    for (lang, p), a in found.items():
        if 100 * longer.get((lang, p), -1) >= cover * a:
            continue
        cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
            for lang, found in rows.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts_of(df):
    return [(r.lang, r.text) for r in df.select("lang", "text").collect()]


@pytest.mark.parametrize("least,top,cover", [(2, 50, 50), (1, 10_000, 50), (3, 5, 80)])
def test_phrases_equal_counting_them(ready, least, top, cover):
    rows = [("en", "the red Fox. the red fox, a red fox; the RED fox ran\nthe red fox"), ("en", "a b a b a b a b"), (None, "x y z x y z x y"), ("und", "x y z"),
            ("en", ""), ("en", None), ("de", " \t .,; "), ("fr", "ÄB äb Äb c  äb"), ("en", "tab\there tab\there tab  here"), ("a b", "x y x y")]
    df = ready.createDataFrame(rows * 2, "lang string, text string").repartition(3)
    assert got(C.collocations(df, least, top, cover)) == sorted(by_counting(rows * 2, least, top, cover))


def test_small_table_equals_counting(ready):
    docs = table(ready, SF, "documents").limit(40)
    rows = texts_of(docs)
    df = ready.createDataFrame(rows, "lang string, text string")
    assert got(C.collocations(df, 4, 300)) == sorted(by_counting(rows, 4, 300, 50))


def test_blocks_and_slices_don_t_change_the_result(ready, monkeypatch):
    docs = ready.createDataFrame(texts_of(table(ready, SF, "documents").limit(60)), "lang string, text string")
    want = got(C.collocations(docs, 3, 100))
    monkeypatch.setattr(C, "BLOCK", 500)
    monkeypatch.setattr(C, "BUCKET", 5000)
    monkeypatch.setattr(C, "SHARE", 20)
    assert got(C.collocations(docs.repartition(7), 3, 100)) == want


def test_paths_are_phrases_that_always_occur_whole(ready):
    rows = [("en", "p q we hold these truths to be r s")] * 3 + [("en", "u we hold these truths to be")] * 2 + [("en", "hold on")]
    graph = C.phrase_graph(ready.createDataFrame(rows, "lang string, text string").repartition(2), 2)
    found = {(r.phrase, r.n) for r in C.paths(graph).collect()}
    assert ("we hold these truths to be", 5) in found and ("p q we hold", 3) in found and ("to be r s", 3) in found
    text = " . ".join(t for _, t in rows)
    for phrase, n in found:
        assert len(re.findall(f"(?={re.escape(phrase)})", text)) == n


def test_unary_edges_take_their_counts_from_the_path(ready):
    docs = ready.createDataFrame(texts_of(table(ready, SF, "documents").limit(60)), "lang string, text string")
    graph = C.phrase_graph(docs, 3)
    edges = C.path_edges(graph)
    flow = graph.selectExpr("lang", "gram as suffix", "n as g")
    linked = edges.where("linked").join(flow, ["lang", "suffix"])
    assert linked.count() == edges.where("linked").count() > 0
    assert linked.where("n <> g").count() == 0


def test_odd_rows(odd_docs, no_docs):
    assert got(C.collocations(odd_docs, 2, 1000)) == sorted(by_counting(texts_of(odd_docs), 2, 1000, 50))
    assert got(C.collocations(no_docs)) == []


def test_products_pass_64_bits(ready):
    df = ready.createDataFrame([(10**11, 10**11 + 7, 10**12, 7 * 10**11)], "a long, x long, l long, r long")
    a, left, right = 10**11, 10**12, 7 * 10**11
    assert df.select(C.score("a", "l", "r").alias("s")).first().s == 1000000 * a * a // (left * right)
