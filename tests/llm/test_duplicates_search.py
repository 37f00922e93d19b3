"""Near-duplicates, links and top-k against brute force."""

import pickle
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from tickwise.llm import embed_dedup, minhash, mtree
from tickwise.llm.common import table
from tickwise.llm.components import connected_components

SF1 = SF.replace("sf0.001", "sf0.1")


def roots(n, edges):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(ready, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(500, 580)] + [(600, 600 + i) for i in range(1, 90)]
    got = {r.node: r.component for r in connected_components(ready.createDataFrame(edges + edges[:5] + [(7, 7), (None, 3)], "a long, b long")).collect()}
    want = roots(700, edges)
    assert all(c == want[n] for n, c in got.items()) and {n for e in edges if e[0] != e[1] for n in e} == set(got)
    assert connected_components(ready.createDataFrame([], "a long, b long")).count() == 0


def words(text):
    import re
    return re.findall("[0-9a-z\u0080-\U0010ffff]+", text.lower())


def shingle_set(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def classes_by_search(rows):
    """Smallest id of each row's class, comparing all texts."""
    texts = sorted({t or "" for _, t in rows})
    sets = [shingle_set(t) for t in texts]
    edges = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    root = dict(zip(texts, roots(len(texts), edges)))
    by = defaultdict(list)
    for i, t in rows:
        by[root[t or ""]].append(i)
    return [min((x for x in by[root[t or ""]] if x is not None), default=None) for _, t in rows]


def test_shingles_are_those_of_the_words():
    texts = ["One two three four five six", "one  two, three. FOUR five!", "a b", "", "...", "é_ü x y z ß q", "x y z x y z x y z"]
    owner, h, count = minhash.shingles(texts)
    assert np.bincount(owner, minlength=len(texts)).tolist() == [len(shingle_set(t)) for t in texts]
    assert set(h[owner == 1]) < set(h[owner == 0]) and count[owner == 6].tolist().count(2) == 2


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(3)
    h = rng.integers(1, 2**63, 60).astype(np.uint64)
    wa, wb = rng.uniform(0.5, 4, 60), rng.uniform(0.5, 4, 60)
    wb[:20] = wa[:20]
    owner, hashes, weights = np.repeat([0, 1], 60), np.concatenate([h, h]), np.concatenate([wa, wb])
    sig = minhash.signatures(owner, hashes, weights, 2, 4096)
    jp = sum(1 / np.maximum(wa / wa[i], wb / wb[i]).sum() for i in range(60))
    assert (sig[0] == sig[1]).mean() == pytest.approx(jp, abs=0.04)


def near_copies(rng, n=40):
    base = [f"w{x}" for x in rng.integers(0, 5000, 120)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        w = list(out[rng.integers(len(out))].split())
        for _ in range(rng.integers(1, 5)):
            w[rng.integers(len(w))] = f"n{rng.integers(10**6)}"
        out.append(" ".join(w))
    return out


def test_classes_of_a_large_near_group(ready, monkeypatch):
    """A chain of edits: many texts of one bucket aren't linked to its pivots, so
    the open buckets are compared in blocks, here of very few nodes."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = np.random.default_rng(11)
    texts = near_copies(rng, 120) + near_copies(rng, 30) + [" ".join(f"z{x}" for x in rng.integers(0, 9999, 50)) for _ in range(60)]
    texts += texts[:25] + ["short text", "short text!", "Short  text"]
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]
    got = {r.doc_id: r for r in minhash.near_duplicates(ready.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = dict(zip([i for i, _ in rows], classes_by_search(rows)))
    assert {i: r.class_id for i, r in got.items()} == want
    assert all(r.kept == (i == r.class_id) for i, r in got.items())


def test_classes_of_copies_that_repeat_a_passage(ready):
    """One copy has a passage 40 times, the other once: sets that are almost
    equal, whatever the counts."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(40):
        w = [f"v{x}" for x in rng.integers(0, 10**6, 300)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:100] + w[100:160] * 40 + w[160:]))]
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(ready.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(80)} == dict(zip([i for i, _ in rows], classes_by_search(rows)))


def weighted_classes(rows):
    """As ``classes_by_search``, by the probability Jaccard similarity of shingles that weigh their words' bytes."""
    texts = sorted({t or "" for _, t in rows})
    sets = [{x: min(sum(len(w.encode()) for w in x), 255) for x in shingle_set(t)} for t in texts]

    def similarity(a, b):
        # sum over the common shingles of 1 / sum over all of max(x_j / x_i, y_j / y_i)
        return sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in {*a, *b}) for i in a.keys() & b.keys())

    edges = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and similarity(sets[i], sets[j]) >= 0.8 - 1e-12]
    root = dict(zip(texts, roots(len(texts), edges)))
    by = defaultdict(list)
    for i, t in rows:
        by[root[t or ""]].append(i)
    return [min(by[root[t or ""]]) for _, t in rows]


def test_weights_decide_links(ready):
    """Half the words are long: edits among the short ones change less than a
    count of shingles would say, edits among the long ones more."""
    rng = np.random.default_rng(8)
    rows = []
    for g in range(24):
        short, long = [f"s{x}" for x in rng.integers(0, 10**6, 30)], [f"{'long' * 6}{x}" for x in rng.integers(0, 10**6, 30)]
        edit = g // 2
        other = [(["t%d" % k for k in range(edit)] + short[edit:], long), (short, [f"{'gone' * 6}{k}" for k in range(edit)] + long[edit:])][g % 2]
        rows += [(2 * g, " ".join(short + long)), (2 * g + 1, " ".join(other[0] + other[1]))]
    want = weighted_classes(rows)
    assert want != classes_by_search(rows)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(ready.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i, _ in rows] == want


def test_classes_of_documents(ready):
    docs = table(ready, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r.class_id for r in minhash.op4_probminhash(ready, SF).collect()}
    assert got == dict(zip([i for i, _ in rows], classes_by_search(rows)))


def test_duplicates_of_odd_rows(odd_docs, no_docs):
    rows = minhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    ids = {(r.doc_id, r.class_id) for r in rows}
    assert (6, 6) in ids and (None, 6) in ids and (3, 2) in ids and (4, 2) in ids  # null and empty texts are one string
    kept = minhash.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    left = [r.doc_id for r in kept.collect()]
    assert sorted(left) == [1, 2, 5, 6, 7, 8, 9, 10]  # one of the repeated rows of 6
    assert minhash.deduplicated(no_docs).count() == 0


def links_by_search(rows, threshold=0.93):
    ok = [i for i, (_, v, lab) in enumerate(rows) if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    edges = []
    for x, i in enumerate(ok):
        for j in ok[:x]:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if rows[i][2] == rows[j][2] and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                edges.append((i, j))
    links = np.bincount([k for e in edges for k in e], minlength=len(rows)) if edges else np.zeros(len(rows), int)
    root = roots(len(rows), edges)
    low = defaultdict(list)
    for i, r in enumerate(root):
        low[r].append(rows[i][0])
    return [(rows[i][0], int(links[i]), min(low[root[i]])) for i in range(len(rows))]


def test_links_of_vectors(ready, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 32)  # so that the hot group is met in pairs of blocks
    rng = np.random.default_rng(8)
    base = rng.standard_normal((12, 32))
    v = [b + rng.standard_normal(32) * s for b in base[:4] for s in rng.uniform(0.05, 0.5, 20)]
    v += [base[5] + rng.standard_normal(32) * 0.02 for _ in range(130)] + [rng.standard_normal(32) for _ in range(60)] + [base[6]] * 6
    rows = [(i, [float(x) for x in u], int(i % 2 if i < 80 else 1)) for i, u in enumerate(v)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 32, 1), (n + 2, [float("nan")] * 32, 1), (n + 3, [None] * 32, 1), (n + 4, rows[0][1], None),
             (n + 5, [float("inf")] + [1.0] * 31, 1), (n + 6, [], 1)]
    df = ready.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit("x"))
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(df).collect()}
    for i, links, component in links_by_search(rows):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (links, component, i == component), i
    assert embed_dedup.near_duplicates(df.where("false")).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x = embed_dedup.units(rng.standard_normal((400, 64)))
    y = embed_dedup.units(x + rng.standard_normal((400, 64)) * 0.1)
    errors = []
    for seed in range(20):
        coder = embed_dedup.Coder(64, 8, 1)
        coder.turns[0] = np.linalg.qr(np.random.default_rng(seed).standard_normal((64, 64)))[0]
        code, f = coder.code(x)
        sign = (np.unpackbits(code, axis=1)[:, :64] * 2.0 - 1) / 8
        errors.append((sign * (y @ coder.turns[0])).sum(1) / f - (x * y).sum(1))
        assert (np.abs(errors[-1]) <= embed_dedup.SURE * np.sqrt((1 - f**2) / f**2) / np.sqrt(63)).all()
    assert abs(np.mean(errors)) < 0.005


def test_bands_reach_the_recall():
    import math
    for n in (10, 5_000, 10**6, 10**10):
        bits, bands = embed_dedup.bands_for(n)
        p = (1 - math.acos(0.93) / math.pi) ** bits
        assert (1 - p) ** bands <= 1.001e-4


def top_by_search(rows, every=50, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            good[i, tuple(np.floor(256 * np.array(v, float)).astype(int))] = None
    out = {}
    for i, v in good:
        if i % every == 0:
            scores = sorted((-int(np.dot(v, w)), j) for j, w in good if j != i)
            out[i] = [(j, -s) for s, j in scores[:k]]
    return out


def check_top(df, rows, **how):
    got = defaultdict(list)
    for r in mtree.top_k(df, **how).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert dict(got) == {i: v for i, v in top_by_search(rows, **how).items() if v}


def test_top_k_of_embeddings(ready):
    df = table(ready, SF1, "embeddings")
    check_top(df, [(r.vec_id, r.embedding) for r in df.collect()])


def test_top_k_with_many_trees_ties_and_odd_rows(ready, monkeypatch):
    monkeypatch.setattr(mtree, "TREE_ROWS", 60)
    monkeypatch.setattr(mtree, "PAGE", 8)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(6)
    v = [list(map(float, np.round(rng.standard_normal(6), 1))) for _ in range(300)] + [[0.5] * 6] * 200
    rows = [(i, x) for i, x in enumerate(v)] + [(1000, None), (1050, [None] * 6), (1100, [float("nan")] * 6), (None, [1.0] * 6), (1150, []), (0, v[0])]
    df = ready.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit("x"))
    check_top(df, rows, every=10)
    check_top(df.where("vec_id < 3"), [r for r in rows if r[0] is not None and r[0] < 3], every=1)
    assert mtree.top_k(df.where("false")).count() == 0


def test_trees_travel_once_for_many_queries(ready, monkeypatch):
    """A tree is read by its cell's queries and once per chunk of all queries, not once per cell that asks."""
    opened = ready.sparkContext.accumulator(0)

    def loads(blob):
        opened.add(1)
        return pickle.loads(blob)
    monkeypatch.setattr(mtree, "pickle", SimpleNamespace(loads=loads, dumps=pickle.dumps))
    monkeypatch.setattr(mtree, "TREE_ROWS", 20)
    rng = np.random.default_rng(12)
    rows = [(i, list(map(float, rng.standard_normal(8)))) for i in range(600)]
    df = ready.createDataFrame(rows, "vec_id long, embedding array<double>")
    check_top(df, rows, every=3)
    trees = 600 / 20 * 2  # cells aren't even
    assert 0 < opened.value <= 2 * trees
    monkeypatch.setattr(mtree, "GROUP_QUERIES", 64)
    check_top(df, rows, every=3)  # in several chunks


def test_tree_bounds_skip_pages():
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((20, 8)) * 400
    points = np.floor(np.vstack([c + rng.standard_normal((200, 8)) * 10 for c in centers]))
    longest = float((points * points).sum(1).max())
    tree = mtree.Tree(np.arange(len(points)), mtree.lift(points, longest))
    for i in (0, 777, 3999):
        q = points[i]
        got = sorted(tree.search(i, np.append(q, 0.0), 5, -np.inf, float(q @ q) + longest), key=lambda x: (-x[0], x[1]))
        scores = points @ q
        want = sorted(((int(s), j) for j, s in enumerate(scores) if j != i), key=lambda x: (-x[0], x[1]))[:5]
        assert got == want
    inner = [k for k in range(len(tree.lo)) if not tree.leaf[k]]
    for k in inner:  # covering radii cover, parent distances are right
        for e in range(tree.lo[k], tree.hi[k]):
            child = tree.child[e]
            pts = tree.point[tree.lo[child]:tree.hi[child]]
            d = np.linalg.norm(pts - tree.point[e], axis=1)
            assert (d <= tree.radius[e] + 1e-6).all() and np.allclose(d, tree.up[tree.lo[child]:tree.hi[child]])


def test_every_vector_length_takes_part(ready):
    """Vectors of two lengths: each is searched among its own."""
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.standard_normal(6 if i % 3 else 4)], 1) for i in range(60)]
    rows += [(60 + i, rows[i][1], 1) for i in range(6)]
    df = ready.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = {}
    for dim in (4, 6):
        want |= top_by_search([(i, v) for i, v, _ in rows if len(v) == dim], every=10)
    got = defaultdict(list)
    for r in mtree.top_k(df, every=10).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert {len(rows[i][1]) for i in got} == {4, 6} and dict(got) == want
    links = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(df).collect()}
    of = {}
    for dim in (4, 6):
        of |= {i: (n, c) for i, n, c in links_by_search([r for r in rows if len(r[1]) == dim])}
    assert links == of and links[60][0] >= 1 and links[61][0] >= 1
