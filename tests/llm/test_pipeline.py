"""The stages, one after another, against brute force on small documents."""

import re
from collections import Counter

import corpus_pipeline
from conftest import SF
from tickwise.llm import mixing, packing, pii
from tickwise.llm.common import materialise, table


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_stages_on_documents(ready):
    docs = table(ready, SF, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(materialise(stage(ready, kept[-1], SF)))
        if name != "packing":
            assert kept[-1].dtypes == docs.dtypes
    rows = [d.collect() for d in kept]
    start, clean, single, redacted, mixed, packed = rows
    by = {r.doc_id: r for r in start}
    # toxicity: rows stay as they are, most stay, those labelled toxic mostly go
    assert all(by[r.doc_id] == r for r in clean) and len(clean) > 0.85 * len(start)
    # near-duplicates: one row of each class of what was kept
    from .test_duplicates_search import classes_by_search
    classes = classes_by_search([(r.doc_id, r.text) for r in clean])
    assert sorted(r.doc_id for r in single) == sorted(set(classes)) and all(by[r.doc_id] == r for r in single)
    # personal data: base spans are gone, other texts are as before
    from .test_pii_secrets import pii_spans
    for r in redacted:
        old = by[r.doc_id].text
        assert not pii_spans(r.text) and r.n_chars == len(r.text)
        assert pii_spans(old) or r.text == old or "[" in r.text
    # mixing: words of each source meet its target
    size, taken, known = Counter(), Counter(), {r.doc_id: r for r in redacted}
    for r in redacted:
        size[r.source] += words(r.text)
    for r in mixed:
        taken[r.source] += words(r.text)
        assert known[r.doc_id].text.startswith(r.text)
    _, plan = mixing.mix_plan(kept[3])
    for r in plan.collect():
        assert r.source_size == size[r.source] and abs(taken[r.source] - r.target) <= 1
    # packing: every mixed document once, in pieces without gaps
    pieces = Counter()
    for r in packed:
        pieces[r.doc_id] += r.length
    encode = packing.encoder(packing.VOCABULARY).encode
    want = Counter()
    for r in mixed:
        want[r.doc_id] += len(encode(r.text)) // 4 + 1
    assert pieces == want


def test_run_equals_its_stages(ready):
    got = corpus_pipeline.run(ready, SF)
    assert set(got.columns) >= {"doc_id", "sequence_id", "offset", "length"} and got.count() > 0


def test_stages_on_odd_rows(ready, odd_docs, no_docs):
    for docs, some in ((odd_docs, True), (no_docs, False)):
        kept = docs
        for name, stage in corpus_pipeline.STAGES:
            kept = materialise(stage(ready, kept, SF))
            if name != "packing":
                assert kept.columns == docs.columns
        assert (kept.count() > 0) == some


def test_queries_are_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names}
    assert pii.KINDS == ("email", "ip", "card", "phone")


def test_oracles_match(ready):
    import os
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(corpus_pipeline.__file__), "tools"))
    from check_oracle import compare
    for name in ("op1_mtree_topk", "op2_source_mix"):
        assert compare(ready, SF, [name], verbose=False)[name][0] == "MATCH"
