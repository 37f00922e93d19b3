"""Token alignment against a loop over documents, groups and pairs."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF
from tickwise.llm import alignment as A
from tickwise.llm.common import table


def tools():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path(A.VOCABULARY_A))
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=P.path(A.VOCABULARY_B))


def upto(tokens, end):
    for i, e in tokens:
        yield i
        if e == end:
            return


def cut(text, t, sp, letters):
    """Groups as ([A ids], [B ids])."""
    if not text:
        return []
    a = t.encode(" " + text, add_special_tokens=False).ids
    b = sp.encode(text)
    as_a = [bytes(letters[c] for c in t.id_to_token(i)) for i in a]
    as_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not b"".join(as_a) == b"".join(as_b) == (" " + text).encode():
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in as_a]).tolist(), np.cumsum([len(x) for x in as_b]).tolist()
    groups, xs, ys = [], iter(zip(a, ends_a)), iter(zip(b, ends_b))
    for end in sorted(set(ends_a) & set(ends_b)):
        groups.append((list(upto(xs, end)), list(upto(ys, end))))
    return groups


def by_loop(docs):
    t, sp = tools()
    letters = A.byte_letters()
    cuts = [cut(text, t, sp, letters) for _, text in docs]
    count = defaultdict(int)
    for groups in cuts:
        for pair in {(x, y) for xs, ys in groups for x in xs for y in ys}:
            count[pair] += 1
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, _), groups in zip(docs, cuts):
        links = [(x, y) for xs, ys in groups for x in xs for y in ys]
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        out.append((doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out, dict(count)


def got(df):
    key = lambda r: (r[0] is None, r)
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()),
                  key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)), key


def same(df, docs):
    order = lambda rows: sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r))
    want, count = by_loop(docs)
    assert got(A.align(df))[0] == order(want)
    return count


TEXTS = ["hello  world\n\n a", "  lead", "<s> x </s> <unk> <0x41> <|endoftext|>", "▁x", "", None, "a b　c", "é́ﬁ", "\tx ", "日本語 😀😀", "hello world",
         "hello world", "The unbelievableness of antidisestablishmentarianism", "x" * 3000, "日" * 300 + "本" * 300, "\x00\x01 a", "don't DON'T", " "]


@pytest.mark.parametrize("share,chunk", [(1e-3, 1 << 23), (0.3, 1)])
def test_every_figure_equals_a_loop(ready, monkeypatch, share, chunk):
    monkeypatch.setattr(A, "SHARE", share)
    monkeypatch.setattr(A, "CHUNK", chunk)
    docs = list(enumerate(TEXTS)) + [(None, "hello world"), (3, "hello world")]
    same(ready.createDataFrame(docs, "doc_id long, text string").repartition(3), docs)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n'’ab.,1▁éß")), max_size=30), min_size=1, max_size=4))
def test_units_give_the_tokens_of_the_whole_text(texts):
    t, sp = _TOOLS or _TOOLS.extend(tools()) or _TOOLS
    known = A.aligner(A.VOCABULARY_A, A.VOCABULARY_B)
    letters = A.byte_letters()
    for text, got in zip(texts, known.align(texts)):
        groups = cut(text, t, sp, letters)
        digest = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        assert got[4] == (hashlib.sha256(digest.encode()).hexdigest() if groups else "")
        assert got[:4] == (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(len(x) * len(y) for x, y in groups))


_TOOLS = []


def test_large_groups_are_counted_by_distinct_ids(ready, monkeypatch):
    monkeypatch.setattr(A, "LISTED", 1)
    tool = A.aligner(A.VOCABULARY_A, A.VOCABULARY_B)
    rng = np.random.default_rng(5)
    for _ in range(20):
        of_a, of_b = np.sort(rng.integers(0, 4, 30)), np.sort(rng.integers(0, 4, 25))
        of_a[:4], of_b[:4] = range(4), range(4)
        of_a.sort(), of_b.sort()
        a, b = rng.integers(0, 9, 30), rng.integers(300, 306, 25)
        n_a, n_b = np.bincount(of_a, minlength=4), np.bincount(of_b, minlength=4)
        _, keys, links = tool.pairs(a, b, of_a, of_b, n_a, n_b)
        want = defaultdict(int)
        for i, g in zip(a, of_a):
            for j, h in zip(b, of_b):
                want[i, j] += g == h
        want = {k: v for k, v in want.items() if v}
        have = dict(zip(*(x.tolist() for x in A.summed(keys, links))))
        assert have == {int(i) << 32 | int(j): n for (i, j), n in want.items()}


def test_documents_of_the_small_table(ready):
    rows = [(r.doc_id, r.text) for r in table(ready, SF, "documents").limit(60).collect()]
    df = ready.createDataFrame(rows, "doc_id long, text string")
    count = same(df, rows)
    assert {(r.a, r.b): r.docs for r in A.link_table(df).collect()} == count


def test_identity_array_names_equal_bytes(ready):
    tool = A.aligner(A.VOCABULARY_A, A.VOCABULARY_B)
    known = np.flatnonzero(tool.same >= 0)
    assert len(known) > 10_000
    assert all(tool.bytes_a[i] == tool.bytes_b[tool.same[i]] for i in known)
    assert len(set(tool.same[known].tolist())) == len(known)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    same(odd_docs, rows)
    assert got(A.align(no_docs))[0] == []
