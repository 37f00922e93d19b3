"""Tokens against the tokenizer, packing against its rules and a search."""

import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF
from tickwise.llm import packing
from tickwise.llm.common import table


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    t.encode_special_tokens = True
    return t


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), st.sampled_from(" \t\n'’—日😀 ")), max_size=60))
def test_both_forms_of_the_vocabulary_agree(text):
    want = np.asarray(tokenizer_once().encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert packing.encoder(packing.VOCABULARY).encode(text) == want


_TOKENIZER = []


def tokenizer_once():
    if not _TOKENIZER:
        _TOKENIZER.append(tokenizer())
    return _TOKENIZER[0]


def pieces_by_loop(docs, capacity):
    t, out = tokenizer_once(), []
    for i, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        at, end, k = 0, (len(ids) - 1) % capacity + 1, 0
        while at < len(ids):
            out.append((i, k, at, end - at, zlib.crc32(np.asarray(ids[at:end], dtype="<u4").tobytes())))
            at, end, k = end, end + capacity, k + 1
    return Counter(out)


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packed_documents(ready):
    rows = packing.op10_min_bin_slack(ready, SF).collect()
    docs = [(r.doc_id, r.text) for r in table(ready, SF, "documents").collect()]
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == pieces_by_loop(docs, 2048)
    n, total = check_packing(rows, 2048), sum(r.length for r in rows)
    assert n <= total / 2048 * 1.02 + 1


def test_odd_rows(odd_docs, no_docs):
    rows = packing.pack(packing.tokenize(odd_docs, 64), 64).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == pieces_by_loop(
        [(r.doc_id, r.text) for r in odd_docs.collect()], 64)
    check_packing(rows, 64)
    assert packing.pack(packing.tokenize(no_docs)).count() == 0


def test_sequences_hold_the_ids(odd_docs):
    got = packing.sequences(odd_docs, 128).collect()
    assert sum(len(r.ids) // 4 for r in got) == sum(k[3] * n for k, n in pieces_by_loop([(r.doc_id, r.text) for r in odd_docs.collect()], 128).items())
    assert max(len(r.ids) for r in got) <= 4 * 128


def fullest_by_search(counts, capacity):
    longest = max(counts)
    best = 0
    for take in product(*[range(n + 1) for n in counts.values()]):
        take = dict(zip(counts, take))
        total = sum(k * n for k, n in take.items())
        if take[longest] and best < total <= capacity:
            best = total
    return best


@settings(max_examples=120, deadline=None)
@given(st.dictionaries(st.integers(1, 19), st.integers(1, 4), min_size=1, max_size=5))
def test_fullest_combination(counts):
    used = packing.fullest(counts, 20)
    assert all(n <= counts[k] for k, n in used.items()) and max(counts) in used
    assert sum(k * n for k, n in used.items()) == fullest_by_search(counts, 20)


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 1000), max_size=20))
def test_patterns_use_everything(counts):
    patterns = packing.minimum_slack_patterns(counts, 50)
    used = Counter()
    for combination, copies in patterns:
        assert sum(k * n for k, n in combination.items()) <= 50
        for k, n in combination.items():
            used[k] += n * copies
    # a step leaves less than half of some count
    assert used == Counter(counts) and len(patterns) <= sum(n.bit_length() for n in counts.values())


def test_one_length_for_all(ready):
    docs = ready.range(3000).selectExpr("id AS doc_id", "'same words' AS text")
    rows = packing.pack(packing.tokenize(docs, 16), 16).collect()
    assert check_packing(rows, 16) == pytest.approx(sum(r.length for r in rows) / 15, abs=1)


def test_queries_give_added_tokens_their_id(ready, tmp_dir):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))  # as it comes: no flag
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "naïve — 日本語 <|endoftext|>", "no <|endoftext| here", "word " * 3000 + "<|endoftext|>"]
    docs = ready.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    assert plain.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    want = Counter()
    for i, text in enumerate(texts):
        ids = np.asarray(plain.encode(text, add_special_tokens=False).ids + [0], dtype="<u4").tobytes()
        want.update((i, k, at, len(x) // 4, zlib.crc32(x)) for k, at, x in packing.cut(ids, 2048))
    for rows in (packing.op10_min_bin_slack(ready, tmp_dir).collect(), corpus_pipeline.pack_sequences(ready, docs, tmp_dir).collect()):
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
