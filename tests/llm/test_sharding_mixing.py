"""Feistel shards against the integer permutation; the mix against a loop."""

import re
import zlib
from collections import Counter, defaultdict
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from conftest import SF
from tickwise.llm import mixing, sharding
from tickwise.llm.common import table


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 977, 4096])
def test_permutation_is_one_to_one(n):
    assert sorted(sharding.permute_int(i, n, 5) for i in range(n)) == list(range(n))


def test_column_permutation_equals_integers(ready):
    for n in (1, 5, 1000):
        got = ready.range(n).select(sharding.permuted(F.col("id"), n, 99).alias("p")).collect()
        assert [r.p for r in got] == [sharding.permute_int(i, n, 99) for i in range(n)]


def check_shards(rows, texts, shards=16):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by[k]) for k in range(min(shards, len(rows)))]
    assert max(sizes) - min(sizes) <= 1
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want


def test_shards_of_documents(ready):
    docs = table(ready, SF, "documents")
    rows = sharding.op8_feistel_shards(ready, SF).collect()
    check_shards(rows, [(r.doc_id, r.text) for r in docs.collect()])
    order = sorted(rows, key=lambda r: r.doc_id)
    assert [r.row_number for r in order] == list(range(len(rows)))
    assert [r.position for r in order] == [sharding.permute_int(i, len(rows), 20240601) for i in range(len(rows))]
    again = sharding.op8_feistel_shards(ready, SF).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_shards_of_odd_rows(odd_docs, no_docs, tmp_dir):
    rows = sharding.feistel_shards(odd_docs).collect()
    check_shards(rows, [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert sharding.feistel_shards(no_docs).count() == 0
    sharding.write_shards(odd_docs, f"{tmp_dir}/s", 3)
    assert odd_docs.sparkSession.read.parquet(f"{tmp_dir}/s").count() == odd_docs.count()


def mix_by_loop(rows, weights=(5, 2, 1)):
    """The mix of (doc_id, text, source) rows in plain Python."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = defaultdict(list)
    for i, t, s in rows:
        by[s].append((md5(str("" if i is None else i).encode()).hexdigest(), i, size(t)))
    names = sorted((s for s in by if s is not None)) + [None] * (None in by)
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    total = {s: sum(x[2] for x in v) for s, v in by.items()}
    target, capped = {}, set()
    while True:
        rest = 1.5 * sum(total.values()) - sum(2 * total[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: 2.0 * total[s] if s in capped else weight[s] * rest / free for s in names}
        over = {s for s in names if s not in capped and target[s] > 2 * total[s]}
        if not over:
            return total, target
        capped |= over


def test_mix_equals_loop(ready):
    docs = table(ready, SF, "documents").collect()
    total, target = mix_by_loop([(r.doc_id, r.text, r.source) for r in docs])
    got = {r.doc_id: r for r in mixing.op2_source_mix(ready, SF).collect()}
    taken = Counter()
    for d in docs:
        r = got[d.doc_id]
        assert r.source_size == total[d.source] and r.target == pytest.approx(target[d.source], rel=1e-12)
        assert 0 <= r.taken <= 2 * r.size
        taken[d.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)


def test_mix_of_odd_rows_and_documents(odd_docs, no_docs):
    rows = odd_docs.collect()
    total, target = mix_by_loop([(r.doc_id, r.text, r.source) for r in rows])
    sized, plan = mixing.mix_plan(odd_docs, bucket_rows=2)
    got = mixing.with_plan(sized, plan).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        taken[r.source] += r.epochs * r["size"] + r.extra
        assert r.epochs * r["size"] + r.extra <= 2 * r["size"]
    for s in target:  # equal rows on a cut share it evenly, rounded down
        assert target[s] - 3 <= taken[s] <= target[s] + 1
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    assert all(abs(words[s] - taken[s]) <= 0 for s in words)
    assert mixing.mixed_documents(no_docs).count() == 0


def test_hot_source_is_cut_into_buckets(ready):
    rows = ready.range(6000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a"), F.col("id").cast("string")).alias("text"),
                                    F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("hot").alias("source"))
    sized, plan = mixing.mix_plan(rows, bucket_rows=500)
    got = mixing.with_plan(sized, plan).groupBy("source").agg(F.sum(F.col("epochs") * F.col("size") + F.col("extra")).alias("t"),
                                                            F.first("target").alias("target"))
    assert got.where(F.abs(F.col("t") - F.col("target")) > 1).count() == 0
