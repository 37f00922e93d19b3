"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered globally by (doc_id, text CRC, size). A keyed Feistel network
over Z_a x Z_b (a = ceil(sqrt(n)), b = ceil(n / a)) permutes [0, a*b), which is
less than a longer than [0, n); a value beyond n is permuted again until it
falls inside (cycle walking), which keeps the map one-to-one on [0, n). From
the permuted position p follow shard = p mod shards and slot = p div shards:
shard sizes differ by one row at most, slots have no gaps, and both can be
computed for any row number, and inverted, without reading the data.

Null texts have size 1 (no bytes, plus 1) and the CRC of the empty text; null
ids sort first; equal rows are interchangeable; an empty table gives no rows;
other columns are carried only when asked for.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import global_row_number, materialise, table
from .registry import register

PRIME = (1 << 31) - 1
ROUNDS = 4
WALK = 64


def round_keys(seed: int) -> list[tuple[int, int, int, int]]:
    """Four constants below PRIME for each round (a Lehmer sequence of the seed)."""
    x, out = seed % (PRIME - 1) + 1, []
    for _ in range(ROUNDS):
        k = []
        for _ in range(4):
            x = x * 48271 % PRIME
            k.append(x)
        out.append(tuple(k))
    return out


def half_sizes(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def permute_int(i: int, n: int, seed: int) -> int:
    """The permutation for one number in plain Python (for readers of shards and tests)."""
    a, b = half_sizes(n)
    while True:
        x, y = i // b, i % b
        for add1, mul1, add2, mul2 in round_keys(seed):
            t = (y + add1) % PRIME
            x = (x + (t * t % PRIME) * mul1 % PRIME) % a
            t = (x + add2) % PRIME
            y = (y + (t * t % PRIME) * mul2 % PRIME) % b
        i = x * b + y
        if i < n:
            return i


def div(v: Column, by: int) -> Column:
    """Integer quotient of a non-negative long."""
    return F.call_function("div", v, F.lit(by).cast("long"))


def permuted(i: Column, n: int, seed: int) -> Column:
    """The same permutation as a column expression over row numbers."""
    a, b = half_sizes(n)
    lng = lambda v: F.lit(v).cast("long")
    keys = F.array(*[F.struct(*[lng(v).alias(f"k{j}") for j, v in enumerate(k)]) for k in round_keys(seed)])

    def mix(v: Column, add: Column, mul: Column) -> Column:
        t = (v + add) % lng(PRIME)
        return ((t * t) % lng(PRIME) * mul) % lng(PRIME)

    def one(state: Column, key: Column) -> Column:
        x = (state["x"] + mix(state["y"], key["k0"], key["k1"])) % lng(a)
        return F.struct(x.alias("x"), state["y"].alias("y"))

    def two(state: Column, key: Column) -> Column:
        y = (state["y"] + mix(state["x"], key["k2"], key["k3"])) % lng(b)
        return F.struct(state["x"].alias("x"), y.alias("y"))

    def network(v: Column) -> Column:
        start = F.struct(div(v, b).alias("x"), (v % lng(b)).alias("y"))
        # each half round is its own fold step, so nothing is expanded twice
        halves = F.flatten(F.transform(keys, lambda k: F.array(
            F.struct(F.lit(0).alias("h"), k.alias("k")), F.struct(F.lit(1).alias("h"), k.alias("k")))))
        return F.reduce(halves, start, lambda s, k: F.when(k["h"] == 0, one(s, k["k"])).otherwise(two(s, k["k"])),
                        lambda s: s["x"] * lng(b) + s["y"])

    # fewer than a values lie outside, so a walk needs at most a*b - n + 1 steps; 64 in a row are out of reach for
    # large n (each step leaves with probability 1 - 1/sqrt(n)), and the error below would tell
    steps = min(a * b - n, WALK)
    walked = network(i.cast("long"))
    if steps:
        walked = F.reduce(F.sequence(F.lit(1), F.lit(steps)), walked,
                          lambda acc, _: F.when(acc >= n, network(acc)).otherwise(acc))
    return walked


def feistel_shards(docs: DataFrame, shards: int = 16, seed: int = 20240601, id_col: str = "doc_id",
                   text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, row_number, position, shard, slot per row
    (plus ``keep`` columns), rows in a reproducible shuffled order."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = {"doc_id", "size", "text_crc32", "row_number", "position", "shard", "slot"}
    extra = [F.col(f"`{c}`") for c in (keep or []) if c not in own]
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), *extra)
    # written first: range bounds are sampled from these few bytes a row, not by a second pass over the texts
    numbered = global_row_number(materialise(rows), ["doc_id", "text_crc32", "size"])
    n = numbered.count()
    at = numbered.withColumn("position", permuted(F.col("row_number"), max(n, 1), seed))
    at = at.withColumn("position", F.when(F.col("position") < n, F.col("position"))
                       .otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long")))
    return at.withColumn("shard", (F.col("position") % shards).cast("int")) \
             .withColumn("slot", div(F.col("position"), shards))


def write_shards(docs: DataFrame, path: str, shards: int = 16, **how) -> None:
    """The rows with all their columns as one folder per shard, in slot order."""
    placed = feistel_shards(docs, shards, keep=docs.columns, **how)
    placed.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


@register("op8_feistel_shards")
def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards under the law ``rows``."""
    got = feistel_shards(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "row_number", "position")
