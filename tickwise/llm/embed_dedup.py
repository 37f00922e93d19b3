"""Embedding near-duplicates by randomised-rotation binary codes.

A unit vector is rotated by random orthogonal matrices; the signs of the first
rotation are its code, and f = <code direction, vector> is stored with it. For
another vector y, <code of x, rotated y> / f_x is an unbiased estimate of the
cosine, wrong by more than e * sqrt((1 - f^2) / f^2) / sqrt(D - 1) only with a
probability that falls like exp(-c e^2). Pairs whose upper bound reaches the
threshold are computed exactly in double precision; the others are decided by
their bound.

Pairs are met in buckets, not by comparing all rows of a label: signs of further
rotations, k at a time, are T band keys. Two vectors at the threshold agree on a
sign with p = 1 - acos(threshold) / pi, so they share a band with 1 - (1 - p^k)^T,
which T sets to 0.9999 (more above the threshold). k = log2 of the row count
keeps the buckets of unrelated vectors small at every size. A pair counts in the
first band it shares, so links are counted once without listing pairs: tasks
return partial link counts and the local component of each vector. A large
bucket is cut into blocks and its pairs of blocks are dealt out.

Vectors that are null, empty, zero, hold null or non-finite components, or have
no label, link with nothing and stay alone. Vectors of different lengths never
link; each length present is coded and banded by itself.
Equal vectors link (cosine 1). Ids may be null (never kept; the component's id
is the smallest that is not) or repeat (rows stay apart). An empty table gives
no rows; other columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, prepare, table
from .components import connected_components
from .registry import register
from .vectors import lengths, matrix, unpack, usable

THRESHOLD = 0.93
MISS = 1e-4
SURE = 5.0
BLOCK = 1024
SEED = 4711


def bands_for(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits a band, bands) for n rows."""
    bits = min(max(math.ceil(math.log2(max(n, 2))), 8), 30)
    p = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-p))


class Coder:
    """Rotations for one dimension; made anew from the seed wherever needed."""

    def __init__(self, dim: int, bits: int, bands: int):
        rng = np.random.default_rng([SEED, dim])
        turns = 1 + -(-bits * bands // dim)
        self.turns = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(turns)]
        self.dim, self.bits, self.bands = dim, bits, bands

    def code(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(signs packed to bytes, correction factors)."""
        turned = unit @ self.turns[0]
        return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / math.sqrt(self.dim)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """Band keys, (rows, bands)."""
        signs = np.hstack([unit @ t > 0 for t in self.turns[1:]])[:, :self.bits * self.bands]
        weights = (1 << np.arange(self.bits, dtype=np.int64))
        return signs.reshape(len(unit), self.bands, self.bits) @ weights


def units(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def links_of(coder: Coder, band: np.ndarray, group: np.ndarray, half: np.ndarray, side: np.ndarray,
             node: np.ndarray, v: np.ndarray, code: np.ndarray, factor: np.ndarray, threshold: float) -> pd.DataFrame:
    """node, links, root for whole groups of rows sorted by group. ``half``: a
    group is a pair of different blocks (``side`` tells a row's), so only pairs
    across them count."""
    unit = units(v)
    turned = unit @ coder.turns[0]
    sign = (np.unpackbits(code, axis=1)[:, :coder.dim].astype(np.float64) * 2 - 1) / math.sqrt(coder.dim)
    slack = SURE * np.sqrt(np.maximum(1 - factor ** 2, 0)) / factor / math.sqrt(max(coder.dim - 1, 1))
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[start, len(group)])
    near_a, near_b = [], []

    def exact(a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            cosine = np.einsum("ij,ij->i", v[a], v[b]) / (np.linalg.norm(v[a], axis=1) * np.linalg.norm(v[b], axis=1))
            ok = cosine >= threshold
            near_a.append(a[ok])
            near_b.append(b[ok])

    # large groups: estimates as one product of codes and rotated vectors, some rows at a time
    for s, n in zip(start[size > 48], size[size > 48]):
        rows = np.arange(s, s + n)
        for part in np.array_split(rows, max(1, n // 256)):
            estimate = sign[part] @ turned[rows].T / factor[part, None] + slack[part, None]
            a, b = np.nonzero(estimate >= threshold)
            a, b = part[a], rows[b]
            keep = (a < b) & (~half[a] | (side[a] != side[b]))
            exact(a[keep], b[keep])
    # small groups: all at once, by distance between the rows
    small = np.repeat(size <= 48, size)
    for d in range(1, int(size[size <= 48].max(initial=1))):
        a = np.flatnonzero(small[:-d] & (group[d:] == group[:-d]))
        b = a + d
        keep = ~half[a] | (side[a] != side[b])
        a, b = a[keep], b[keep]
        if len(a):
            estimate = np.einsum("ij,ij->i", sign[a], turned[b]) / factor[a] + slack[a]
            exact(a[estimate >= threshold], b[estimate >= threshold])
    none = pd.DataFrame({"node": np.empty(0, np.int64), "links": np.empty(0, np.int64), "root": np.empty(0, np.int64)})
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (near_a, near_b))
    if not len(a):
        return none
    used, back = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = back[:len(a)], back[len(a):]
    keys = coder.keys(unit[used])
    first = np.empty(len(a), dtype=bool)
    for i in range(0, len(a), 100_000):
        part = slice(i, i + 100_000)
        first[part] = (keys[x[part]] == keys[y[part]]).argmax(axis=1) == band[a[part]]
    links = np.bincount(x[first], minlength=len(used)) + np.bincount(y[first], minlength=len(used))
    # smallest node of the local component (rows of several groups never meet: a row stands for one group)
    root = node[used].copy()
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        if (root == before).all():
            break
    return pd.DataFrame({"node": node[used], "links": links, "root": root})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``vectors``."""
    v = F.col(f"`{vector_col}`")
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
                          F.when(usable(v) & F.exists(v, lambda x: x != 0), v).alias("v"))
    rows = materialise(rows.withColumn("node", F.monotonically_increasing_id()))
    live = rows.where("v IS NOT NULL AND label IS NOT NULL")
    parts = reduce(DataFrame.unionAll, [links_of_length(live.where(F.size("v") == dim), dim, threshold, miss) for dim in lengths(live, "v")])
    links = parts.groupBy("node").agg(F.sum("links").alias("n_links"))
    found = connected_components(parts.select(F.col("node").alias("a"), F.col("root").alias("b")))
    got = materialise(rows.select("vec_id", "node").join(links, "node", "left").join(found, "node", "left")
                      .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "node").alias("component")))
    smallest = got.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return got.join(smallest, "component").select("vec_id", "n_links", "component_id",
                                                  F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def links_of_length(live: DataFrame, dim: int, threshold: float, miss: float) -> DataFrame:
    """node, links, root (partial rows) of ``live`` (node, label, v), whose
    vectors have ``dim`` components."""
    bits, bands = bands_for(live.count(), threshold, miss)
    coder_of = lambda: Coder(max(dim, 1), bits, bands)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = coder_of()
        for pdf in batches:
            if len(pdf):
                vs = matrix(pdf["v"])
                code, factor = coder.code(units(vs))
                yield pd.DataFrame({"node": pdf["node"], "label": pdf["label"], "vector": [x.tobytes() for x in vs], "code": [x.tobytes() for x in code],
                                    "factor": factor, "keys": list(coder.keys(units(vs)))})

    kind = live.schema["label"].dataType.simpleString()
    coded = materialise(live.select("node", "label", "v").mapInPandas(
        encode, f"node long, label {kind}, vector binary, code binary, factor double, keys array<long>"))
    banded = coded.select("node", "label", F.posexplode("keys").alias("band", "key"))
    sizes = banded.groupBy("label", "band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = banded.join(sizes, ["label", "band", "key"]).withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = (shared.withColumn("side", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("node", "label", "band", "key", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j")))
    met = (spread.join(coded.select("node", "vector", "code", "factor"), "node")
           .repartition("label", "band", "key", "i", "j").sortWithinPartitions("label", "band", "key", "i", "j", "node"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, rest = coder_of(), None

        def done(pdf: pd.DataFrame) -> pd.DataFrame:
            keys = pdf[["label", "band", "key", "i", "j"]]
            new = (keys != keys.shift()).any(axis=1).to_numpy()
            return links_of(coder, pdf["band"].to_numpy(), np.cumsum(new), (pdf["i"] != pdf["j"]).to_numpy(), pdf["side"].to_numpy(),
                            pdf["node"].to_numpy(), unpack(pdf["vector"]), unpack(pdf["code"], "u1"), pdf["factor"].to_numpy(), threshold)

        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            last = pdf[["label", "band", "key", "i", "j"]].iloc[-1] if len(pdf) else None
            cut = int((pdf[["label", "band", "key", "i", "j"]] == last).all(axis=1).to_numpy().argmax()) if len(pdf) else 0
            if cut:
                yield done(pdf.iloc[:cut])
            rest = pdf.iloc[cut:]
        if rest is not None and len(rest):
            yield done(rest)

    return materialise(met.mapInPandas(compare, "node long, links long, root long"))


@register("op3_rotation_codes")
def op3_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings of equal label."""
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "embeddings"))
