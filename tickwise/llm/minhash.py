"""MinHash near-duplicates by ProbMinHash signatures, banding and verification.

Shingles are five words (runs of ASCII letters and digits, or of non-ASCII
characters, in lower case); a shorter text is one shingle of its words. A
distinct shingle weighs as much as its words are long (bytes, 255 at most),
however often it stands in the text: words in common count for their text. It
starts a Poisson process of its weight's rate, whose points fall on random
registers; a register keeps the shingle with the earliest point, and a process
ends once its next point comes after the latest register. Two signatures agree
on a register with the probability Jaccard similarity of the weighted sets. As a
shingle weighs the same in every text, that is the weight of the common shingles
over the weight of all, by which pairs are verified too.

24 bands of 4 registers propose pairs: at similarity 0.8 a pair shares no band
with probability 3e-6. In a band's bucket every text is paired with two
pivots, not with every other. Pairs whose signatures agree on less than 0.62 of
96 registers (4.4 standard deviations below 0.8) go; the rest are verified by
that exact similarity of their weighted shingle sets. Links make components. What
pivots leave open is settled next: buckets whose texts are still in different
components are compared in blocks, pairs across components only and each in
one bucket, verified where they meet and never listed, so that no link between
components is lost; a group that the pivots have joined costs nothing there.

Exact copies are one node, found by a 128-bit digest. A null text is an empty
one; empty texts, and texts without words, are copies only of texts that are
the same string. Ids may be null or repeat; rows are told apart by a row number
kept with the signatures. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, prepare, table
from .components import connected_components
from .registry import register

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
SURE = 0.62
BLOCK = 512
BROADCAST_IDS = 1_000_000

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(97, 123)]] = True
_IS_WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: xor-shifts and odd multipliers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, shingle hash, count) of every distinct shingle, sorted by
    text and hash."""
    return weighted_shingles(texts)[:3]


def weighted_shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, shingle hash, count, weight) of every distinct shingle,
    sorted by text and hash. A word's hash is a polynomial over its bytes read
    off one running sum over the whole batch."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    ends_at = np.cumsum(sizes + 1)
    inside = _IS_WORD[data].astype(np.int8)
    edge = np.diff(inside, prepend=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    none = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    if not len(begin):
        return none
    with np.errstate(over="ignore"):
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), dtype=np.uint64)])
        word = mix((running[end] - running[begin]) * powers(_INVERSE, len(data))[begin] + (end - begin).astype(np.uint64))
        owner = np.searchsorted(ends_at, begin, side="right")
        per_text = np.bincount(owner, minlength=len(texts))
        first = np.cumsum(per_text) - per_text
        # position within the text; a shingle begins wherever WORDS words follow, and at 0 of a shorter text
        place = np.arange(len(word)) - first[owner]
        length = np.minimum(WORDS, per_text[owner])
        starts = np.flatnonzero(place + length <= per_text[owner])
        h = np.zeros(len(starts), dtype=np.uint64)
        letters = np.concatenate([[0], np.cumsum(end - begin)])
        weight = np.minimum(letters[starts + length[starts]] - letters[starts], 255)
        for k in range(WORDS):
            live = k < length[starts]
            h[live] = mix(h[live] * np.uint64(0xD1342543DE82EF95) + word[starts[live] + k] + np.uint64(k + 1))
    own = owner[starts]
    order = np.lexsort((h, own))
    own, h, weight = own[order], h[order], weight[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return own[at], h[at], np.diff(np.append(at, len(h))), weight[at]


def signatures(owner: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash: (n, registers) hashes of the first arrivals, 0 for a text
    without shingles. One round draws the next point of every process that
    can still be first somewhere."""
    first = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, dtype=np.uint64)
    time, at, number = np.zeros(len(h)), np.arange(len(h)), 0
    with np.errstate(over="ignore"):
        while len(at):
            number += 1
            draw = mix(h[at] + np.uint64(number) * np.uint64(0x9E3779B97F4A7C15))
            gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 9007199254740992.0)
            time[at] += gap / weight[at]
            slot = owner[at] * registers + (mix(draw + np.uint64(1)) % np.uint64(registers)).astype(np.int64)
            better = time[at] < first[slot]
            slot, who = slot[better], at[better]
            np.minimum.at(first, slot, time[who])
            won = time[who] == first[slot]
            winner[slot[won]] = h[who[won]]
            latest = first.reshape(n, registers).max(axis=1)
            at = at[time[at] < latest[owner[at]]]
    return winner.reshape(n, registers)


def sign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, text_id (128-bit digest), n_shingles and signature
    (16 bits a register; 8 bytes are a band) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        for pdf in batches:
            texts = pdf["text"].to_list()
            owner, h, _, weight = weighted_shingles(texts)
            got = signatures(owner, h, weight.astype(np.float64), len(texts))
            short = (mix(got) & np.uint64(0xFFFF)).astype("<u2")
            sizes = np.bincount(owner, minlength=len(texts))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "text_hash": pdf["text_hash"],
                                "text_id": [xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in texts],
                                "n_shingles": sizes, "signature": [row.tobytes() if k else None for row, k in zip(short, sizes)]})

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return rows.mapInPandas(run, "doc_id long, text_hash long, text_id binary, n_shingles long, signature binary")


def nodes_of(signed: DataFrame) -> DataFrame:
    """One row per distinct text: node, text_id, text_hash, doc_id (smallest),
    row_id (of that row), signature."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "row_id", "text_hash", "signature")).alias("r")
    nodes = signed.groupBy("text_id").agg(first).select("text_id", "r.doc_id", "r.row_id", "r.text_hash", "r.signature")
    return materialise(nodes.withColumn("node", F.monotonically_increasing_id()))


def band_rows(nodes: DataFrame) -> DataFrame:
    """key, band, node: a row per band of every text with words."""
    cut = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substr("signature", b * 8 + 1, F.lit(8))))
    return nodes.where(F.col("signature").isNotNull()).select("node", F.posexplode(cut).alias("band", "key"))


def agreement(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b of the pairs whose signatures agree on SURE of the registers."""
    @F.pandas_udf("double")
    def agree(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        u, v = (np.frombuffer(b"".join(s), dtype="<u2").reshape(len(s), -1) for s in (x, y))
        return pd.Series((u == v).mean(axis=1))

    sig = lambda name: nodes.select(F.col("node").alias(name), F.col("signature").alias(f"s{name}"))
    return pairs.join(sig("a"), "a").join(sig("b"), "b").where(agree("sa", "sb") >= SURE).select("a", "b")


def weighted_set(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, weights) of a shingle set: four bytes a hash, then one a weight."""
    n = len(blob) // 5
    return np.frombuffer(blob, dtype="<u4", count=n), np.frombuffer(blob, dtype="u1", offset=4 * n)


def jaccard(u: tuple[np.ndarray, np.ndarray], v: tuple[np.ndarray, np.ndarray], least: float) -> float:
    """Weight of the common shingles over that of all, or 0 if the sets' weights
    rule ``least`` out."""
    a, b = int(u[1].sum()), int(v[1].sum())
    if not min(a, b) or min(a, b) < least * max(a, b):
        return 0.0
    both = np.concatenate([u[0], v[0]])
    order = both.argsort(kind="stable")
    twice = both[order[1:]] == both[order[:-1]]
    common = int(np.concatenate([u[1], v[1]])[order[1:][twice]].sum())
    return common / (a + b - common)


def shingle_sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node, set (``weighted_set``) of the nodes in ``wanted``.
    Their texts are read again and cut where they lie; ids choose them,
    broadcast up to BROADCAST_IDS rows of 24 bytes (counted), by a shuffle
    beyond."""
    ids = materialise(nodes.join(wanted, "node").select("node", F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")))
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.join(side, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))).select("node", "text")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            owner, h, _, weight = weighted_shingles(pdf["text"].to_list())  # by text, and by hash in it
            at = np.searchsorted(owner, np.arange(len(pdf) + 1))
            short, weight = (h >> np.uint64(32)).astype("<u4"), weight.astype("u1")
            yield pd.DataFrame({"node": pdf["node"], "set": [short[i:j].tobytes() + weight[i:j].tobytes() for i, j in zip(at[:-1], at[1:])]})

    # repeated rows of one text give equal sets; one is kept
    return materialise(rows.mapInPandas(cut, "node long, set binary").groupBy("node").agg(F.min("set").alias("set")))


def verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, similarity: float = SIMILARITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """a, b, jaccard of the pairs whose shingle sets reach ``similarity``."""
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    sets = shingle_sets(ends, nodes, docs, id_col, text_col)

    @F.pandas_udf("double")
    def exact(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([jaccard(weighted_set(p), weighted_set(q), similarity) for p, q in zip(x, y)], dtype=float)

    part = lambda name: sets.select(F.col("node").alias(name), F.col("set").alias(f"s{name}"))
    return pairs.join(part("a"), "a").join(part("b"), "b").select("a", "b", exact("sa", "sb").alias("jaccard")).where(
        F.col("jaccard") >= similarity)


def join_block(node: np.ndarray, component: np.ndarray, side: np.ndarray, across: bool, band: int, sig: np.ndarray,
               sets: list[tuple[np.ndarray, np.ndarray]], similarity: float) -> list[tuple[int, int]]:
    """Links that join components among the rows of a block (``across``: of two
    blocks, told apart by ``side``). Pairs of different components whose
    signatures agree, and that share no earlier band (there they are met in
    that band's bucket), are verified from the likeliest on; a pair that earlier
    links have joined meanwhile is skipped."""
    up = {c: c for c in component.tolist()}

    def find(c: int) -> int:
        while up[c] != c:
            up[c] = up[up[c]]
            c = up[c]
        return c

    found, pairs = [], []
    for x in range(len(node)):
        y = np.arange(x + 1, len(node))
        y = y[(component[y] != component[x]) & ((side[y] != side[x]) if across else True)]
        if len(y):
            same = sig[y] == sig[x]
            agree = same.mean(axis=1)
            first = same.reshape(len(y), BANDS, ROWS).all(axis=2).argmax(axis=1)
            near = (agree >= SURE) & (first == band)
            pairs.append(np.column_stack([agree[near], np.full(near.sum(), x), y[near]]))
    if not pairs:
        return found
    pairs = np.concatenate(pairs)
    for _, x, y in pairs[np.argsort(-pairs[:, 0], kind="stable")]:
        x, y = int(x), int(y)
        p, q = find(component[x]), find(component[y])
        if p != q and jaccard(sets[x], sets[y], similarity) >= similarity:
            up[max(p, q)] = min(p, q)
            found.append((int(node[x]), int(node[y])))
    return found


def across_components(open_rows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """a, b: verified links between nodes of one bucket and different
    components. ``open_rows``: key, band, node, component, signature, set, size
    of the bucket. A bucket is cut into blocks of about BLOCK nodes; a pair of
    blocks is a group of its own, so a group never outgrows two blocks, and
    pairs are compared in it without being listed."""
    open_rows = open_rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = (open_rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "component",
                      "signature", "set"))
    grouped = spread.repartition("key", "band", "i", "j").sortWithinPartitions("key", "band", "i", "j", "own", "node")

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(g["signature"]), dtype="<u2").reshape(len(g), -1)
        found = join_block(g["node"].to_numpy(), g["component"].to_numpy(), g["own"].to_numpy(), g["i"].iloc[0] != g["j"].iloc[0],
                           int(g["band"].iloc[0]), sig, [weighted_set(x) for x in g["set"]], similarity)
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # the group that the last batch may have cut
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            parts = [g for _, g in pdf.groupby(["key", "band", "i", "j"], sort=False)]
            rest = parts.pop() if parts else None
            for g in parts:
                yield compare(g)
        if rest is not None:
            yield compare(rest)

    return grouped.mapInPandas(run, "a long, b long")


def with_links(found: DataFrame, more: DataFrame) -> DataFrame:
    """node, component after links ``more`` (a, b) between components: only the
    components that they join are looked at again."""
    if not more.limit(1).count():
        return found
    end = lambda name: found.select(F.col("node").alias(name), F.col("component").alias(f"c{name}"))
    ends = more.join(end("a"), "a", "left").join(end("b"), "b", "left")
    joined = materialise(connected_components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))))
    # nodes that stood alone are components of their own
    known = found.unionAll(joined.select("node", F.col("node").alias("component")).join(found, "node", "left_anti"))
    return materialise(known.join(joined.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left")
                       .select("node", F.coalesce("root", "component").alias("component")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, class_id, class_size, kept, twins per row of
    ``docs``: classes are components of texts linked at ``similarity`` or more;
    class_id is the smallest id in the class (null if all are null); exactly one
    row of a class is kept. ``twins``: rows with the kept row's id and text."""
    signed = materialise(sign(docs, id_col, text_col).withColumn("row_id", F.monotonically_increasing_id()))
    nodes = nodes_of(signed)
    bands = materialise(band_rows(nodes))
    buckets = bands.groupBy("key", "band").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("p"), F.max("node").alias("q")).where("size > 1")
    shared = materialise(bands.join(buckets, ["key", "band"]))
    pivots = shared.select("node", F.explode(F.array_distinct(F.array("p", "q"))).alias("pivot")).where("node <> pivot")
    pairs = pivots.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    tested = materialise(agreement(pairs, nodes))
    links = materialise(verify(tested, nodes, docs, similarity, id_col, text_col).select("a", "b"))
    found = materialise(connected_components(links))
    # two pivots settle buckets of up to three; larger ones are open while they span components
    wide = materialise(shared.where("size > 3").select("key", "band", "node", "size").join(found, "node", "left")
                       .withColumn("component", F.coalesce("component", "node")))
    still = wide.groupBy("key", "band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key", "band")
    open_rows = materialise(wide.join(still, ["key", "band"], "left_semi"))
    if open_rows.limit(1).count():
        sets = shingle_sets(open_rows.select("node").distinct(), nodes, docs, id_col, text_col)
        more = across_components(open_rows.join(nodes.select("node", "signature"), "node").join(sets, "node"), similarity)
        found = with_links(found, materialise(more))
    per_text = nodes.join(found, "node", "left").select("text_id", F.coalesce("component", "node").alias("component"))
    rows = materialise(signed.select("doc_id", "text_hash", "text_id", "row_id").join(per_text, "text_id"))
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "row_id", "text_id")).alias("r")
    classes = rows.groupBy("component").agg(pick, F.count(F.lit(1)).alias("class_size"))
    joined = rows.join(classes, "component")
    return joined.select("doc_id", "text_hash", F.col("r.doc_id").alias("class_id"), "class_size", (F.col("row_id") == F.col("r.row_id")).alias("kept"),
                         (F.col("doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("text_id") == F.col("r.text_id"))).alias("twin"))


def deduplicated(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one row of each class. Rows leave by an anti join on (id,
    text hash); repeated rows of a kept one leave by their own grouping."""
    plan = materialise(near_duplicates(docs, **how))
    gone = materialise(plan.where(~F.col("twin")).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct())
    repeated = materialise(plan.where("twin and not kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct())
    text = F.coalesce(F.col("`text`"), F.lit(""))
    row = docs.select(F.col("`doc_id`").alias("doc_id"), F.xxhash64(text).alias("hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    small = lambda side: F.broadcast(side) if side.count() <= BROADCAST_IDS else side
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("hash") == F.col("__hash"))
    stay = row.join(small(gone), same, "left_anti")
    out = lambda d: d.select(*[F.col("__row")[c].alias(c) for c in docs.columns])
    if not repeated.limit(1).count():
        return out(stay)
    twins = stay.join(small(repeated), same, "left_semi").groupBy("doc_id", "hash").agg(F.min_by("__row", F.lit(0)).alias("__row"))
    return out(stay.join(small(repeated), same, "left_anti").select("__row").unionAll(twins.select("__row")))


@register("op4_probminhash")
def op4_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")
