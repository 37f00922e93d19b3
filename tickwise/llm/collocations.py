"""Collocations from a weighted de Bruijn graph of word triples.

Nodes are pairs of neighbouring words, an edge is a triple (the longest gram):
it runs from its first pair to its second, which overlap in a word. Only edges
are counted over the texts. Shorter counts follow from them: a pair occurs as
often as flows out of its node, plus the pieces that end in it; a word as often
as flows out of all its pairs, plus the pieces that end in it.

Words are cut in blocks of whole texts inside the tasks. A block adds up its
edges and derives its nodes' and words' counts from their flow, which add up
over blocks as edges do. Its rows are dealt to buckets by a hash of lang and
gram, so no frequent word or pair makes a bucket large, and each bucket's rows
travel as one compressed column block: the shuffle moves a fraction of the rows'
size. Buckets are as many as keep one small, whatever the corpus. What occurs
less often than ``least`` can be no part of a phrase that reaches it and stays
behind there: the graph that is kept is small.

A node that all its flow enters by one edge and leaves by one edge is unary:
these two edges, and the node, share one weight. Runs of such edges are
compacted into one path. As the occurrences of neighbours in a path are the same
places one word apart, so are their first occurrences: edges in the order of
their first occurrence show the paths without a walk over the graph. Inside a
path all counts are the path's weight, and a pair there is always covered by its
triple; only where a path ends is a node's flow looked up.

Pieces end at ``.,;:!?`` and at the line ends U+000A to U+000D, words at spaces
and tabs; A to Z become lower case, other letters stay. A null text is empty, a
null lang is ``und``. Empty texts and pieces have no words; texts of any length
are read whole; equal rows count each; ties follow the phrase's bytes; an empty
table gives no rows; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, prepare, table
from .registry import register

LEAST = 10
TOP = 2000
COVER = 50
#: Words of a block that are added up at once; a block holds whole texts.
BLOCK = 1 << 20
PLACES = 22
#: Characters of text to a bucket: about two million words.
BUCKET = 1 << 23
#: A word that makes 1 / SHARE of all words is looked up in a broadcast table of at most SHARE rows.
SHARE = 100_000
SLICES = 64

_LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 10)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return x ^ (x >> np.uint64(33))


class Block:
    """Grams of a block of texts of one lang, added up: ``grams`` (up to three
    word numbers, 0 for none), ``n`` and ``at`` (first place; words keep none).
    The gram without words counts all words."""

    def __init__(self, texts: list[bytes]):
        whole = b" \n ".join(x.translate(_LETTERS).replace(b"\n", b" \n ") for x in texts)
        words = pc.split_pattern(pa.array([whole], pa.large_binary()).cast(pa.large_string()), " ").values
        words = words.filter(pc.not_equal(words, "")).dictionary_encode()
        names = words.dictionary
        end = pc.index(names, "\n").as_py()
        ids = words.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        if end >= 0:  # 0 is the end of a piece
            ids[ids == end + 1] = 0
        self.names = pa.concat_arrays([pa.array([""], names.type), names])
        self.places = len(ids)
        second, third = np.append(ids[1:], 0), np.append(ids[2:], [0, 0])[:len(ids)]
        place = np.flatnonzero(ids)
        first, second = ids[place], second[place]
        third = np.where(second > 0, third[place], 0)
        # three word numbers in one key, unless one text alone holds millions of different words
        width = max(int(ids.max(initial=0)).bit_length(), 1)
        if 3 * width < 63:
            key, seen, n = np.unique((first << 2 * width) | (second << width) | third, return_index=True, return_counts=True)
            grams = np.column_stack([key >> 2 * width, (key >> width) & ((1 << width) - 1), key & ((1 << width) - 1)])
        else:
            grams, seen, n = np.unique(np.column_stack([first, second, third]), axis=0, return_index=True, return_counts=True)
        # a node's flow: its edges and the pieces that end in it; a word's: its nodes and the pieces that end in it
        begin = np.flatnonzero(np.r_[True, (grams[1:, :2] != grams[:-1, :2]).any(axis=1)][:len(grams)])
        nodes, flow = grams[begin].copy(), np.add.reduceat(n, begin) if len(begin) else n
        nodes[:, 2] = 0
        flow_of_word = np.bincount(nodes[:, 0], weights=flow, minlength=1).astype(np.int64)
        single = np.flatnonzero(flow_of_word)
        edge, pair = grams[:, 2] > 0, nodes[:, 1] > 0
        alone = np.zeros((len(single) + 1, 3), dtype=np.int64)
        alone[:-1, 0] = single
        self.grams = np.concatenate([grams[edge], nodes[pair], alone])
        self.n = np.concatenate([n[edge], flow[pair], flow_of_word[single], [len(place)]]).astype(np.int64)
        self.at = np.concatenate([place[seen[edge]], np.zeros(int(pair.sum()) + len(alone), dtype=np.int64)])

    def packed(self, lang: str, base: int, buckets: int) -> Iterator[tuple[int, bytes]]:
        """(bucket, compressed columns) of every bucket that holds grams."""
        import xxhash
        import zstandard
        told = np.fromiter(map(xxhash.xxh64_intdigest, self.names.to_pylist()), dtype=np.uint64, count=len(self.names))
        with np.errstate(over="ignore"):
            h = np.full(len(self.grams), xxhash.xxh64_intdigest(lang), dtype=np.uint64)
            for part in self.grams.T:
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + told[part])
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.flatnonzero(np.r_[True, np.diff(bucket[order]) > 0])
        grams, n, at = self.grams[order], self.n[order], self.at[order] + base
        shrink = zstandard.ZstdCompressor(level=1).compress
        for lo, hi in zip(cut, np.r_[cut[1:], len(order)]):
            words = [self.names.take(pa.array(c)).cast(pa.string()) for c in grams[lo:hi].T]
            sizes = [np.diff(np.frombuffer(w.buffers()[1], dtype="<i4", count=hi - lo + 1)) for w in words]
            letters = [w.buffers()[2].to_pybytes()[:k.sum()] if w.buffers()[2] else b"" for w, k in zip(words, sizes)]
            numbers = np.concatenate([[hi - lo], n[lo:hi], at[lo:hi]]).astype("<i8")
            yield int(bucket[order[lo]]), shrink(b"".join([numbers.tobytes(), np.concatenate(sizes).astype("<i4").tobytes(), *letters]))


def unpacked(blob: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(gram, n, at) of a packed bucket; a gram's words have a space between."""
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(blob)
    k = int(np.frombuffer(raw, dtype="<i8", count=1)[0])
    n, at = (np.frombuffer(raw, dtype="<i8", count=k, offset=8 + i * 8 * k) for i in (0, 1))
    sizes = np.frombuffer(raw, dtype="<i4", count=3 * k, offset=8 + 16 * k).reshape(3, k)
    start, words = 8 + 28 * k, []
    for size in sizes:
        ends = np.concatenate([[0], np.cumsum(size)]).astype("<i4")
        words.append(pa.StringArray.from_buffers(k, pa.py_buffer(ends), pa.py_buffer(raw[start:start + int(ends[-1])])))
        start += int(ends[-1])
    return pc.utf8_rtrim(pc.binary_join_element_wise(*words, " "), characters=" "), n, at


def phrase_graph(docs: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, gram, n, at of the edges (three words), nodes (two) and words that
    occur ``least`` times; the empty gram of a lang has its number of words.
    ``at`` numbers places, neighbours in a piece one apart."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"), text.alias("text"))
    buckets = 1 + (rows.agg(F.sum(F.length("text"))).first()[0] or 0) // BUCKET

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 40
        held: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base
            for lang in list(held):
                block = Block(held.pop(lang))
                for bucket, blob in block.packed(lang, base, buckets):
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int64()), "lang": pa.array([lang], pa.string()),
                                                      "blob": pa.array([blob], pa.binary())})
                base += -(-block.places >> PLACES) << PLACES

        for batch in batches:
            for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                held.setdefault(lang, []).append(t)
                size += t.count(b" ") + t.count(b"\t") + 1
                if size >= BLOCK:
                    yield from flush()
                    size = 0
        yield from flush()

    def add(part: pa.Table) -> pa.Table:
        langs, out = part.column("lang").to_pylist(), []
        for lang in dict.fromkeys(langs):
            got = [unpacked(b) for b, of in zip(part.column("blob").to_pylist(), langs) if of == lang]
            grams = pa.table({"gram": pa.chunked_array([g for g, _, _ in got]), "n": np.concatenate([n for _, n, _ in got]),
                              "at": np.concatenate([at for _, _, at in got])})
            total = grams.group_by("gram").aggregate([("n", "sum"), ("at", "min")])
            total = total.filter(pc.or_(pc.greater_equal(total.column("n_sum"), least), pc.equal(total.column("gram"), "")))
            out.append(pa.table([pa.array([lang] * len(total), pa.string()), total.column("gram").cast(pa.string()), total.column("n_sum"),
                                 total.column("at_min")], names=["lang", "gram", "n", "at"]))
        return pa.concat_tables(out)

    packed = rows.mapInArrow(cut, "bucket long, lang string, blob binary")
    return materialise(packed.groupBy("bucket").applyInArrow(add, "lang string, gram string, n long, at long"))


def words_in(gram: str) -> Column:
    return F.when(F.col(gram) == "", 0).otherwise(F.length(gram) - F.length(F.replace(gram, F.lit(" "), F.lit(""))) + 1)


def path_edges(graph: DataFrame) -> DataFrame:
    """lang, node, third, n, f, at, suffix, head, linked: every edge of the
    graph with its node's flow; ``linked``: the next word's edge continues its
    path (the node between is unary); ``head``: place of the path's first edge."""
    nodes = graph.where(words_in("gram") == 2).select("lang", F.col("gram").alias("node"), F.col("n").alias("f"))
    node, third = F.substring_index("gram", " ", 2), F.substring_index("gram", " ", -1)
    edges = graph.where(words_in("gram") == 3).select("lang", node.alias("node"), third.alias("third"), "n", "at")
    edges = edges.join(nodes, ["lang", "node"]).withColumn("block", F.shiftright("at", PLACES))
    # a window holds the edges first seen in one block, at most its words; a path that outgrows it goes on as another
    order = Window.partitionBy("block").orderBy("at")
    joins = lambda at, n, f, prior_at, prior_n: (at == prior_at + 1) & (n == prior_n) & (f == prior_n)
    follows = joins(F.col("at"), F.col("n"), F.col("f"), F.lag("at").over(order), F.lag("n").over(order))
    leads = joins(F.lead("at").over(order), F.lead("n").over(order), F.lead("f").over(order), F.col("at"), F.col("n"))
    marked = edges.select("*", F.coalesce(follows, F.lit(False)).alias("follows"), F.coalesce(leads, F.lit(False)).alias("linked"))
    head = F.max(F.when(~F.col("follows"), F.col("at"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    suffix = F.concat_ws(" ", F.substring_index("node", " ", -1), "third")
    return marked.select("lang", "node", "third", "n", "f", "at", suffix.alias("suffix"), head.alias("head"), "linked")


def paths(graph: DataFrame) -> DataFrame:
    """lang, phrase, n, edges: the compacted paths, each the longest phrase that
    always occurs as a whole. A path is no longer than a piece of a text."""
    parts = path_edges(graph).groupBy("lang", "head").agg(
        F.sort_array(F.collect_list(F.struct("at", "node", "third"))).alias("p"), F.first("n").alias("n"))
    phrase = F.concat_ws(" ", F.col("p")[0]["node"], F.concat_ws(" ", F.transform("p", lambda x: x["third"])))
    return parts.select("lang", phrase.alias("phrase"), "n", F.size("p").alias("edges"))


def with_word_count(rows: DataFrame, words: DataFrame, key: str, out: str, total: int) -> DataFrame:
    """``rows`` with how often their word ``key`` occurs. Words that make 1 /
    SHARE of all words (at most SHARE of these) come by broadcast; the others by
    a shuffle, in which rows already served are spread by their phrase."""
    often = words.where(F.col("w") >= F.lit(total) / SHARE)
    seldom = words.where(F.col("w") < F.lit(total) / SHARE)
    side = lambda d, k, c: d.select(F.col("lang"), F.col("node").alias(k), F.col("w").alias(c))
    got = rows.join(F.broadcast(side(often, key, "__often")), ["lang", key], "left")
    got = got.withColumn("__key", F.when(F.col("__often").isNull(), F.col(key)).otherwise(F.concat(F.lit("\n"), "phrase")))
    got = got.join(side(seldom, "__key", "__seldom"), ["lang", "__key"], "left")
    return got.withColumn(out, F.coalesce("__often", "__seldom")).drop("__often", "__seldom", "__key")


def score(a: str | Column, left: str | Column, right: str | Column) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of up to 38 digits."""
    a, left, right = (F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c.cast("decimal(38,0)") for c in (a, left, right))
    million = F.lit(1_000_000).cast("decimal(38,0)")
    return F.call_function("div", (million * a * a).cast("decimal(38,0)"), (left * right).cast("decimal(38,0)")).cast("long")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, cover: int = COVER,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` phrases of two
    and three words of each lang that occur ``least`` times and that no longer
    one covers (``cover`` percent of their occurrences)."""
    graph = phrase_graph(docs, least, lang_col, text_col)
    words = graph.where(words_in("gram") == 1).select("lang", F.col("gram").alias("node"), F.col("n").alias("w"))
    counts = graph.where("gram = ''").select("lang", "n")
    total = counts.agg(F.sum("n")).first()[0] or 0
    nodes = graph.where(words_in("gram") == 2).select("lang", F.col("gram").alias("node"), F.col("n").alias("f"))
    triples = materialise(path_edges(graph))
    ends = triples.where("not linked")
    flow = nodes.select("lang", F.col("node").alias("suffix"), F.col("f").alias("g"))
    # inside a path the second pair's count is the path's weight; at its end it is the node's flow
    third = triples.where("linked").withColumn("g", F.col("n")).unionByName(ends.join(flow, ["lang", "suffix"]))
    third = third.select("lang", F.concat_ws(" ", "node", "third").alias("phrase"), F.col("n").alias("a"), F.col("f").alias("left2"),
                         F.col("g").alias("right2"), F.substring_index("node", " ", 1).alias("first"), F.col("third").alias("last"))
    # edges that hold a pair: those that leave its node, and those that enter it, where a path ends (inside one, the edge
    # that leaves has the same weight)
    holds = triples.select("lang", "node", "n").unionAll(ends.select("lang", "suffix", "n")).groupBy("lang", "node").agg(F.max("n").alias("longest"))
    second = nodes.join(holds, ["lang", "node"], "left").where(100 * F.coalesce("longest", F.lit(0)) < cover * F.col("f")).select(
        "lang", F.col("node").alias("phrase"), F.col("f").alias("a"), F.lit(None).cast("long").alias("left2"),
        F.lit(None).cast("long").alias("right2"), F.substring_index("node", " ", 1).alias("first"), F.substring_index("node", " ", -1).alias("last"))
    found = with_word_count(with_word_count(third.unionByName(second), words, "first", "w1", total), words, "last", "w2", total)
    pair = F.col("left2").isNull()
    one, two = score("a", F.col("w1"), F.when(pair, F.col("w2")).otherwise(F.col("right2"))), score("a", F.col("left2"), F.col("w2"))
    found = found.withColumn("one", one).withColumn("two", two)
    later = F.coalesce(F.col("two") < F.col("one"), F.lit(False))  # the second cut scores lower
    found = found.select("lang", "phrase", "a", F.when(later, F.col("left2")).otherwise(F.col("w1")).alias("l"),
                         F.when(pair | later, F.col("w2")).otherwise(F.col("right2")).alias("r"),
                         F.when(later, F.col("two")).otherwise(F.col("one")).alias("score"))
    # the best of every slice first: a lang's last sort holds SLICES * top rows at most
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    sliced = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SLICES))).orderBy(*best)
    found = found.withColumn("rank", F.row_number().over(sliced)).where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return found.join(counts, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = """
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
s AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM p),
k AS (SELECT lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda i: w[i:i + k - 1])) AS w FROM s, (VALUES (1), (2), (3)) v(k) WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(w, ' ') AS phrase, any_value(w) AS w, count(*)::BIGINT AS f FROM k GROUP BY 1, 2, 3),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
h AS (SELECT lang, phrase, k, f AS a, w, unnest(range(1, k)) AS j FROM c),
y AS (SELECT lang, phrase, k, a, j, array_to_string(w[1:j], ' ') AS left_part, array_to_string(w[j + 1:], ' ') AS right_part FROM h),
x AS (SELECT y.lang, y.phrase, y.k, a, j, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
      FROM y JOIN f l ON l.lang = y.lang AND l.phrase = left_part JOIN f r ON r.lang = y.lang AND r.phrase = right_part),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
z AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, f FROM c WHERE k = 3),
m AS (SELECT lang, phrase, max(f) AS most FROM z GROUP BY lang, phrase),
d AS (SELECT b.* FROM b LEFT JOIN m USING (lang, phrase) WHERE k = 3 OR most IS NULL OR 100 * most < 50 * a),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM d)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM o JOIN n USING (lang) WHERE rank <= 2000"""


@register("op11_debruijn_collocations", ORACLE)
def op11_debruijn_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two and three words of every lang."""
    prepare(spark)
    return collocations(table(spark, sf_dir, "documents"))
