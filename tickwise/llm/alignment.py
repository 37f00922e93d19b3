"""Alignment of two tokenizers' tokens, with corpus-wide link counts.

A text is cut by a byte-level vocabulary A (a space is put before the text) and
by a piece vocabulary B (which puts that space itself). Offsets at which tokens
of both end cut the two sequences into groups; every A token of a group is
linked to every B token of it. Where A's and B's cuts agree, a group is one A
token and the B token of the same bytes: an array from A id to that B id, made
once from the two vocabularies, names the pair, so such links are counted in
vectors as long as A's vocabulary, one per task. Only the pairs of other groups
become rows, one per document and distinct pair, and enter a shuffle.

Counts (documents that hold a pair linked) come back to the documents the same
way: the vectors are broadcast (their length is the vocabulary's), pairs are
joined. A pair that at least one document in ``1 / SHARE`` holds may own a
large part of the rows; there are at most (mean pairs of a document) / SHARE of
these, so they are broadcast, and the rest, with few rows each, are joined by a
shuffle.

Texts are cut at single spaces between plain characters into units (a space and
what follows it) before they are tokenised. No token of A or B reaches over such
a place (A's pattern begins a token there, and no piece of B has a space after
another character, which is checked), so the distinct units of some hundred texts
are tokenised and aligned together, once each, and the texts put together from
them.

Texts that are null or empty, or that either tokenizer doesn't give back byte
for byte, have no tokens: zeros and an empty digest. Strings of special tokens
are plain text. Long texts are cut whole. Ids may be null or repeat (rows are
told apart by a row number); an empty table gives no rows; other columns are
left alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, prepare, table
from .packing import encoder
from .registry import register

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
SHARE = 1e-3
#: Characters of text whose units are aligned together.
CHUNK = 1 << 23
STRING = 200
#: A single space between characters that both vocabularies take for plain ones.
PLAIN = r"[!-~\xa1-\xac\xae-\u024f]"
PLACE = re.compile(f"(?<={PLAIN}) (?={PLAIN})")
BETWEEN = re.compile(f"{PLAIN}(.*{PLAIN})?", re.S)
#: Groups whose pairs are more than this are counted by distinct ids instead of being listed.
LISTED = 4096

SCHEMA = ("row_id long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "same_a array<int>, same_n array<long>, a array<int>, b array<int>, n array<long>")


def byte_letters() -> dict[str, int]:
    """Letter to byte of byte-level vocabularies: printable Latin-1 bytes stand
    for themselves, the others are numbered from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def bytes_of_a(path: str) -> list[bytes]:
    import json
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    letters = byte_letters()
    entries = whole["model"]["vocab"]
    plain = {t["content"] for t in whole["added_tokens"]}
    out = [b""] * (max([*entries.values(), *(t["id"] for t in whole["added_tokens"])]) + 1)
    for entry, i in entries.items():
        out[i] = entry.encode() if entry in plain else bytes(letters[c] for c in entry)
    return out


def bytes_of_b(pieces) -> list[bytes]:
    return [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, pieces.id_to_piece(i)) for i in range(pieces.get_piece_size()))]


class Aligner:
    """Both tokenizers, their tokens' bytes and the array of same-bytes ids."""

    def __init__(self, vocabulary_a: str, vocabulary_b: str):
        import public_tokenizers
        import sentencepiece
        self.encode_a = encoder(vocabulary_a).encode
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary_b))
        self.bytes_a, self.bytes_b = bytes_of_a(public_tokenizers.path(vocabulary_a)), bytes_of_b(self.pieces)
        self.size_a, self.size_b = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (self.bytes_a, self.bytes_b))
        # a piece wins over the byte token of the same byte, which is only the fallback
        first = {x: i for i, x in sorted(enumerate(self.bytes_b), key=lambda e: not self.pieces.is_byte(e[0])) if x}
        self.same = np.fromiter((first.get(x, -1) for x in self.bytes_a), dtype=np.int64, count=len(self.bytes_a))
        # whether units may be cut out: no piece goes on with a space
        self.apart = not any("▁" in self.pieces.id_to_piece(i).lstrip("▁") for i in range(len(self.bytes_b)))
        # an id with the sign behind it: another of its group, the end of A's part, the end of the group
        self.more_a, self.last_a = (np.array([f"{i}{s}" for i in range(len(self.bytes_a))], dtype=object) for s in ",|")
        self.more_b, self.last_b = (np.array([f"{i}{s}" for i in range(len(self.bytes_b))], dtype=object) for s in ",;")

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group number of each A and B token; bytes at which groups end."""
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        is_end = np.zeros(ends_a[-1] + 1, dtype=bool)
        is_end[ends_a] = True
        cuts = ends_b[is_end[ends_b]]
        return np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), cuts

    def written(self, a, b, of_a, of_b, n_a, n_b) -> list[str]:
        """Tokens group by group, A's and then B's, each with the sign behind it."""
        out = np.empty(len(a) + len(b), dtype=object)
        before_b, upto_a = np.cumsum(n_b) - n_b, np.cumsum(n_a)
        end_a, end_b = (np.append(g[1:] != g[:-1], True) for g in (of_a, of_b))
        out[np.arange(len(a)) + before_b[of_a]] = np.where(end_a, self.last_a[a], self.more_a[a])
        out[np.arange(len(b)) + upto_a[of_b]] = np.where(end_b, self.last_b[b], self.more_b[b])
        return out.tolist()

    def pairs(self, a, b, of_a, of_b, n_a, n_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group, ``A << 32 | B``, links); a pair may come in several rows."""
        single = (n_a == 1) & (n_b == 1)
        at_a = single[of_a]
        # groups of more tokens: all pairs, or those of distinct ids where they are many
        listed = ~single & (n_a * n_b <= LISTED)
        in_a, first_b = listed[of_a], np.cumsum(n_b) - n_b
        times = n_b[of_a[in_a]]
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first_b[of_a[in_a]], times)
        group = [of_a[at_a], np.repeat(of_a[in_a], times)]
        keys = [a[at_a] << 32 | b[single[of_b]], np.repeat(a[in_a], times) << 32 | b[at]]
        links = [np.ones(len(k), dtype=np.int64) for k in keys]
        for g in np.flatnonzero(~single & ~listed):
            (x, nx), (y, ny) = (np.unique(t[slice(*np.searchsorted(o, [g, g + 1]))], return_counts=True) for t, o in ((a, of_a), (b, of_b)))
            keys.append((x[:, None] << 32 | y).ravel())
            links.append((nx[:, None] * ny).ravel())
            group.append(np.full(len(keys[-1]), g))
        return np.concatenate(group), np.concatenate(keys), np.concatenate(links)

    def units(self, units: list[str]) -> "Units":
        """The units aligned: those with plain ends many to a text, as if they
        stood in it; the others one by one. Each is looked at by itself if their
        bytes don't come back together (a literal U+2581, say)."""
        raw = "".join(" " + u for u in units).encode()
        plain = next((k for k, u in enumerate(units) if not BETWEEN.fullmatch(u)), len(units))
        texts = [" ".join(units[k:min(k + STRING, plain)]) for k in range(0, plain, STRING)] + units[plain:]
        a = np.frombuffer(b"".join(self.encode_a(" " + t) for t in texts), dtype="<u4").astype(np.int64)
        b = [i for ids in self.pieces.encode(texts, num_threads=1) for i in ids]
        if not b"".join(map(self.bytes_a.__getitem__, a.tolist())) == raw == b"".join(map(self.bytes_b.__getitem__, b)):
            if len(units) > 1:
                half = len(units) // 2
                return self.units(units[:half]).joined(self.units(units[half:]))
            none = np.empty(0, dtype=np.int64)
            return Units([""], np.zeros((1, 4), dtype=np.int64), none, none, none)
        b = np.asarray(b, dtype=np.int64)
        of_a, of_b, cuts = self.groups(a, b)
        n_a, n_b = (np.bincount(g, minlength=len(cuts)) for g in (of_a, of_b))
        ends = np.cumsum([len(u.encode()) + 1 for u in units])
        unit = np.searchsorted(ends, cuts)
        figures = np.column_stack([np.bincount(unit, weights=x, minlength=len(units)) for x in (n_a, n_b, np.ones(len(cuts)), n_a * n_b)]).astype(np.int64)
        parts, upto = self.written(a, b, of_a, of_b, n_a, n_b), np.cumsum(figures[:, 0] + figures[:, 1])
        texts = ["".join(parts[i:j]) for i, j in zip([0, *upto[:-1].tolist()], upto.tolist())]
        group, keys, links = self.pairs(a, b, of_a, of_b, n_a, n_b)
        return Units(texts, figures, unit[group], keys, links)

    def align(self, texts: list[str]) -> Iterator[tuple]:
        """SCHEMA from n_a on for each text."""
        index: dict[str, int] = {}
        number = index.setdefault
        cut = [[number(u, len(index)) for u in (PLACE.split(t) if self.apart else [t])] if t else [] for t in texts]
        # units with plain ends first
        order = sorted(index, key=lambda u: not BETWEEN.fullmatch(u))
        place = np.zeros(len(index), dtype=np.int64)
        place[[index[u] for u in order]] = np.arange(len(order))
        known = self.units(order).sorted() if order else None
        for c in cut:
            which = place[c]
            if not len(which) or not known.figures[which, 0].all():
                yield 0, 0, 0, 0, "", [], [], [], [], []
                continue
            digest = hashlib.sha256("".join([known.texts[i] for i in which.tolist()])[:-1].encode()).hexdigest()
            keys, n = summed(*known.pairs_of(which))
            x, y = keys >> 32, keys & 0xFFFFFFFF
            same = self.same[x] == y
            yield *known.figures[which].sum(axis=0).tolist(), digest, x[same], n[same], x[~same], y[~same], n[~same]


class Units:
    """Units with their digest texts (each ends in a sign), figures (n_a, n_b,
    n_groups, n_links; n_a 0: bytes don't come back) and pairs (unit, key, links)."""

    def __init__(self, texts: list[str], figures: np.ndarray, unit: np.ndarray, keys: np.ndarray, links: np.ndarray):
        self.texts, self.figures, self.unit, self.keys, self.links = texts, figures, unit, keys, links

    def joined(self, other: "Units") -> "Units":
        return Units(self.texts + other.texts, np.concatenate([self.figures, other.figures]),
                     np.concatenate([self.unit, other.unit + len(self.texts)]), np.concatenate([self.keys, other.keys]),
                     np.concatenate([self.links, other.links]))

    def sorted(self) -> "Units":
        """Pairs in the order of their units, ``start`` and ``size`` of each unit's."""
        order = np.argsort(self.unit, kind="stable")
        self.unit, self.keys, self.links = self.unit[order], self.keys[order], self.links[order]
        self.size = np.bincount(self.unit, minlength=len(self.texts))
        self.start = np.cumsum(self.size) - self.size
        return self

    def pairs_of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[which]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.start[which], size)
        return self.keys[at], self.links[at]


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of n."""
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    return keys[first], np.add.reduceat(n, first) if len(first) else n


@lru_cache(maxsize=2)
def aligner(vocabulary_a: str, vocabulary_b: str) -> Aligner:
    """One per worker process and pair of vocabularies."""
    return Aligner(vocabulary_a, vocabulary_b)


def linked(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document (SCHEMA): its figures, links to same-bytes ids
    (``same_a``, ``same_n``) and its other distinct pairs (``a``, ``b``, ``n``)."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = aligner(vocabulary_a, vocabulary_b)
        held: list[pd.DataFrame] = []

        def done() -> Iterator[pd.DataFrame]:
            figures = tool.align([t for pdf in held for t in pdf["text"]])
            for pdf in held:
                out = [(row, doc_id, *next(figures)) for row, doc_id in zip(pdf["row_id"], pdf["doc_id"])]
                yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

        for pdf in batches:
            held.append(pdf)
            if sum(int(p["text"].str.len().sum()) for p in held) >= CHUNK:
                yield from done()
                held.clear()
        if held:
            yield from done()

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return rows.mapInPandas(run, SCHEMA)


def same_counts(rows: DataFrame, vocabulary_a: str, vocabulary_b: str) -> np.ndarray:
    """Documents per A id that link it to its same-bytes id: every task adds up
    one vector as long as A's vocabulary, and sends its ids that occur."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(aligner(vocabulary_a, vocabulary_b).same), dtype=np.int64)
        for pdf in batches:
            if len(pdf):
                total += np.bincount(np.concatenate(pdf["same_a"].to_list()).astype(np.int64), minlength=len(total))
        ids = np.flatnonzero(total)
        yield pd.DataFrame({"a": ids, "docs": total[ids]})

    # at most one row per id of the vocabulary reaches the driver
    counted = rows.select("same_a").mapInPandas(run, "a int, docs long").groupBy("a").agg(F.sum("docs").alias("docs")).toPandas()
    out = np.zeros(len(aligner(vocabulary_a, vocabulary_b).same), dtype=np.int64)
    out[counted["a"]] = counted["docs"]
    return out


def pair_rows(rows: DataFrame) -> DataFrame:
    """row_id, a, b, n: a row per document and distinct pair of other bytes."""
    return rows.select("row_id", F.inline(F.arrays_zip("a", "b", "n")))


def pair_counts(rows: DataFrame) -> DataFrame:
    """a, b, docs of the pairs of other bytes."""
    return pair_rows(rows).groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs"))


def link_table(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B, **columns) -> DataFrame:
    """a, b, docs of every linked pair: the table that carries embeddings or
    statistics of one vocabulary over to the other."""
    rows = materialise(linked(docs, vocabulary_a, vocabulary_b, **columns))
    counts = same_counts(rows, vocabulary_a, vocabulary_b)
    same = aligner(vocabulary_a, vocabulary_b).same
    ids = np.flatnonzero(counts)
    known = docs.sparkSession.createDataFrame(pd.DataFrame({"a": ids, "b": same[ids], "docs": counts[ids]}), "a int, b int, docs long")
    return pair_counts(rows).unionAll(known)


def align(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per
    row of ``docs``. ``count_sum`` adds up, over the links, how many documents
    hold the link's pair; ``n_best`` counts the links whose pair no other pair
    of its A id exceeds in that."""
    spark = docs.sparkSession
    rows = materialise(linked(docs, vocabulary_a, vocabulary_b, id_col, text_col))
    counts = same_counts(rows, vocabulary_a, vocabulary_b)
    pairs = materialise(pair_counts(rows))
    # one row per A id at most
    most = pairs.groupBy("a").agg(F.max("docs").alias("docs")).toPandas()
    best = counts.copy()
    np.maximum.at(best, most["a"].to_numpy(dtype=np.int64), most["docs"].to_numpy(dtype=np.int64))
    told = spark.sparkContext.broadcast((counts, counts == best))

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs_of, is_best = told.value
        for pdf in batches:
            if not len(pdf):
                continue
            sizes = pdf["same_a"].map(len).to_numpy()
            a = np.concatenate(pdf["same_a"].to_list()).astype(np.int64)
            n = np.concatenate(pdf["same_n"].to_list()).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(sizes)])
            added = (np.concatenate([[0], np.cumsum(x)]) for x in (n * docs_of[a], n * is_best[a]))
            total, top = (s[at[1:]] - s[at[:-1]] for s in added)
            yield pd.DataFrame({"row_id": pdf["row_id"], "count_sum": total, "n_best": top})

    sums = rows.select("row_id", "same_a", "same_n").mapInPandas(own, "row_id long, count_sum long, n_best long")
    limits = spark.createDataFrame(pd.DataFrame({"a": np.arange(len(best)), "most": best}), "a int, most long")
    scored = materialise(pairs.join(F.broadcast(limits), "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).cast("long").alias("top")))
    # the bound on the broadcast: a document holds its pairs once, so at most (mean pairs) / SHARE pairs reach this count
    hot = F.broadcast(scored.where(F.col("docs") >= max(1.0, SHARE * rows.count())))
    cold = scored.where(F.col("docs") < max(1.0, SHARE * rows.count()))
    each = pair_rows(rows)
    back = each.join(hot, ["a", "b"]).unionByName(each.join(hot.select("a", "b"), ["a", "b"], "left_anti").join(cold, ["a", "b"]))
    sums = sums.unionAll(back.select("row_id", F.col("n") * F.col("docs"), F.col("n") * F.col("top")))
    sums = sums.groupBy("row_id").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    return rows.join(sums, "row_id").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@register("op13_identity_map_alignment")
def op13_identity_map_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the byte-level and the piece tokens of every document."""
    prepare(spark)
    return align(table(spark, sf_dir, "documents"))
