"""Best-fit packing by minimum bin slack.

Documents become token ids and an end id; longer ones are cut into pieces of
the capacity, the first taking what is over. What is left to pack is a
multiset of lengths below the capacity, so the search runs on its histogram
(capacity - 1 counts at most, whatever the corpus). Per bin, a subset-sum
dynamic programme over the lengths still available, held as the bits of one
integer, finds the fullest feasible combination that holds the longest length
left; the combination is removed as many times as the counts allow. A step
leaves less than half of at least one count (a remainder), so there are at most
capacity x log2(pieces) steps.

Every length then owns a row of places (pattern, copy, offset), and the k-th
piece of a length takes its k-th place: pieces are ranked by a range-sorted
global row number, a length that a third of all pieces share included, and the
place follows from an equi-join on blocks of ranks.

A null or empty text is just the end id (length 1). Rows with equal ids are
packed like others; null ids sort first; an empty table gives no rows; other
columns are left alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import global_row_number, materialise, prepare, table
from .registry import register

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k.json"
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Characters on which both forms of the vocabulary split alike: printable ASCII, Latin letters, tab and line ends.
PLAIN = r"[\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ]*"


class Encoder:
    """Token ids as little-endian 32-bit bytes, ``encode(text)``.

    For texts of PLAIN characters the ids come from the same vocabulary in its
    rank form, which is several times faster and splits and merges alike there
    (tested); any other text goes to the tokenizer. With ``added`` so does a
    text that holds an added token of the vocabulary, which then is that one
    token, as the tokenizer gives it by default; without, strings that look like
    added tokens are ordinary text in both.
    """

    def __init__(self, vocabulary: str, added: bool = False):
        import base64
        import json

        import public_tokenizers
        import regex
        import tiktoken
        self.path = public_tokenizers.path(vocabulary)
        with open(public_tokenizers.path(vocabulary.rsplit(".", 1)[0] + ".tiktoken"), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.plain, self.tokenizer, self.added = regex.compile(PLAIN), None, ()
        if added:
            with open(self.path, encoding="utf-8") as f:
                self.added = tuple(t["content"] for t in json.load(f)["added_tokens"])

    def whole(self, text: str) -> bytes:
        if self.tokenizer is None:
            from tokenizers import Tokenizer
            self.tokenizer = Tokenizer.from_file(self.path)
            if not self.added:
                self.tokenizer.encode_special_tokens = True
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.plain.fullmatch(text) and not any(t in text for t in self.added):
            return self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        return self.whole(text)


@lru_cache(maxsize=4)
def encoder(vocabulary: str, added: bool = False) -> Encoder:
    """One encoder per worker process, vocabulary and treatment of added tokens."""
    return Encoder(vocabulary, added)


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, bytes]]:
    """(piece, start, ids) of one document; the first piece may be shorter."""
    n, at, k = len(ids) // 4, 0, 0
    end = (n - 1) % capacity + 1
    while at < n:
        yield k, at, ids[4 * at:4 * end]
        at, end, k = end, end + capacity, k + 1


def tokenize(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = 0,
             id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, added: bool = False) -> DataFrame:
    """Pieces of every document; ``with_ids`` adds their ids (32-bit, binary),
    ``added`` gives added tokens of the vocabulary their own ids (op10 and the
    pipeline do).
    ``vocabulary`` is a file that the workers' tokenizer package names, beside
    which the same vocabulary lies as ranks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(vocabulary, added).encode, end_id.to_bytes(4, "little")
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                for k, at, ids in cut(encode(text) + end, capacity):
                    out.append((doc_id, k, at, len(ids) // 4, zlib.crc32(ids), *([ids] if with_ids else [])))
            got = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)
            yield got.astype({"doc_id": "Int64"})

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return rows.mapInPandas(run, SCHEMA + (", ids binary" if with_ids else ""))


def fullest(lengths: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination that holds the longest length: a subset-sum
    programme over bits (bit s is set when some combination sums to s)."""
    longest = max(lengths)
    room = capacity - longest
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for size in sorted(lengths, reverse=True):
        if reach >> room & 1:
            break
        if size > room:
            continue
        left = min(lengths[size] - (size == longest), room // size)
        many = 1
        while left > 0:  # counts in powers of two: each is one shift of all sums
            n = min(many, left)
            steps.append((size, n, reach))
            reach = (reach | reach << (size * n)) & mask
            left, many = left - n, many * 2
    total = reach.bit_length() - 1
    used = {longest: 1}
    for size, n, earlier in reversed(steps):
        if not earlier >> total & 1:
            used[size] = used.get(size, 0) + n
            total -= size * n
    return used


def minimum_slack_patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """[(combination, copies)] that use every length up, at most log2 of its
    count steps for each length."""
    left, out = {k: v for k, v in counts.items() if v > 0}, []
    while left:
        used = fullest(left, capacity)
        copies = min(left[k] // n for k, n in used.items())
        out.append((used, copies))
        for k, n in used.items():
            left[k] -= n * copies
            if not left[k]:
                del left[k]
    return out


def places(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, number of ranks, first sequence, places a copy,
    first offset): ranks first .. first + number - 1 of a length fill, place
    after place, the copies of one pattern."""
    given: dict[int, int] = {}
    out, first_sequence = [], 0
    for used, copies in patterns:
        offset = 0
        for length in sorted(used, reverse=True):
            n = used[length]
            out.append((length, given.get(length, 0), n * copies, first_sequence, n, offset))
            given[length] = given.get(length, 0) + n * copies
            offset += length * n
        first_sequence += copies
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32 ...) with
    sequence_id and offset."""
    spark = pieces.sparkSession
    numbered = global_row_number(pieces, ["length", "doc_id", "piece", "ids_crc32"], "__row")
    # at most ``capacity`` rows reach the driver: one count per length
    counts = {r["length"]: r["count"] for r in numbered.groupBy("length").count().collect()}
    starts, at = [], 0
    for length in sorted(counts):
        starts.append((length, at))
        at += counts[length]
    plan = places(minimum_slack_patterns(counts, capacity))
    # at most capacity x log2(pieces) patterns (a step halves a count), in practice about one per length
    by_length: dict[int, list] = {}
    for length, first, n, sequence, each, offset in plan:
        by_length.setdefault(length, []).append((first, n, sequence, each, offset))
    rows = [(length, start, [x[0] for x in by_length[length]],
             [(int(a), int(s), int(e), int(o)) for a, _, s, e, o in by_length[length]]) for length, start in starts]
    side = spark.createDataFrame(rows, "__length long, __start long, __firsts array<long>, "
                                 "__places array<struct<a:long,s:long,e:long,o:long>>")
    got = numbered.join(F.broadcast(side), F.col("length") == F.col("__length"))
    rank = F.col("__row") - F.col("__start")
    # the last place list that starts at or before the rank: a binary search in the sorted array of firsts
    got = got.withColumn("__rank", rank).withColumn("__p", find_place(max(map(len, by_length.values()), default=1)))
    inner = F.col("__rank") - F.col("__p")["a"]
    each = F.col("__p")["e"]
    return got.withColumn("sequence_id", F.col("__p")["s"] + F.call_function("div", inner, each)) \
              .withColumn("offset", F.col("__p")["o"] + inner % each * F.col("length")) \
              .drop("__row", "__length", "__start", "__firsts", "__places", "__rank", "__p")


def find_place(most: int):
    """Binary search as a fold over the powers of two below ``most``."""
    step = F.array(*[F.lit(1 << k) for k in range(most.bit_length(), -1, -1)])
    at = F.reduce(step, F.lit(0), lambda acc, s: F.when(
        (acc + s < F.size("__firsts")) & (F.try_element_at(F.col("__firsts"), (acc + s + 1)) <= F.col("__rank")), acc + s)
        .otherwise(acc))
    return F.element_at(F.col("__places"), at + 1)


def sequences(docs: DataFrame, capacity: int = CAPACITY, **how) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (32-bit, binary).
    A sequence has at most ``capacity`` pieces, so a group is bounded."""
    packed = pack(materialise(tokenize(docs, capacity, with_ids=True, **how)), capacity)
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.reduce("parts", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"))


@register("op10_min_bin_slack")
def op10_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    prepare(spark)
    return pack(materialise(tokenize(table(spark, sf_dir, "documents"), added=True)))
