"""Document fingerprints by I-Match with randomised lexicons.

Terms are the distinct runs of letters and digits of a text in lower case, as
64-bit hashes. The lexicon holds the terms whose inverse document frequency lies
in a band: in at most ``1 / most``, at least ``1 / least`` of all documents. A
document keeps its terms of the lexicon, sorted, and hashes those that fall in
each of several random sub-lexicons: for every one of SEEDS hash functions, all
terms, about half of them, a quarter and so on (SCALES levels, each inside the
one before). A fingerprint is the number of terms and the 16-bit hashes.

A sub-lexicon that takes a share p of all terms gives two texts the same hash
with probability (1 - p)^d when d terms tell them apart. The number of levels at
which hashes differ therefore grows with log2(d), d is read off it, and with
the two numbers of terms it gives their likeness |A and B| / |A or B|. Texts
without terms of the lexicon have a hash of the whole text instead and are like
equal texts only.

The lexicon is broadcast if it has at most BROADCAST_TERMS rows, by count, and
joined by a shuffle beyond. Its size is bounded without regard to the number of
documents: a term of it is in 1 / ``least`` of them, so there are at most
``least`` x (mean distinct terms of a document).

The order of documents for the next one is doc_id descending, nulls last, then
by hash of the text. Buckets of the id axis hold neighbours; the first row of a
bucket also visits the bucket before, so texts are shuffled once. A null text is
empty; texts of any length are read whole; equal rows are neighbours and get
equal results; a single row is its own next; an empty table gives no rows; other
columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.buckets import fit_depth_buckets
from .common import materialise, prepare, table
from .registry import register

MOST, LEAST = 2, 5000
SEEDS, SCALES = 8, 16
BUCKET = 1000
NULL_BUCKETS = 64
BROADCAST_TERMS = 4_000_000
#: Expected levels that tell d texts apart: log2(d) + SHIFT, for all but the smallest d.
SHIFT = 0.3327
#: Documents whose term lists a task may hold at once before it sorts instead.
HELD = 4096


def terms(text: str | Column) -> Column:
    """Hashes of the distinct terms of a text."""
    c = F.col(text) if isinstance(text, str) else text
    words = F.array_remove(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text_col: str = "text", most: int = MOST, least: int = LEAST) -> DataFrame:
    """term: the hashes whose document frequency lies in the band."""
    held = docs.select(F.explode(terms(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))).alias("term"))
    n = docs.count()
    counted = held.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return materialise(counted.where((F.col("df") * least >= n) & (F.col("df") * most <= n)).select("term"))


def sub_hashes(kept: Column) -> Column:
    """Hashes of the sorted terms in every sub-lexicon: SCALES numbers a seed,
    from all terms to a share of 2^(1 - SCALES)."""
    def of_seed(seed: int) -> Column:
        drawn = F.transform(kept, lambda t: F.xxhash64(F.lit(seed), t))
        start = F.struct(drawn.alias("rest"), F.array().cast("array<long>").alias("out"))
        level = lambda acc, mask: F.struct(
            F.filter(acc["rest"], lambda t: t.bitwiseAND(mask) == 0).alias("rest"),
            F.concat(acc["out"], F.array(F.xxhash64(acc["rest"]).bitwiseAND(F.lit(65535)))).alias("out"))
        return F.aggregate(F.lit([(1 << s) - 1 for s in range(1, SCALES + 1)]).cast("array<long>"), start, level, lambda acc: acc["out"])
    return F.concat(*[of_seed(s) for s in range(SEEDS)])


def written(n_terms: Column, hashes: Column, text_hash: Column) -> Column:
    """The fingerprint as a string: number of terms, then four hexadecimal
    digits a hash; of a text without terms the hash of the text."""
    digits = F.concat_ws("", F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 4, "0"))))
    return F.when(n_terms > 0, F.concat_ws(":", n_terms.cast("string"), digits)).otherwise(F.concat_ws(":", F.lit("0"), F.lower(F.hex(text_hash))))


def likeness(n: Column, a: Column, m: Column, b: Column, same: Column) -> Column:
    """Estimated share of common terms of two fingerprints (numbers of terms n
    and m, hashes a and b; ``same``: the strings are equal)."""
    differ = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 0).otherwise(1)), F.lit(0), lambda acc, x: acc + x)
    # each seed's first hash is of all terms and differs unless the sets are equal
    levels = differ / F.lit(float(SEEDS)) - 1
    apart = F.greatest(F.pow(F.lit(2.0), levels - SHIFT) - 0.5, F.lit(1.0), F.abs(n - m).cast("double"))
    both = (n + m).cast("double")
    return F.when(same, 1.0).when((n == 0) | (m == 0), 0.0).otherwise(F.greatest((both - apart) / (both + apart), F.lit(0.0)))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """bucket, place, visiting, doc_id, text, next: every row with the next
    one's text in the order of the module, ``place`` counting in its bucket;
    rows that only visit a bucket as its last ones are marked."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    cuts = fit_depth_buckets(rows.select("doc_id"), "doc_id", BUCKET)
    # descending ids give ascending buckets; null ids follow, in order of their hash
    of_null = F.shiftright("h", 64 - (NULL_BUCKETS.bit_length() - 1)).cast("int") + NULL_BUCKETS // 2 + 1
    bucket = F.when(F.col("doc_id").isNull(), of_null).otherwise(-cuts.id_of(F.col("doc_id")))
    # a row per bucket: at most 65,536 ids and 64 buckets of nulls
    first = rows.select("doc_id", "h").withColumn("b", bucket).groupBy("b").agg(
        F.max(F.struct("doc_id", F.bitwise_not("h").alias("turned"))).alias("f"))
    by_bucket = Window.orderBy("b")
    last = F.max("b").over(by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    first = first.select("b", F.col("f.doc_id").alias("__id"), F.bitwise_not("f.turned").alias("__h"),
                         F.coalesce(F.lag("b").over(by_bucket), last).alias("before"))
    first = materialise(first)
    dealt = rows.withColumn("own", bucket).join(
        F.broadcast(first), (F.col("own") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")), "left")
    seats = F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("visiting")))
    visits = F.array(F.struct(F.col("before").alias("bucket"), F.lit(True).alias("visiting")))
    dealt = dealt.select("doc_id", "text", "h", F.inline(F.when(F.col("before").isNull(), seats).otherwise(F.concat(seats, visits))))
    order = Window.partitionBy("bucket").orderBy("visiting", F.desc_nulls_last("doc_id"), "h", "text")
    return dealt.select("bucket", F.row_number().over(order).alias("place"), "visiting", "doc_id", "text", F.lead("text").over(order).alias("next"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST, least: int = LEAST) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next per row of ``docs``. The edited text has the last
    third of its characters (rounded down) replaced by the first as many, or
    all, of the next document's."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(HELD))
    lex = lexicon(docs, text_col, most, least)
    small = lex.count() <= BROADCAST_TERMS
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - third), F.substr(F.coalesce("next", F.lit("")), F.lit(1), third))
    rows = with_next(docs, id_col, text_col).select("bucket", "place", "visiting", "doc_id", "text", edited.alias("edited"))
    rows = rows.select("bucket", "place", "visiting", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("sha"),
                       F.xxhash64("text").alias("h"), F.xxhash64("edited").alias("e"), terms("text").alias("own"), terms("edited").alias("new"))
    # a row per term of either text (1: own, 2: edited, 3: both) and one for the document itself, which no lexicon rules out
    info = F.struct("visiting", "doc_id", "n_chars", "sha", "h", "e")
    none = F.lit(None).cast(rows.select(info.alias("i")).schema["i"].dataType)
    tagged = lambda c, tag: F.transform(c, lambda t: F.struct(t.alias("term"), F.lit(tag).alias("tag"), none.alias("info")))
    each = F.concat(F.array(F.struct(F.lit(0).cast("long").alias("term"), F.lit(0).alias("tag"), info.alias("info"))),
                    tagged(F.array_intersect("own", "new"), 3), tagged(F.array_except("own", "new"), 1), tagged(F.array_except("new", "own"), 2))
    spread = rows.select("bucket", "place", F.inline(each))
    marked = lex.unionAll(spark.range(1).select(F.lit(0).cast("long").alias("term")))
    kept = spread.join(F.broadcast(marked) if small else marked, "term", "left_semi")
    has = lambda tag: F.sort_array(F.collect_list(F.when(F.col("tag").bitwiseAND(F.lit(tag)) > 0, F.col("term"))))
    grouped = kept.groupBy("bucket", "place").agg(has(1).alias("own"), has(2).alias("new"), F.first("info", ignorenulls=True).alias("i"))
    hashed = grouped.select("bucket", "place", "i.*", F.size("own").alias("n"), sub_hashes(F.col("own")).alias("a"),
                            F.size("new").alias("m"), sub_hashes(F.col("new")).alias("b"))
    hashed = hashed.withColumn("fingerprint", written(F.col("n"), F.col("a"), F.col("h"))).withColumn(
        "edited_fingerprint", written(F.col("m"), F.col("b"), F.col("e")))
    order = Window.partitionBy("bucket").orderBy("place")
    after = lambda c: F.lead(c).over(order)
    hashed = hashed.select("*", after("n").alias("n2"), after("a").alias("a2"), after("fingerprint").alias("fingerprint2")).where(~F.col("visiting"))
    near_edited = likeness(F.col("n"), F.col("a"), F.col("m"), F.col("b"), F.col("fingerprint") == F.col("edited_fingerprint"))
    near_next = likeness(F.col("n"), F.col("a"), F.col("n2"), F.col("a2"), F.col("fingerprint") == F.col("fingerprint2"))
    return hashed.select("doc_id", "n_chars", F.col("sha").alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                         near_edited.alias("near_edited"), near_next.alias("near_next"))


@register("op12_imatch_fingerprints")
def op12_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    prepare(spark)
    return fingerprints(table(spark, sf_dir, "documents"))
