"""Mixing sources to target weights.

Each source gets a word budget by its weight. Its documents stand in the order
of a hash-random key; a distributed prefix sum of their sizes finds where the
budget ends. Whole epochs come first (every document once), then the documents
before the cut, and the document on the cut gives just the words that are left,
so each source's taken words equal its target (rounded down).

No task holds a source: its keys are uniform, so the top bits of the key cut it
into buckets of about ``bucket_rows`` rows; the window runs inside a bucket and
one row per bucket carries the sums across. What is learnt per source (one row
each) then decides every document where it lies, so texts are never shuffled.

Weights 5, 2, 1 repeat over the sources in code point order, null last. Targets
are filled like water: share = min(2 x source size, level x weight), the level
found by resharing what capped sources leave. A null text has size 0; a source
of size 0 gets target 0; rows equal in (source, id, size) stand on the same
place of the order and share what falls on it evenly; an empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table
from .registry import register

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of WORD matches: each becomes one mark, white space goes."""
    marks = F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x"), SPACE, "")
    return F.length(marks).cast("long")


def key_of(doc_id: Column) -> Column:
    """Hash-random key: 32 hex digits, uniform, the same in any engine."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def water_level(sources: DataFrame, share: float = SHARE, most: int = MOST) -> tuple[float, float]:
    """(level, total) with sum of min(most x size, level x weight) = share x
    total. Two sums over the sources table per step; the level only rises and a
    capped source stays capped, so the steps end (Newton on a concave line)."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, level, capped_before = share * total, 0.0, -1
    if not total:
        return 0.0, 0.0
    cap = F.col("source_size") * most
    while True:
        capped = (cap <= F.col("weight") * F.lit(level)) if level else (cap < 0)
        row = sources.agg(F.sum(F.when(capped, cap).otherwise(0)).alias("full"),
                          F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("open"),
                          F.sum(capped.cast("long")).alias("n")).first()
        if row["n"] == capped_before or not row["open"]:
            return level, float(total)
        level, capped_before = (budget - row["full"]) / row["open"], row["n"]


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: int = MOST) -> DataFrame:
    """source, source_size, n_rows, weight, target: one row per source."""
    by = materialise(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")))
    # ranks of the sources, not of rows: one row per source, summed before
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    by = materialise(by.withColumn("weight", pick.cast("long")))
    level, _ = water_level(by, share, most)
    target = F.least((F.col("source_size") * most).cast("double"), F.col("weight") * F.lit(float(level)))
    return by.withColumn("target", target)


def mix_plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None,
             bucket_rows: int = 2_000, **how) -> tuple[DataFrame, DataFrame]:
    """(sizes, plan). sizes: source, doc_id, size per document. plan: one row
    per source with its target, whole ``epochs`` and the cut: every document
    with (cut_key, cut_id, cut_size) below the cut is taken once more, the
    ``cut_rows`` rows on it give ``cut_words`` words in all."""
    sized = materialise(docs.select(F.col(f"`{source_col}`").alias("source"), F.col(f"`{id_col}`").alias("doc_id"),
                                    (word_count(F.col("`text`")) if size is None else size).alias("size")))
    targets = source_targets(sized, **how)
    rest = F.floor("target") - F.col("source_size") * F.col("epochs")
    targets = (targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size")))
                                  .otherwise(0).cast("long")).withColumn("rest", rest.cast("long")))
    per_source = targets.select(F.col("source").alias("s"), F.greatest(F.lit(1), F.ceil(F.col("n_rows") / bucket_rows)).alias("parts"), "rest")
    spread = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    at = (sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("m"))
          .withColumn("key", key_of(F.col("doc_id")))
          .join(per_source, F.col("source").eqNullSafe(F.col("s"))).drop("s")
          .withColumn("bucket", F.shiftright(spread * F.col("parts"), 32)).withColumn("words", F.col("size") * F.col("m")))
    at = materialise(at)
    order = ["key", "doc_id", "size"]
    sums = at.groupBy("source", "bucket").agg(F.sum("words").alias("all"), F.first("rest").alias("rest"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # the one bucket of each source in which the budget ends; one row per ``bucket_rows`` documents is ranked
    cut = (sums.withColumn("start", F.coalesce(F.sum("all").over(before), F.lit(0)))
           .where((F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col("all")))
           .select(F.col("source").alias("s"), F.col("bucket").alias("k"), "start"))
    inside = (at.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("k"))).drop("s", "k")
              .withColumn("start", F.col("start") + F.sum("words").over(
                  Window.partitionBy("source", "bucket").orderBy(*order)) - F.col("words"))
              .where((F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col("words"))))
    cuts = inside.select(F.col("source").alias("s"), F.col("key").alias("cut_key"), F.col("doc_id").alias("cut_id"),
                         F.col("size").alias("cut_size"), F.col("m").alias("cut_rows"),
                         (F.col("rest") - F.col("start")).alias("cut_words"))
    plan = materialise(targets.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "rest"))
    return sized, plan


def with_plan(rows: DataFrame, plan: DataFrame, max_sources: int = 200_000) -> DataFrame:
    """Each row with the plan of its source and ``extra``, the words taken
    beyond whole epochs. The plan has one row per source, counted when it was
    written; it is broadcast up to ``max_sources`` rows (of some 100 bytes) and
    joined by a shuffle beyond."""
    side = plan.withColumnRenamed("source", "__source")
    if plan.count() <= max_sources:
        side = F.broadcast(side)
    got = rows.join(side, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    key, i, n = key_of(F.col("doc_id")), F.col("doc_id"), F.col("size")
    same = (key == F.col("cut_key")) & i.eqNullSafe(F.col("cut_id"))
    # the md5 settles the order but for equal ids, whose sizes may differ
    below = (key < F.col("cut_key")) | (same & (n < F.col("cut_size")))
    extra = F.when(F.col("cut_key").isNull(), 0).when(below, n).when(
        same & (n == F.col("cut_size")), F.floor(F.col("cut_words") / F.col("cut_rows"))).otherwise(0)
    return got.withColumn("extra", extra.cast("long"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    ends = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
    return F.array_join(F.slice(F.split(text, ends), F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix as rows of ``docs``: a document stands once per whole epoch, once
    more if it is before its source's cut, and with its first words if it is
    on the cut. A document of size 0 stands once."""
    sized = docs.withColumn("__size", word_count(F.col("`text`")))
    _, plan = mix_plan(docs, **how)
    cols = docs.columns
    side = sized.select(F.col("`doc_id`").alias("doc_id"), F.col("`source`").alias("source"), F.col("__size").alias("size"),
                        F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"))
    got = with_plan(side, plan)
    whole = F.greatest(F.col("epochs").cast("int"), F.lit(0))
    times = F.when(F.col("size") == 0, F.array(F.lit(-1))).otherwise(
        F.concat(F.array_repeat(F.lit(-1), whole), F.when(F.col("extra") == F.col("size"), F.array(F.lit(-1)))
                 .when(F.col("extra") > 0, F.array(F.col("extra").cast("int"))).otherwise(F.array().cast("array<int>"))))
    got = got.select("__row", F.explode(times).alias("__words"))
    text = F.when(F.col("__words") < 0, F.col("__row")["text"]).otherwise(first_words(F.col("__row")["text"], F.col("__words")))
    return got.select(*[(text if c == "text" else F.length(text).cast("long") if c == "n_chars" else F.col("__row")[c]).alias(c)
                        for c in cols])


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
        WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
r AS (SELECT *, 2.0 * source_size / weight AS ratio FROM w),
l AS (SELECT *, (1.5 * (SELECT sum(source_size) FROM s)::DOUBLE
          - coalesce(sum(2 * source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / (sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM r),
v AS (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(2.0 * source_size, weight * (SELECT level FROM v))::DOUBLE AS target FROM w),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target) / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, floor(e.target)::BIGINT - e.epochs * e.source_size AS rest,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id, d.size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - start)))::BIGINT AS taken FROM p"""


@register("op2_source_mix", ORACLE)
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with what the mix takes of each."""
    sized, plan = mix_plan(table(spark, sf_dir, "documents"))
    return with_plan(sized, plan).select("doc_id", "size", "source_size", "target",
                                         (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken"))
