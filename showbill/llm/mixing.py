"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame operations only).

Targets come from weights by water filling. A schedule of slots follows: slot k has the golden-ratio point
frac(k * phi), which falls into one source's share of the unit interval; each source's slots are ranked. A source's
documents, in a shuffled order that is fixed by their ids, lie end to end on a line of words, twice over; slot number
r of a source takes the r-th block from that line. A source's blocks are as long as its slots (one at least) need to fill its target, so its words
are its target to a word, a block is near the mix's words per slot for every source, and every prefix of the schedule is mixed to the
weights within a few slots. No document is used more than twice, and a rerun gives the same mix.

All arithmetic of the schedule is on integers (points in units of 2^-32). Sums along the schedule and the lines are
taken in two levels, by buckets, so that a source with most of the rows is spread over many tasks. The only frame
without such a spread has one row per source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from showbill.llm.common import WORDS, running_sum, settle

#: 2^32 divided by the golden ratio, odd: the step of the golden-ratio sequence in 32-bit fixed point.
GOLDEN = 2654435769
UNIT = 1 << 32


def sized(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, source, the columns `more` and size (words of the text; 0 for null) of every row."""
    return docs.select("doc_id", "source", *more, F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORDS})"))).cast("long").alias("size"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: source, source_size, weight, target.

    Sources in code-point order, null last, take the weights in turn. They share `share` of all sizes by weight; no
    target exceeds `most` times its source's size, and what is over goes to the others by weight until none is above.
    That fixed point is target = min(most * size, level * weight): sorted by size / weight, the sources filled to
    their bound are a prefix. Sources of size 0 get 0.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("double"))
    everything = Window.partitionBy()
    poorest = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = poorest.rowsBetween(Window.unboundedPreceding, -1)
    after = poorest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(share)
    left = total - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(most)
    level = left / F.sum("weight").over(after)
    levels = weighed.withColumn("_level", level).withColumn("_free", F.col("_level") * F.col("weight") <= F.col("source_size") * F.lit(most))
    # The level that holds is the first at which the source, and so all after it, stays below its bound.
    first = F.min(F.when(F.col("_free"), F.struct(F.col("source_size") / F.col("weight"), F.col("_level"))))
    return levels.withColumn("_held", first.over(everything)["_level"]).select(
        "source", "source_size", "weight", F.least(F.col("source_size") * F.lit(most), F.coalesce(F.col("_held") * F.col("weight"), F.col("source_size") * F.lit(most))).alias("target")
    )


def schedule(spark, shares: DataFrame, slots: int, cells: int = 4096) -> DataFrame:
    """slot, source_no and rank (from 0, per source) of the golden-ratio schedule over `slots` slots.

    shares: source_no and its part [low, high) of the unit interval, in units of 2^-32. A slot finds its source by an
    equi-join on the cell of the interval that its point falls into; a source's part covers at most `cells` cells, so
    the joined side has no more rows than cells and sources together.
    """
    width = UNIT // cells
    covered = shares.where("high > low").select("source_no", "low", "high", F.explode(F.sequence(F.expr(f"low div {width}"), F.expr(f"(high - 1) div {width}"))).alias("cell"))
    points = spark.range(1, slots + 1).select(F.col("id").alias("slot"), F.expr(f"pmod(id * {GOLDEN}L, {UNIT}L)").alias("point"))
    placed = points.withColumn("cell", F.expr(f"point div {width}")).join(covered, "cell").where("point >= low and point < high").select("slot", "source_no")
    return running_sum(placed, "source_no", F.expr("slot div 4096"), [F.col("slot")], F.lit(1), "rank")


def mix(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, blocks: int = 4096, buckets: int = 256) -> DataFrame:
    """doc_id, size, source_size, target, taken, slots and any other columns for every row of sizes (doc_id, source, size).

    slots: where the row's first and second use begin in the schedule (an array of two; null where it isn't used).
    Columns of sizes named like one of these, or start, source_no or with a leading underscore, aren't allowed.

    blocks: slots per source, one word each at least, so the schedule's length depends on the number of sources and not on the rows. A
    source takes its target, rounded to a word, in blocks of one length, which its number of slots gives. Rows that repeat a doc_id are documents of their own
    on the source's line. Documents without words take 0. An empty table gives an empty result.
    """
    spark = sizes.sparkSession
    more = [c for c in sizes.columns if c not in ("doc_id", "source", "size")]
    sizes = settle(sizes)
    goals = targets(sizes, weights, share, most)
    cum = Window.orderBy(F.col("source").asc_nulls_last())
    goals = settle(goals.withColumn("source_no", F.row_number().over(cum) - 1))
    whole = goals.agg(F.sum("source_size").alias("size"), F.count("*").alias("sources")).first()
    words, slots_most = (whole["size"] or 0) * min(share, most), blocks * max(1, whole["sources"])
    block = max(1, -int(-words // slots_most))
    slots = int(round(words / block))
    upto = F.floor(F.sum("target").over(Window.orderBy("source_no")) * F.lit(UNIT / max(words, 1.0))).cast("long")
    shares = goals.withColumn("high", F.when(F.col("source_no") == F.lit(whole["sources"] - 1), F.lit(UNIT)).otherwise(upto))
    shares = shares.select("source_no", F.coalesce(F.lag("high").over(Window.orderBy("source_no")), F.lit(0)).alias("low"), "high")
    slots_of = settle(schedule(spark, shares, slots).groupBy("source_no", F.col("rank").alias("block")).agg(F.min("slot").alias("slot")))
    # An interval shorter than a slot may have none: such a source has the first slot beside the one that is there.
    ends = goals.where(F.round("target") > 0).select("source_no", F.round("target").cast("long").alias("end"))
    ends = settle(ends.join(slots_of.groupBy("source_no").agg(F.count("*").alias("n")), "source_no", "left").withColumn("length", F.ceil(F.col("end") / F.coalesce("n", F.lit(1))).cast("long")))
    slots_of = slots_of.unionByName(ends.where("n is null").select("source_no", F.lit(0).cast("long").alias("block"), F.lit(1).cast("long").alias("slot")))

    lined = sizes.join(goals, sizes["source"].eqNullSafe(goals["source"])).select("doc_id", "size", "source_no", "source_size", "target", *more)
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    order = [digest, F.col("doc_id"), F.col("size")]
    placed = running_sum(lined, "source_no", F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") % buckets, order, F.col("size"), "start").withColumn("_row", F.monotonically_increasing_id())
    placed = settle(placed)
    # Each document lies on its source's line twice; a piece is its part of one block.
    laid = placed.where("size > 0").select("_row", "source_no", "size", F.posexplode(F.array(F.col("start"), F.col("start") + F.col("source_size"))).alias("use", "at"))
    laid = laid.join(F.broadcast(ends.select("source_no", "end", "length")), "source_no").where(F.col("at") < F.col("end"))
    pieces = laid.select("_row", "use", "source_no", "at", "size", "end", "length", F.explode(F.sequence(F.expr("at div length"), F.expr("(at + size - 1) div length"))).alias("block"))
    upto = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * F.col("length"), F.col("end"))
    within = F.greatest(F.lit(0), upto - F.greatest(F.col("at"), F.col("block") * F.col("length")))
    met = pieces.withColumn("_within", within).where("_within > 0").join(slots_of, ["source_no", "block"])
    first = lambda use: F.min(F.when(F.col("use") == use, F.col("slot")))
    taken = met.groupBy("_row").agg(F.sum("_within").alias("taken"), F.array(first(0), first(1)).alias("slots"))
    return placed.join(taken, "_row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "slots", *more)


def report(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken and slot (where its first use begins in the schedule; null if it isn't used). Null texts have size 0; null sources are one source."""
    return mix(sized(docs)).withColumn("slot", F.col("slots")[0]).drop("slots")


def repeat(docs: DataFrame) -> DataFrame:
    """The rows of docs as often as the mix takes them, in the order of the schedule, with the columns of docs.

    A row is given round(taken / size) times, 0 to 2; only the one or two documents of a source that the end of its
    last block cuts are taken in part. So every beginning of the result is near the weights. Rows without words are taken 0 times. Rows that repeat a doc_id have counts of
    their own.
    """
    rows = settle(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.monotonically_increasing_id().alias("_place")))
    mixed = mix(sized(rows.select("_doc.doc_id", "_doc.source", "_doc.text", "_place"), "_place")).where("taken > 0")
    times = mixed.select("_place", "slots", F.round(F.col("taken") / F.col("size")).cast("int").alias("_times")).where("_times > 0")
    uses = times.select("_place", F.explode(F.slice("slots", 1, F.col("_times"))).alias("_slot"))
    return rows.join(uses, "_place").orderBy(F.col("_slot").asc_nulls_last(), "_place").select("_doc.*")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
src AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)),
weighed AS (SELECT *, CASE source_no % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM src),
levels AS (
  SELECT *, source_size / weight AS ratio,
    ((SELECT sum(source_size) FROM src) * 1.5::DOUBLE - coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2.0::DOUBLE)
    / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM weighed),
held AS (SELECT lvl FROM levels WHERE lvl * weight <= source_size * 2.0::DOUBLE ORDER BY ratio, lvl LIMIT 1),
goals AS (SELECT *, least(source_size * 2.0::DOUBLE, coalesce((SELECT lvl FROM held) * weight, source_size * 2.0::DOUBLE)) AS target FROM levels),
whole AS (SELECT coalesce(sum(source_size), 0) * 1.5::DOUBLE AS words, greatest(1, count(*)) AS sources FROM src),
blk AS (SELECT *, greatest(1, CAST(ceil(words / (4096 * sources)) AS BIGINT)) AS block FROM whole),
ends AS (
  SELECT source_no, CASE WHEN source_no = sources - 1 THEN 4294967296 ELSE
    CAST(floor(sum(target) OVER (ORDER BY source_no) * (4294967296 / greatest(words, 1.0::DOUBLE))) AS BIGINT) END AS high
  FROM goals, blk),
shares AS (SELECT source_no, coalesce(lag(high) OVER (ORDER BY source_no), 0) AS low, high FROM ends),
points AS (
  SELECT slot, (slot * 2654435769) % 4294967296 AS point
  FROM (SELECT unnest(generate_series(1, (SELECT CAST(round_even(words / block, 0) AS BIGINT) FROM blk))) AS slot)),
slots AS (
  SELECT source_no, slot, row_number() OVER (PARTITION BY source_no ORDER BY slot) - 1 AS rnk
  FROM points ASOF JOIN (SELECT * FROM shares WHERE high > low) s ON point >= s.low),
line AS (
  SELECT doc_id, size, source_no, source_size, target,
    coalesce(sum(size) OVER (PARTITION BY source_no
      ORDER BY CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 4) AS BIGINT) % 256, md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
    row_number() OVER () AS rid
  FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source),
reach AS (SELECT source_no, count(*) AS n FROM slots GROUP BY source_no),
own AS (
  SELECT goals.source_no, greatest(1, CAST(ceil(round(target) / coalesce(n, 1)) AS BIGINT)) AS length, CAST(round(target) AS BIGINT) AS upto, n IS NULL AS lone
  FROM goals LEFT JOIN reach USING (source_no)),
cut AS (
  SELECT line.*, upto, CASE WHEN size > 0 AND start < upto THEN CASE WHEN lone THEN 1 ELSE slots.slot END END AS slot
  FROM line JOIN own USING (source_no) LEFT JOIN slots ON slots.source_no = line.source_no AND slots.rnk = line.start // own.length)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(start + size, upto) - start) + greatest(0, least(start + source_size + size, upto) - start - source_size) AS BIGINT) AS taken, CAST(slot AS BIGINT) AS slot
FROM cut
"""
