"""Filter interaction audit: what each filter removes in every order of the filters, from counts per failure mask.

A document's failures are one mask, so all that the audit can say follows from a few numbers per part and mask: documents,
good ones, toxic ones. These cells are all that Spark gathers (two to the number of filters per part, whatever the
number of documents). A walk then visits all orders of the filters, each from the one before by swapping two neighbours; such a swap changes
what two steps remove and nothing else, so only these are counted again from the cells. A filter's Shapley sum grows
along the walk by what it removes times the number of orders for which that stays so.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showbill.llm.common import WORDS, heavy_light_lookup, settle

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def neighbour_swaps(n: int) -> Iterator[int]:
    """Positions p in turn: swapping what is at p and p + 1 visits all n! orders of n things, each once.

    The thing numbered n - 1 travels from one end to the other; at each end, the others make one swap among themselves.
    """
    if n < 2:
        return
    rest, at_end = neighbour_swaps(n - 1), True
    while True:
        yield from range(n - 2, -1, -1) if at_end else range(n - 1)
        at_end = not at_end
        inner = next(rest, None)
        if inner is None:
            return
        yield inner if at_end else inner + 1


def walk(cells: Mapping[int, Sequence[int]], n: int) -> Iterator[tuple[list[int], list[tuple[int, ...]]]]:
    """All orders of n filters with their steps' counts: kept, removed, redundant, unique_fails, good_lost, toxic_lost, and at last the filters' Shapley sums.

    cells: by failure mask (bit f set: filter f fails) the numbers of documents, of good and of toxic ones. Yields
    (order, steps) for each order; the last item is ([], [(sum,) of each filter]).
    """
    total = sum(c[0] for c in cells.values())
    fails = [sum(c[0] for m, c in cells.items() if m >> f & 1) for f in range(n)]
    alone = [cells.get(1 << f, (0,))[0] for f in range(n)]

    def lost(f: int, before: int) -> tuple[int, int, int]:
        met = [c for m, c in cells.items() if m >> f & 1 and not m & before]
        return sum(c[0] for c in met), sum(c[1] for c in met), sum(c[2] for c in met)

    order, before, kept = list(range(n)), [], []
    for f in order:
        before.append(sum(1 << g for g in order[:f]))
    removed = [lost(f, b) for f, b in zip(order, before)]
    left = total
    for r in removed:
        left -= r[0]
        kept.append(left)
    shapley, since, visit = [0] * n, [0] * n, 0

    def steps():
        return [(kept[i], removed[i][0], fails[f] - removed[i][0], alone[f], *removed[i][1:]) for i, f in enumerate(order)]

    yield list(order), steps()
    for visit, p in enumerate(neighbour_swaps(n), 1):
        for i in (p, p + 1):
            shapley[order[i]] += removed[i][0] * (visit - since[order[i]])
            since[order[i]] = visit
        order[p], order[p + 1] = order[p + 1], order[p]
        before[p + 1] = before[p] | 1 << order[p]
        left = kept[p] + removed[p][0]
        removed[p : p + 2] = lost(order[p], before[p]), lost(order[p + 1], before[p + 1])
        kept[p] = left - removed[p][0]
        yield list(order), steps()
    for i, f in enumerate(order):
        shapley[f] += removed[i][0] * (visit + 1 - since[f])
    yield [], [(s,) for s in shapley]


def audit(rows: DataFrame, filters: Mapping[str, str]) -> DataFrame:
    """One row per part, order of all filters and step: part, filter_order, step and the COUNTS.

    rows: part, good, toxic (boolean) and a boolean column for each filter that says whether the row fails it; filters: letter to column.
    Null counts as not failed, not good, not toxic. Only parts that occur have rows; an empty table gives an empty result. Of m filters the
    result has m! orders for each part, so it is meant for few (8 at most).
    """
    letters = list(filters)
    if not 1 <= len(letters) <= 8:
        raise ValueError("an audit takes 1 to 8 filters")
    mask = sum((F.coalesce(F.col(filters[x]), F.lit(False)).cast("int") * (1 << i) for i, x in enumerate(letters)), F.lit(0))
    held = [F.coalesce(F.sum(F.coalesce(F.col(c), F.lit(False)).cast("long")), F.lit(0)).alias(c) for c in ("good", "toxic")]
    cells = rows.groupBy("part", mask.alias("mask")).agg(F.count("*").alias("n"), *held)
    by_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, found in zip(b.column("part").to_pylist(), b.column("cells").to_pylist()):
                seen = list(walk({c["mask"]: (c["n"], c["good"], c["toxic"]) for c in found}, len(letters)))
                sums = [s for (s,) in seen.pop()[1]]
                out = [("".join(letters[f] for f in order), i + 1, *step, sums[order[i]]) for order, steps in seen for i, step in enumerate(steps)]
                columns = list(zip(*out))
                arrays = [pa.array([part] * len(out), pa.string()), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[2:])]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "filter_order", "step", *COUNTS])

    return by_part.mapInArrow(visit, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS))


def copies_after_the_first(docs: DataFrame, text: Column) -> DataFrame:
    """docs with copy: whether a smaller doc_id has the same text (by SHA-256). Null ids are neither smaller nor larger than any."""
    rows = settle(docs.withColumn("_digest", F.unhex(F.sha2(text, 256))).drop("text"))
    firsts = settle(rows.groupBy("_digest").agg(F.min("doc_id").alias("_first"), F.count("*").alias("_size")))
    joined = heavy_light_lookup(rows, firsts, "_digest", "_size", rows.agg(F.count("*")))
    return joined.withColumn("copy", F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False))).drop("_digest", "_first", "_size")


def conditions(text: Column) -> dict[str, Column]:
    """What four of the audited filters fail: few words, repeated words, capitals, symbols."""
    found = F.regexp_extract_all(text, F.lit(f"({WORDS})"))
    words = F.size(found).cast("long")
    return {
        "few": words < 100,
        "repeated": 100 * F.size(F.array_distinct(found)).cast("long") < 80 * words,
        "capitals": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > 10 * F.length(text).cast("long"),
        "symbols": text.rlike(r"[#$%&*|]"),
    }


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of five filters over whole texts: A few words, B repeated words, C capitals, D symbols, E copies of a smaller doc_id's text.

    docs: doc_id, text, lang (the part); labels: doc_id, quality, toxic. Null text and lang count as empty. A row is good (toxic) if any label
    row of its doc_id says so; rows without labels and rows without doc_id are neither. Rows that repeat a doc_id are documents of their own and no copies of each other.
    Other columns, whatever their names, are not read.
    """
    text = F.coalesce("text", F.lit(""))
    parts = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    rows = copies_after_the_first(parts.select("*", *[c.alias(n) for n, c in conditions(F.col("text")).items()]), F.col("text"))
    says = [F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))]
    labelled = settle(labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy("doc_id").agg(*says))
    return audit(rows.join(labelled, "doc_id", "left"), {"A": "few", "B": "repeated", "C": "capitals", "D": "symbols", "E": "copy"})


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (
  SELECT part, CAST(len(w) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INT)
    + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t) AS INT) + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
    + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INT) AS mask,
    CAST(coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), false) AS INT) AS good,
    CAST(coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL), false) AS INT) AS toxic
  FROM d),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
l AS (SELECT i, substr('ABCDE', i + 1, 1) AS letter, 1 << i AS bit FROM (SELECT CAST(unnest(range(5)) AS INT) AS i)),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM l a, l b, l c, l d, l e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[:step - 1]), 0) AS INT) AS before
  FROM o, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step)),
r AS (
  SELECT part, filter_order, step, bit,
    sum(n) FILTER (WHERE mask & (before | bit) = 0) AS kept, sum(n) FILTER (WHERE mask & bit <> 0 AND mask & before = 0) AS removed,
    sum(n) FILTER (WHERE mask & bit <> 0 AND mask & before <> 0) AS redundant, sum(n) FILTER (WHERE mask = bit) AS unique_fails,
    sum(good) FILTER (WHERE mask & bit <> 0 AND mask & before = 0) AS good_lost, sum(toxic) FILTER (WHERE mask & bit <> 0 AND mask & before = 0) AS toxic_lost
  FROM cells, s GROUP BY ALL)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, bit), 0) AS BIGINT) AS shapley
FROM r
"""
