"""Source divergence audit: how far the sources of each language are apart in their use of the language's common terms.

Each language keeps the terms that enough of its documents hold. A group is a language and one of its sources; its share of a term, in
billionths, is smoothed by `add` occurrences. Two groups' distance is the sum of the shares' differences over all kept terms. A difference depends on
the two counts alone, so each pair of groups is one joint histogram: how many terms have the counts (m, n). Terms that
both groups hold are tallied by a join on the term; the cells of terms that one or neither holds (count zero) are
implied by each group's own histogram and the size of the vocabulary, and never enumerated. The difference is evaluated once per cell.

All arithmetic is on integers and exact. Terms are counted in Python tasks that hand on sums, so a term or source that
is everywhere reaches a reducer as a few rows per task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showbill.llm.common import settle, slices

#: Letters of ASCII in lower case, other bytes of ASCII as a space, all bytes of longer characters as they are.
TERM_BYTES = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The runs of ASCII letters, lower-cased, and other non-ASCII characters of a text in UTF-8."""
    return text.translate(TERM_BYTES).split()


def term_counts(docs: DataFrame, held: int = 400_000) -> DataFrame:
    """lang, source, term with n (occurrences) and df (documents) in each; null text, lang and source count as empty.

    A task hands on its sums once it holds `held` of them, so its memory is bounded; texts are whole.
    """
    empty = F.lit("")
    rows = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"), F.coalesce("text", empty).cast("binary").alias("text"))

    def sums(groups: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, df) in groups.items():
            k = len(n)
            if k:
                arrays = [pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()), pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64()), pa.array([df[t] for t in n], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "df"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict = {}
        for b in slices(batches, 64):
            for key in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "text"))):
                n, df = groups.setdefault(key[:2], (Counter(), Counter()))
                found = terms(key[2])
                n.update(found)
                df.update(set(found))
            if sum(len(n) for n, _ in groups.values()) >= held:
                yield from sums(groups)
                groups = {}
        yield from sums(groups)

    counted = rows.mapInArrow(count, "lang string, source string, term binary, n bigint, df bigint")
    # Dealt by language and term, a term's sources are together for the sums over both.
    dealt = counted.select("lang", "source", F.col("term").cast("string").alias("term"), "n", "df").repartition("lang", "term")
    return dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def kept_terms(docs: DataFrame, least: int = 30) -> DataFrame:
    """lang, term, source, n of the terms that at least `least` of a language's documents hold, with n_lang (n of the whole language) and first (true on one row of a term)."""
    of_term = Window.partitionBy("lang", "term")
    counted = term_counts(docs).withColumns({"df_lang": F.sum("df").over(of_term), "n_lang": F.sum("n").over(of_term), "first": F.col("source") == F.min("source").over(of_term)})
    return counted.where(F.col("df_lang") >= least).drop("df", "df_lang")


def share(count: Column, total: Column, kept: Column, add: int) -> Column:
    """1 + floor(10^9 (count + add) / (total + add * kept)), exactly; null where no term is kept."""
    above = (count + add).cast("decimal(19,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    below = (total + add * kept).cast("decimal(19,0)")
    return F.when(kept > 0, F.call_function("div", above, below) + 1)


def audit(docs: DataFrame, least: int = 30, top: int = 50, add: int = 5) -> DataFrame:
    """lang, source, part, item, value, rank: each group's distances from the language's other sources, and the terms it overuses most.

    Part `pair`: item is another source of the language, value the sum of differences over all kept terms, farthest first. Part `term`:
    item is a term of the group whose share is above the language's, value the difference, only ranks up to `top`. Equal values are ranked by item in UTF-8.

    docs: text, lang, source; null counts as empty. Every (lang, source) that occurs is a group, also without terms: its distances are then
    those of a group with all counts zero, and 0 where the language keeps no term. Repeated rows count each. An empty table gives an empty result.
    Other columns, whatever their names, are not read. Pairs are those of sources, which the result lists; their number doesn't grow with the documents.
    """
    empty = F.lit("")
    kept = settle(kept_terms(docs.select("text", "lang", "source"), least))
    langs = kept.groupBy("lang").agg(F.sum(F.col("first").cast("long")).alias("v"), F.sum("n").alias("all_n"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    occurring = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    groups = occurring.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = settle(groups.select("lang", "source", zero("total"), zero("held"), zero("v"), zero("all_n"), F.monotonically_increasing_id().alias("g")))
    numbered = settle(kept.join(groups.select("lang", "source", "g", "total", "v", "all_n"), ["lang", "source"]))
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())

    over = share(F.col("n"), F.col("total"), F.col("v"), add) - share(F.col("n_lang"), F.col("all_n"), F.col("v"), add)
    overused = numbered.select("lang", "source", F.col("term").alias("item"), over.alias("value")).where("value > 0")
    overused = overused.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    side = lambda x, *cs: groups.select("lang", *[F.col(c).alias(f"{c}_{x}") for c in cs])
    pairs = settle(side("a", "g", "source", "total", "held").join(side("b", "g", "source", "total", "held"), "lang").where("g_a < g_b").join(langs.select("lang", "v"), "lang", "left").withColumn("v", F.coalesce("v", F.lit(0))))
    value = cell_sums(numbered, pairs, add)
    told = pairs.join(value, ["g_a", "g_b"], "left").withColumn("value", F.coalesce("value", F.lit(0)).cast("long"))
    both = F.explode(F.array(*[F.struct(F.col(f"source_{x}").alias("source"), F.col(f"source_{y}").alias("item")) for x, y in ("ab", "ba")]))
    apart = told.select("lang", "value", both.alias("_p")).select("lang", "_p.source", "_p.item", "value").withColumn("rank", F.row_number().over(by_value))
    parts = [df.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")) for part, df in (("pair", apart), ("term", overused))]
    return parts[0].unionByName(parts[1])


def joint_histograms(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """g_a, g_b, m, n, terms: how many terms have the counts m and n in two groups of a language, cells with zeros included.

    counts: lang, term, g, n (over 0); pairs: g_a, g_b, held_a, held_b (terms held by each), v (terms of the language). A term that
    both hold is taken off the cells (m, 0), (0, n) and put back at (0, 0), where each group's own histogram and the vocabulary had counted it.
    """
    a, b = (counts.select("lang", "term", F.col("g").alias(f"g_{x}"), F.col("n").alias(c)) for x, c in (("a", "m"), ("b", "n")))
    met = settle(a.join(b, ["lang", "term"]).where("g_a < g_b").groupBy("g_a", "g_b", "m", "n").agg(F.count("*").alias("terms")))
    zero = F.lit(0).cast("long")
    cell = lambda m, n, terms: F.struct(m.alias("m"), n.alias("n"), terms.alias("terms"))
    m, n, k = F.col("m"), F.col("n"), F.col("terms")
    of_both = met.select("g_a", "g_b", F.inline(F.array(cell(m, n, k), cell(m, zero, -k), cell(zero, n, -k), cell(zero, zero, k))))
    own = settle(counts.groupBy("g", F.col("n").alias("count")).agg(F.count("*").alias("terms")))
    of_a = pairs.join(own, pairs["g_a"] == own["g"]).select("g_a", "g_b", F.col("count").alias("m"), zero.alias("n"), "terms")
    of_b = pairs.join(own, pairs["g_b"] == own["g"]).select("g_a", "g_b", zero.alias("m"), F.col("count").alias("n"), "terms")
    none = pairs.select("g_a", "g_b", zero.alias("m"), zero.alias("n"), (F.col("v") - F.col("held_a") - F.col("held_b")).alias("terms"))
    cells = of_both.unionByName(of_a).unionByName(of_b).unionByName(none)
    return cells.groupBy("g_a", "g_b", "m", "n").agg(F.sum("terms").alias("terms")).where("terms != 0")


def cell_sums(counts: DataFrame, pairs: DataFrame, add: int) -> DataFrame:
    """g_a, g_b, value: the differences of shares, once per cell of the joint histogram, times the cell's terms."""
    cells = joint_histograms(counts, pairs).join(pairs.select("g_a", "g_b", "total_a", "total_b", "v"), ["g_a", "g_b"])
    apart = F.abs(share(F.col("m"), F.col("total_a"), F.col("v"), add) - share(F.col("n"), F.col("total_b"), F.col("v"), add))
    return cells.groupBy("g_a", "g_b").agg(F.sum(apart * F.col("terms")).alias("value"))


def report(docs: DataFrame) -> DataFrame:
    return audit(docs)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY ALL),
dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (
  SELECT lang, source, term, n, 1 + CAST(1000000000 AS HUGEINT) * (n + 5) // (CAST(sum(n) OVER (PARTITION BY lang, source) AS HUGEINT) + 5 * v) AS p
  FROM dense JOIN v USING (lang)),
l AS (SELECT lang, term, sum(n) AS n FROM dense GROUP BY ALL),
q AS (SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (CAST(n AS HUGEINT) + 5) // (CAST(sum(n) OVER (PARTITION BY lang) AS HUGEINT) + 5 * v) AS q FROM l JOIN v USING (lang)),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT s.lang, s.source, o.source AS item, sum(abs(s.p - o.p)) AS value FROM p s JOIN p o ON s.lang = o.lang AND s.term = o.term AND s.source <> o.source GROUP BY ALL) x
    ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
