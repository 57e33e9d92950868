"""What a query costs must not grow with how often an expression is used, or with how few files its input has."""

import random
import re

import duckdb
from pyspark.sql import functions as F

from showbill.functions import geo, text, urls
from showbill.operators import enrich, recommend, records, trees
from showbill.plans import catalogue, registry, whole

FOLDER = "/root/testdata/sf0.001"


def test_typing_reads_a_record_once(spark):
    """Filters on titles were pushed into the joins, where each member asked for made and parsed the JSON anew; one file was one task."""
    df = registry.QUERIES["record_typing"](spark, FOLDER)
    assert len(re.findall("parseJson", df._jdf.queryExecution().optimizedPlan().toString())) == 1
    assert df.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_short_paths_change_nothing(spark):
    """Texts and URLs that need no repair are left as they are: the same as what the whole repair gives."""
    odd = ["", " ", "a b", "a  b", "a　", "　a", "a  b", "x<br>y", "<b>x", "a &amp; b", "a\n\n\n\nb", "a\tb", "：館", "館｜", "a ", "\u0085a", "a\n", "=a =", "a<b", "&lt;b&gt;x"]
    links = ["", "https://a.b/c", "https://a.b/c\n", "http://a.b:80/c?d=e#f", "https://a.b/c&amp;d", "https://www.opentix.life/program/12", "https://a.bhttps://c.d/e", "https://a.b/?u=https://c.d/", "https://a.b/?u=https%3A%2F%2Fc.d", "https%3A//a.b/c", "//a.b/c", "/x/y",
             "https://a.b，說明", "https://a.b:x/c", "https://[::1]/c", "'https://a.b/c'", "https:\\/\\/a.b/c", "ftp://a.b", "https://-a.b/c", "https://a.b", "HTTPS://A.b/C", "https://a.b/c d", "https://u@a.b/c", "https://a.b/館"]
    df = spark.createDataFrame([(t,) for t in [*odd, *links, None]], "t string")
    got = df.select("t", text.clean_text("t").alias("c"), text.clean_place("t").alias("p"), urls.normalize_url("t").alias("u"), urls.normalize_url("t", "https://r.s/q/").alias("b")).collect()
    patterns = text.UNCLEAN, text.UNCLEAN_PLACE, urls.PLAIN_URL
    try:
        text.UNCLEAN, text.UNCLEAN_PLACE, urls.PLAIN_URL = r"(?s)\A.*", r"(?s)\A.*", "(?!)"
        want = df.select("t", text.clean_text("t").alias("c"), text.clean_place("t").alias("p"), urls.normalize_url("t").alias("u"), urls.normalize_url("t", "https://r.s/q/").alias("b")).collect()
    finally:
        text.UNCLEAN, text.UNCLEAN_PLACE, urls.PLAIN_URL = patterns
    assert got == want


def test_kinds_read_members_only(spark):
    """The schema of a VARIANT is that of its whole subtree, which each level asked for again."""
    df = spark.createDataFrame([('{"a": {"b": {}}, "c": "{}", "d": [1], "e": null}',)], "j string")
    got = df.select(trees.children(F.col("j"), F.lit("object")).alias("c"))
    assert not re.search("(?i)schema_?of_?variant", got._jdf.queryExecution().optimizedPlan().toString())
    assert [(c["name"], c["kind"]) for c in got.first()["c"]] == [("a", "object"), ("c", "value"), ("d", "array"), ("e", "value")]


def test_pages_are_dealt_over_cores(spark):
    """Pages of one small file were searched in one task."""
    pages = spark.createDataFrame([(1, "https://a.b/c", "<p>x</p>")], "page_id int, url string, html string")
    assert "RepartitionByExpression [page_id" in enrich.page_metadata(pages)._jdf.queryExecution().optimizedPlan().toString()


def test_sessions_are_read_once(spark):
    """The sessions were parsed for the scores and again for the best."""
    df = registry.QUERIES["best_session_argmax"](spark, FOLDER)
    assert len(re.findall("parseJson", df._jdf.queryExecution().optimizedPlan().toString())) == 1


def test_only_records_that_are_asked_are_typed(spark, monkeypatch):
    """The records of all customers were typed, three times, and most of them dropped."""
    seen, typed = [], records.typed
    monkeypatch.setattr(records, "typed", lambda raw: seen.append(raw.count()) or typed(raw.limit(1)))
    registry.QUERIES["catalogue_update"](spark, FOLDER)
    keys = [r[0] for r in whole.named(spark, FOLDER).select("k").collect()]
    assert seen == [sum(k % 2 == 0 for k in keys), sum(k % 6 == 2 for k in keys), sum(k % 3 == 0 for k in keys)]


def test_blank_coordinates_are_not_parsed(spark, monkeypatch):
    """Each blank threw an exception inside the JVM. The guard changes no coordinate."""
    odd = ["", " ", "x", "25", " 25,04 ", "1e1", "1d", "NaN", "Infinity", "-inf", "0", "0x1p3", "٢٥", "25..", "+25", ".5", "90.1", "121.5", None]
    df = spark.createDataFrame([(a, b) for a in odd for b in ("121.5", "", "25")], "a string, b string")
    pair = lambda: df.select(geo.coordinate_pair("a", "b"))
    assert "RLIKE(" in pair()._jdf.queryExecution().optimizedPlan().toString().upper()
    got = pair().collect()
    monkeypatch.setattr(geo, "DIGIT", r"(?s)\A.*")
    assert got == pair().collect()


def test_long_lists_of_ids_are_not_broadcast(spark):
    """with_details sent the ids of all details to every task, however many are asked for."""
    one = spark.createDataFrame([('{"UID": "1", "title": "t"}',)], "j string").select(F.parse_json("j").alias("raw"), F.lit(1).cast("long").alias("ord"))
    events = records.written(records.typed(one))
    hinted = lambda most: "strategy=broadcast" in enrich.with_details(events, events, most)._jdf.queryExecution().optimizedPlan().toString()
    assert hinted(250) and not hinted(1 << 30)


def test_related_pairs_are_not_gathered(spark):
    """A distinct held all pairs of a region in one task. Each pair comes once, however many labels it shares; blanks and nulls relate nothing."""
    rows = [(1, "a", ["x", "y"]), (2, "a", ["y", "x", "x"]), (3, "b", ["y", "x", None]), (4, None, [None]), (5, None, None), (6, "c", []), (7, "c", ["z", "y"]), (8, "b", [None, "w"]), (9, None, ["x"])]
    events = spark.createDataFrame(rows, "key int, region string, categories array<string>")
    df = recommend.related(events, events.where("key <> 2"))
    assert "Aggregate" not in df._jdf.queryExecution().optimizedPlan().toString()
    labels = lambda e: set(e[2] or []) - {None}
    want = [(s[0], e[0]) for s in rows for e in rows if s[0] not in (2, e[0]) and (s[1] == e[1] is not None or labels(s) & labels(e))]
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_documents_are_cut_into_runs_once(spark):
    """Runs of words were made twice, and all documents' texts shuffled for a few pairs."""
    plan = catalogue.pairs(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_compared_texts_are_computed_once(spark):
    """A page was compacted anew for each token of a title, a title for each of its characters. No lambda takes a Python function, so these only run if the text is computed outside."""
    df = spark.createDataFrame([("night show, day fair", "Night Show")], "e string, p string")
    own = F.udf(lambda t: t.lower(), "string")
    got = df.select(text.token_coverage("e", own("p")).alias("none"), text.token_coverage("e", F.replace(own("p"), F.lit(" "), F.lit(""))).alias("half"), text.bigrams(F.left(own("p"), F.lit(3))).alias("b"), text.title_score("e", own("p"), "p").alias("s")).first()
    assert (got["none"], got["half"], got["b"], got["s"]) == (0.5, 0.5, ["ni", "ig"], 0.88)


def test_whole_texts_are_scored(spark, tmp_path):
    """Only the first 240,000 characters of a page were searched for a title."""
    title = "Rare night show, rare day fair"
    spark.createDataFrame([(0, title)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = ["zz\n" + "zz zz\n" * 50_000 + end for end in (f"{title}!", "rare night show, then a day", "zz")]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["score"] for r in registry.QUERIES["title_match_ratio"](spark, str(tmp_path)).collect()}
    assert got == {0: 0.92}
    scores = spark.createDataFrame([(title, "zz", t) for t in texts], "e string, c string, p string").select(text.title_score("e", "c", "p").alias("raw"), text.title_score("e", "c", plain=text.compact_title("p")).alias("plain")).collect()
    assert [r["raw"] for r in scores] == [r["plain"] for r in scores] == [0.92, 0.6833, 0.0]


def test_whole_texts_are_covered(spark, tmp_path):
    """Only the first 240,000 characters of a text were searched for a title's tokens, in the SQL too."""
    title = "Rare night show, rare day fair"
    spark.createDataFrame([(0, title)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = ["zz\n" + "zz zz\n" * 50_000 + end for end in ("rare night show, then", "fair, rare night show,", "zz")]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in registry.QUERIES["title_token_coverage"](spark, str(tmp_path)).select("item_id", "doc_id", "tokens", "coverage").collect()]
    con = duckdb.connect()
    for t in ("benchmark", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.sql(f"SELECT item_id, doc_id, tokens, coverage FROM ({registry.ORACLES['title_token_coverage']})").fetchall()
    assert sorted(got) == sorted(want) == [(0, 0, 6, 0.666667), (0, 1, 6, 0.833333)]


def test_a_text_is_compacted_once(spark):
    """Texts were shuffled and compacted anew for each item that they meet."""
    plan = catalogue.pairs(spark, FOLDER, plain=text.compact_title("body"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan


def test_long_texts_are_cleaned_in_one_pass(spark):
    """Each < that nothing closes, and each blank of a run, was followed to the end: a long text of either took hours. Nothing else changes."""
    rnd = random.Random(7)
    pieces = ["<", ">", "<b>", "<br />", "<BR", "&lt;", "&amp;", "&", "a", "B", " ", "\n", "\r", "\u3000", "\u00a0", "\u0085", "\u2028", "\t", "夏", "😀", "$1", "\\\\"]
    odd = ["", "<", "<>", "<<", "a<b", "<a <b> c <d", *["".join(rnd.choices(pieces, k=rnd.randrange(12))) for _ in range(2000)]]
    tags = F.regexp_replace(F.regexp_replace(text.unescape("t"), r"(?i)<br\s*/?>", "\n"), r"<[^>]+>", "")
    got = spark.createDataFrame([(x,) for x in odd], "t string").select("t", text.untagged(F.col("t")).alias("tags"), tags.alias("tags_before"), text.strip("t").alias("strip"), F.regexp_replace("t", r"(?U)^\s+|\s+$", "").alias("strip_before")).collect()
    assert [r for r in got if r["tags"] != r["tags_before"] or r["strip"] != r["strip_before"]] == []
    many = lambda c: text.compact_title(F.concat(F.lit("a"), F.repeat(F.lit(c), F.lit(2_000_000)), F.lit("x")))
    assert tuple(spark.range(1).select(many("<"), many("\u3000")).first()) == ("ax", "ax")


def test_bigrams_of_odd_texts(spark):
    odd = ["", "a", "ab", "aaa", "館a館", "a😀b😀", "x" * 5000 + "y", "a\nb", ".*|"]
    got = spark.createDataFrame([(t,) for t in [*odd, None]], "t string").select("t", text.bigrams("t").alias("b")).collect()
    assert [r["b"] for r in got[:-1]] == [list(dict.fromkeys(t[i : i + 2] for i in range(len(t) - 1))) for t in odd] and got[-1]["b"] == [None]
