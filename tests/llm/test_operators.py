"""Every operator on a table with nulls, empty, long and repeated texts, and against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from showbill.llm import exact_dedup, langid, license_scan, mixing, near_dedup, pii, ppm, quality, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, keep_id string"
BASE = "the quick brown fox jumps over the lazy dog and then runs far away into the deep dark forest of the north "
EN = "this is the house that the man built with the help of his friends and the stone of the hill "
DE = "das ist das Haus das der Mann mit der Hilfe seiner Freunde und dem Stein vom Berg gebaut hat "
ROWS = [
    (0, BASE * 3, "en", "a"), (1, (BASE * 3).replace(" ", "\n"), "en", "a"), (2, BASE * 3 + "again", "en", "b"), (3, None, "en", "b"), (4, "", None, None),
    (5, "   \t\n", None, None), (6, "one two", "en", "a"), (7, "one  two", "en", "c"), (8, "x" * 200_000, "en", "a"), (9, EN * 40, "en", "b"), (10, DE * 40, "de", "b"),
    (11, "Released under the MIT License.", "en", "a"), (12, "card 4111 1111 1111 1111, 1.2.3.4", "en", "a"), (13, "é" * 30 + " <|endoftext|>", "fr", "c"), (13, "é" * 30 + " <|endoftext|>", "fr", "c"), (14, EN * 3, "en", "d"),
    (15, " ".join(f"w{i}" for i in range(40_000)), "en", "e"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, "clash", "clash") for r in ROWS], SCHEMA).repartition(3)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("report", [exact_dedup.report, mixing.report, near_dedup.report, quality.report, langid.report, license_scan.report, lambda d: pii.report(d, "k"), ppm.report])
def test_empty_tables(docs, report):
    assert report(docs.limit(0)).count() == 0


def test_exact_dedup(docs):
    got = by_id(exact_dedup.report(docs))
    norm = {r[0]: re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in ROWS}
    for r in ROWS:
        same = [x[0] for x in ROWS if norm[x[0]] == norm[r[0]]]
        g = got[r[0]]
        assert (g["keep_id"], g["group_size"], g["kept"]) == (min(same), len(same), r[0] == min(same))
        assert g["text_sha256"] == hashlib.sha256(norm[r[0]].encode()).hexdigest()
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns and 1 not in {r["doc_id"] for r in kept.collect()} and {r["keep_id"] for r in kept.collect()} == {"clash"}


def test_exact_dedup_hot_group(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text")).repartition(7)
    got = exact_dedup.report(docs).where("group_size > 1").agg(F.count("*"), F.max("keep_id"), F.max("group_size")).first()
    assert tuple(got) == (1000, 0, 1000)


def brute_groups(rows, width):
    sets = {}
    for i, text in rows:
        w = [x.encode().lower() for x in words(text)]
        k = min(width, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_dedup(docs):
    want = brute_groups([(r[0], r[1]) for r in ROWS], 4)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in by_id(near_dedup.report(docs)).items()} == want


def test_near_dedup_chains(spark):
    """Copies with growing edits: links run through the group although its ends are far apart, and outliers stay out."""
    base = [f"w{i}" for i in range(120)]
    rows = [(k, " ".join([*base[: 120 - 4 * k], *(f"x{k}y{i}" for i in range(k % 3))])) for k in range(18)]
    rows += [(100 + k, " ".join(w if i % (5 + k) else f"z{k}" for i, w in enumerate(base))) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {i: r["component_id"] for i, r in by_id(near_dedup.report(df)).items()} == {i: c for i, (_, c) in brute_groups(rows, 4).items()}


def test_near_dedup_ids(spark):
    """One id with two texts, null ids, ids that are strings, and clashing columns."""
    far = " ".join(f"v{i}" for i in range(60))
    rows = [("b", BASE * 3, 1), ("b", far, 1), ("a", far + " more", 1), (None, BASE * 3 + "again", 1), (None, "only null ids here", 1), (None, "only null ids here", 1), ("c", BASE * 3, 1), (None, None, 1), ("d", "", 1)]
    df = spark.createDataFrame(rows, "doc_id string, text string, _kept int")
    got = sorted(near_dedup.report(df).collect(), key=str)
    want = [("b", "b", True), ("b", "a", False), ("a", "a", True), (None, "b", False), (None, None, True), (None, None, True), ("c", "b", False), (None, None, True), ("d", "d", True)]
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got), key=str) == sorted(want, key=str)
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(((r[0], r[1]) for r, w in zip(rows, want) if w[2]), key=str)


def test_near_dedup_recall_at_the_threshold(spark):
    """Pairs with a similarity of exactly 0.8 are all linked, those just below never."""
    rows = []
    for k in range(150):
        own = [f"p{k}w{i}" for i in range(100)]
        rows += [(4 * k, " ".join(own)), (4 * k + 1, " ".join([*own[:80], *[f"q{k}"] * 0])), (4 * k + 2, " ".join(f"r{k}w{i}" for i in range(100))), (4 * k + 3, " ".join(f"r{k}w{i}" for i in range(79)))]
    got = by_id(near_dedup.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), width=1))
    assert sum(got[4 * k + 1]["component_id"] == 4 * k for k in range(150)) == 150
    assert sum(got[4 * k + 3]["component_id"] == 4 * k + 3 for k in range(150)) == 150


def test_likelihood_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    factors = near_dedup.multipliers(240)
    for share in (0.5, 0.8, 0.95):
        b = np.concatenate([a[: int(1000 * share)], rng.integers(0, 2**63, 1000 - int(1000 * share)).astype(np.uint64)])
        j = share / (2 - share)
        got = near_dedup.likely_similarity(near_dedup.sketch(a, factors)[None], near_dedup.sketch(b, factors)[None], np.array([1000.0]), np.array([1000.0]))[0]
        assert abs(got - j) < 0.12


def test_mixing(docs):
    got = mixing.report(docs).collect()
    assert len(got) == len(ROWS)
    source = {r[0]: r[3] for r in ROWS}
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        assert r["size"] == len(words(dict((x[0], x[1]) for x in ROWS)[r["doc_id"]])) and r["taken"] <= 2 * r["size"]
        size[source[r["doc_id"]]] += r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    total = sum(size.values())
    assert abs(sum(target.values()) - 1.5 * total) < 1e-6
    for s, t in target.items():
        assert t <= 2 * size[s] + 1e-9 and abs(taken[s] - t) <= 0.01 * t + 20
    assert sorted(got) == sorted(mixing.report(docs).collect())


def test_mixing_takes_targets_of_tiny_sources(spark):
    sizes = spark.range(1000).selectExpr("id as doc_id", "'hot' as source", "3000000L as size").union(spark.range(1000, 1006).selectExpr("id", "'tiny'", "500L")).union(spark.range(2000, 2003).selectExpr("id", "'small'", "900000L"))
    got = mixing.mix(sizes).groupBy("source_size").agg(F.max("target").alias("target"), F.sum("taken").alias("taken"), F.max(F.col("taken") / F.col("size")).alias("most")).collect()
    assert len(got) == 3 and all(abs(r["taken"] - r["target"]) <= max(1, 0.01 * r["target"]) and 0 < r["most"] <= 2 for r in got)


def test_mixing_repeats_rows(docs):
    out = mixing.repeat(docs)
    assert out.columns == docs.columns
    assert max(r["count"] for r in out.groupBy("doc_id").count().collect()) <= 4


def test_quality_counts(docs):
    got = by_id(quality.report(docs))
    for i, text, *_ in ROWS:
        w = words(text)
        grams = Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        inside = {j + k for j in range(len(w) - 4) if grams[tuple(w[j : j + 5])] > 1 for k in range(5)}
        seen, dup = set(), 0
        for line in (text or "").split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(inside) > 20 * len(w))
        assert not (r["base_failed"] and r["kept"])


def test_language(spark, docs):
    rows = [(i, (EN if i % 2 else DE) * (1 + i % 3), "en" if i % 2 else "de") for i in range(60)]
    train = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = by_id(langid.report(train))
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows)
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in rows)
    edge = by_id(langid.report(docs))
    assert all(edge[i]["lang_pred"] == "und" for i in (3, 4, 5)) and all(0 <= r["score"] <= 1 for r in edge.values())


@pytest.fixture(scope="module")
def ranks(tmp_path_factory):
    """A small vocabulary: all bytes, and some longer pieces."""
    import base64

    path = tmp_path_factory.mktemp("ranks") / "small.tiktoken"
    pieces = [*(bytes([b]) for b in range(256)), b"ab", b"ba", b"aba", b" a", "é".encode(), b"aaaa", b"aa", b" abab"]
    path.write_bytes(b"".join(base64.b64encode(p) + b" %d\n" % i for i, p in enumerate(pieces)))
    return str(path), pieces


def segmentations(word, logs, pieces):
    """The log of the sum over all segmentations, by recursion on the first piece."""
    sums = [1.0]
    for end in range(1, len(word) + 1):
        sums.append(sum(sums[end - len(p)] * math.exp(logs[i]) for i, p in enumerate(pieces) if len(p) <= end and word[end - len(p) : end] == p))
    return math.log(sums[-1])


def test_forward_sums_all_segmentations(ranks):
    path, pieces = ranks
    logs = np.log(np.random.default_rng(1).dirichlet(np.ones(len(pieces)), 2).T)
    scorer = langid.Scorer(langid.Model(["x", "y"], logs), path)
    texts = ["abab aba", "éa bb\nabab", "a" * 60, "zz abab zz"]
    for _ in range(2):  # the second time words are remembered
        for text, got in zip(texts, scorer.logs_of(texts), strict=True):
            assert np.allclose(got, [sum(segmentations(b" " + w.encode(), logs[:, k], pieces) for w in text.split()) for k in range(2)])
    long = scorer.logs_of(["a" * 30_000])[0]
    assert np.isfinite(long).all() and long.max() < -1000


def test_expected_pieces(ranks):
    import itertools

    path, pieces = ranks
    logs = np.log(np.random.default_rng(2).dirichlet(np.ones(len(pieces))))
    word, times, want, total = b" ababa", 3.0, Counter(), 0.0
    for n in range(len(word)):
        for at in itertools.combinations(range(1, len(word)), n):
            cut = [word[i:j] for i, j in zip((0, *at), (*at, len(word)))]
            if all(c in pieces for c in cut):
                p = math.exp(sum(logs[pieces.index(c)] for c in cut))
                total += p
                for c in cut:
                    want[pieces.index(c)] += p
    got = langid.expected([word, b"q"], np.array([times, 1.0]), langid.shared_pieces(path), logs)
    want = {i: times * x / total for i, x in want.items()} | {pieces.index(b"q"): 1.0}
    assert np.allclose(got, [want.get(i, 0) for i in range(len(pieces))])


def test_language_of_whole_texts(spark):
    """Held-out accuracy, repeated and null ids, texts without spaces, and rows that no language can be told from."""
    rows = [(i, " ".join(np.random.default_rng(i).permutation((EN if i % 2 else DE).split())), "en" if i % 2 else "de") for i in range(80)]
    rows += [(7, rows[7][1], "en"), (None, DE, None), *((k, "\u4f60\u597d" * 2000, "zh") for k in (500, 503, 504, 505)), (501, "1234 !!", "en"), (502, "\u4f60\u597d" * 50, None)]
    got = langid.report(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    assert len(got) == len(rows)
    of = {r["doc_id"]: r for r in got}
    assert all(of[i]["lang_pred"] == rows[i][2] for i in range(80)) and sum(r["doc_id"] == 7 for r in got) == 2
    assert of[None]["lang_pred"] == "de" and not of[None]["held_out"] and (of[501]["lang_pred"], of[501]["score"]) == ("und", 0.0)
    assert of[502]["lang_pred"] == "zh"


def test_lm_base(docs):
    got = by_id(ppm.report(docs))
    token = lambda t: [w.encode().lower() for w in words(t)] + [b"\n"]
    train = Counter()
    for i, t, *_ in ROWS:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            train.update(token(t))
    n, v = sum(train.values()), len(train)
    for i in {r[0] for r in ROWS}:
        t = next(r[1] for r in ROWS if r[0] == i)
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in token(t))
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(token(t)), sum(train[w] > 0 for w in token(t)), n)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base)) and r["score"] < 0


def test_ppm_next_byte_sums_to_one(spark):
    texts = spark.createDataFrame([("abra cadabra abracadabra", 0), ("cad bra abra", 0), ("zz unseen", None), ("bra ccc", 1)], "text string, part int")
    own = ppm.Speller(ppm.learn(ppm.word_counts(texts, 2), [0.5, 0.5]))
    for before in (b"", b"a", b"abr", b"zz", b"cadab", b"q" * 40):
        s = ppm.spots([before + bytes([b]) for b in range(256)])
        every = np.arange(len(s.symbol))
        for part in (0, 1):
            assert abs((10 ** own.values(s, part, every, every)[s.starts + len(before)]).sum() - 1) < 1e-9


def test_ppm_keeps_every_context(spark):
    text = " ".join(hashlib.md5(str(k).encode()).hexdigest()[: 3 + k % 9] + "shared" * (k % 3) for k in range(300))
    rows = [(text, 0), (text[: len(text) // 2] + " other words of this part", 1), ("never seen wordsshared", None)]
    counts = ppm.settle(ppm.word_counts(spark.createDataFrame(rows, "text string, part int"), 2))
    whole = ppm.Speller(ppm.learn(counts, [0.5, 0.5]))
    for per in ((), (25,)):
        got = ppm.spelled(counts, ppm.learn(counts, [0.5, 0.5], capacity=160), *per)
        got = {bytes(r["word"]): (r["s0"], r["s1"]) for r in got.collect()}
        words_in = sorted(got)
        assert len(words_in) == counts.count()
        assert np.allclose(np.array([got[w] for w in words_in]), whole.spell(words_in, 2), atol=1e-9)


def test_licenses(spark):
    files = [("LICENSE", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."), ("a/x.txt", "hello there"), ("a/b/COPYING", "Licensed under the Apache License, Version 2.0."), ("a/b/c/y.txt", None), ("a/b/z.txt", "Prose first. Licensed under CC BY-NC 4.0. More prose."), ("", "")]
    got = {r["path"]: (r["license"], r["found"]) for r in license_scan.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got == {"LICENSE": ("MIT", "own"), "a/x.txt": ("MIT", "inherited"), "a/b/COPYING": ("Apache-2.0", "own"), "a/b/c/y.txt": ("Apache-2.0", "inherited"), "a/b/z.txt": ("CC-BY-NC-4.0", "own"), "": ("MIT", "inherited")}


def test_license_edges(docs):
    got = by_id(license_scan.report(docs))
    assert got[11]["license"] == "MIT" and got[11]["found"] == "own" and got[0]["found"] in ("inherited", "none")


def test_permutation_and_formats():
    p = pii.Permuter(b"k")
    assert sorted(p.permute(i, 777, "t") for i in range(777)) == list(range(777))
    text, spans = pii.pseudonymised("pay 4111 1111 1111 1111 or 4111111111111112 on 2024-02-29, not 2024-02-30; GB82 WEST 1234 5698 7654 32", p)
    assert [k for k, *_ in spans] == ["card", "date", "iban"] and "4111111111111112" in text and "2024-02-30" in text
    again, same = pii.pseudonymised(text, p)
    assert [k for k, *_ in same] == ["card", "date", "iban"] and again != text


def test_pii_links_equal_values(docs, spark):
    df = spark.createDataFrame([(1, "call +1 (988) 555-2485"), (2, "or +1 988 555 2485"), (3, None)], "doc_id bigint, text string")
    got = by_id(pii.report(df, "k"))
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(got[1]["text"]) == digits(got[2]["text"]) != "19885552485" and got[3]["text"] is None
    assert pii.report(docs, "k").count() == len(ROWS)


def test_toxicity(spark, docs):
    rows = [(i, f"{EN} you are a {'blorgish' if i % 5 == 0 else 'gentle'} soul, number{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 if i % 5 == 0 else 0) for i in range(200)] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    got = by_id(toxicity.report(df, labels))
    assert all(got[i]["predicted"] == (i % 5 == 0) for i in range(200))
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(200))
    assert by_id(toxicity.report(docs, labels))[3]["predicted"] == 0
    assert toxicity.report(df.limit(0), labels.limit(0)).count() == 0


def test_toxicity_beside_large_group_of_copies(spark):
    long = " ".join(hashlib.md5(str(k).encode()).hexdigest() for k in range(2500))
    texts = [*[(long, 1)] * 40, *[(f"{EN} you are a zzblorgish soul, number{i}", 1) for i in range(20)], *[(f"{EN} you are a gentle soul, number{i}", 0) for i in range(400)]]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, toxic) for i, (_, toxic) in enumerate(texts)], "doc_id bigint, toxic int")
    got = by_id(toxicity.report(df, labels))
    assert all(got[i]["predicted"] == toxic for i, (_, toxic) in enumerate(texts))


def test_cover_is_greedy():
    hits = [[0, 1, 2], [0, 1], [1, 2], [3], [3, 4], [2, 4]]
    assert toxicity.cover(hits, 1) == {1, 3, 2} and toxicity.cover(hits, 2) == {1, 3} and toxicity.cover([], 1) == set()


def test_grammar_patterns():
    m = toxicity.Matcher(["idiot$", "blorg", "blorgxyz$"])
    seen = lambda t: [p for p, n in zip(toxicity.PATTERNS, m.counts(t)) if n]
    want = {
        "you idiot": "insult+aimed", "idiot you are": "insult+aimed", "an idiot came": "insult", "he is an idiot": "insult", "the idiot said hello": "insult", "not an idiot": "insult+not",
        "he said blorgs came": "insult+said", "he said you are no idiot": "insult+not+said+aimed", "I will kill you.": "threat+aimed", "you kill": "violence+aimed", "we don't kill": "threat+not",
        "blorgxyzw you": "insult+aimed", "blorgxyz": "insult",
    }
    assert {t: seen(t) for t in want} == {t: [p] for t, p in want.items()}
    assert seen("idiotic") == seen("xblorg") == seen("") == seen(None) == []


def test_grammar_against_plain_rules():
    """The composed transducers against a loop over the words."""
    rng = np.random.default_rng(5)
    m = toxicity.Matcher(["idiot$", "blorg"])
    pool = ["blorgs", "idiot", "idiots", "kill", "you", "not", "said", "i", "will", "house", "the"]
    for _ in range(400):
        clause = rng.choice(pool, rng.integers(1, 8)).tolist()
        negated = reported = meant = aimed = False
        want, last = set(), max((i for i, w in enumerate(clause) if w == "you"), default=-1)
        for i, w in enumerate(clause):
            negated, reported, meant, aimed = negated or w == "not", reported or w == "said", meant or w in ("i", "will"), aimed or w == "you"
            if w in ("blorgs", "idiot", "kill"):
                kind = "insult" if w != "kill" else "threat" if meant else "violence"
                want.add(kind + "+not" * negated + "+said" * reported + "+aimed" * (aimed or i < last))
                negated = False
        assert m.patterns(clause) == want


def test_repeated_rows(spark):
    """Rows that repeat a doc_id or have none keep rows of their own."""
    rows = [(2, "a b c", "en", "x/y"), (2, "a b c", "en", "x/y"), (2, "other words", "en", "x/y"), (None, "a b", None, None), (None, "Released under the MIT License.", "en", "x"), (None, None, "en", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    lm = sorted(((r["doc_id"], r["n_tokens"], r["n_known"]) for r in ppm.report(df).collect()), key=str)
    assert lm == sorted([(2, 4, 4), (2, 4, 4), (2, 3, 3), (None, 3, 3), (None, 6, 6), (None, 1, 1)], key=str)
    assert sorted((str(r["license"]), r["found"]) for r in license_scan.report(df).collect()) == sorted([("None", "none")] * 4 + [("MIT", "own"), ("MIT", "inherited")])
    assert exact_dedup.keep_first(df).where("doc_id = 2").count() == 2
    assert exact_dedup.exact_dedup(df.withColumn("Kept", F.lit(7))).where("kept").count() == 6
    names = df.selectExpr("cast(doc_id as string) as doc_id", "text", "lang", "source")
    assert ppm.report(names).count() == near_dedup.report(names).count() == langid.report(names).count() == 6


def test_wrapped_headers_and_tags(spark):
    files = {
        "mpl.c": "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at http://mozilla.org/MPL/2.0/. */\nint x;",
        "gpl.py": "# This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation; either version 2 of the License, or\n# (at your option) any later version.\nx = 1",
        "tag.c": "// SPDX-License-Identifier: GPL-3.0-or-later\nint y;", "mit.rs": "// SPDX-License-Identifier: mit\n", "odd.rs": "# SPDX-License-Identifier: Foo-1.0", "prose.txt": "The licence of the poet is wide.\n\nNothing more.",
        "lgpl.c": "// This library is free software; you can redistribute it and/or\n// modify it under the terms of the GNU Lesser General Public\n// License as published by the Free Software Foundation; either\n// version 2.1 of the License, or (at your option) any later version.\n",
    }
    got = {r["path"]: r["license"] for r in license_scan.scan(spark.createDataFrame([(f"{i}/{p}", t) for i, (p, t) in enumerate(files.items())], "path string, text string")).collect()}
    assert {p.split("/")[1]: x for p, x in got.items()} == {"mpl.c": "MPL-2.0", "gpl.py": "GPL-2.0", "tag.c": "GPL-3.0", "mit.rs": "MIT", "odd.rs": "Foo-1.0", "prose.txt": None, "lgpl.c": "LGPL-2.1"}


def test_pii_formats_and_links():
    p = pii.Permuter(b"k")
    new = lambda t: pii.pseudonymised(t, p)[0]
    digits = lambda t: re.sub(r"\D", "", t)
    assert digits(new("+49 151 2345678")) == digits(new("+491512345678")) != "491512345678" and new("+49 151 2345678").startswith("+49 ")
    assert digits(new("+1 (988) 555-2485"))[1:] == digits(new("(988) 555-2485")) == digits(new("988-555-2485"))
    assert re.fullmatch(r"\d{4}-\d{1,2}-\d{1,2}", new("2024-1-5")) and not re.search(r"-0", new("2024-1-5")) and re.fullmatch(r"\d{4}-\d\d-\d\d", new("2024-01-05"))
    assert [int(x) for x in new("2024-1-5").split("-")] == [int(x) for x in new("2024-01-05").split("-")]
    for k in range(300):
        a, b, c = new(f"{100 + k}-12-3456").split("-")
        assert a not in ("000", "666") and a < "900" and b != "00" and c != "0000"
    tok = "ghp_" + "aB3" * 12
    assert new(f"use {tok} now") != f"use {tok} now" and re.fullmatch(r"use ghp_([a-z][A-Z][0-9]){12} now", new(f"use {tok} now"))
    key = "-----BEGIN RSA PRIVATE KEY-----\n" + "MIIEow1" * 9 + "\n" + "q+/xY2" * 8 + "\n-----END RSA PRIVATE KEY-----"
    out = new("x\n" + key + "\ny")
    assert "MIIEow1" not in out and out.startswith("x\n-----BEGIN RSA PRIVATE KEY-----\n") and out.endswith("\n-----END RSA PRIVATE KEY-----\ny") and len(out) == len(key) + 4
    long = "1.2.3.4 " + "word " * 200_000 + "5.6.7.8"
    assert len(pii.pseudonymised(long, p)[1]) == 2


def test_quality_verdict_against_plain_sums(spark):
    """Distances and kept, from dictionaries, over a table with a language that has no reference."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice((EN if i % 2 else DE).split(), 120).tolist()), "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, "zq#xw " * 80, "en"), (101, " ".join(f"v{i}" for i in range(90)), "en"), (102, " ".join(rows[0][1].split()[:60]), "xx"), (103, None, None), (104, "w" * 40 + " " + rows[1][1], None)]
    refs: dict[str, tuple[Counter, Counter]] = {}
    kind = lambda b: int(quality.CLASS_OF[b]) - 1
    for _, t, lang in rows:
        if t and lang:
            words_of, classes = refs.setdefault(lang, (Counter(), Counter()))
            words_of.update(t.lower().encode().split())
            classes.update(k for k in map(kind, t.encode()) if k >= 0)
    refs = {k: v for k, v in refs.items() if v[0].total() >= 2000}

    def js(a, b):
        m = {k: (a.get(k, 0) / sum(a.values()) + b.get(k, 0) / sum(b.values())) / 2 for k in {*a, *b}}
        half = lambda x: sum(n / sum(x.values()) * math.log2(n / sum(x.values()) / m[k]) for k, n in x.items() if n)
        return max(0, (half(a) + half(b)) / 2) ** 0.5

    got = by_id(quality.report(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")))
    for i, t, lang in rows:
        raw, r = (t or "").encode(), got[i]
        own = Counter(raw.lower().split())
        by_class = by_word = None
        if (lang is None or lang in refs) and t:
            if r["word_chars"] >= 200:
                by_class = min(js(Counter(k for k in map(kind, raw) if k >= 0), c) for _, c in refs.values())
            if r["n_words"] >= 50:
                by_word = 1.0
                for w, _ in refs.values():
                    top = dict(sorted(w.items(), key=lambda x: (-x[1], x[0]))[:50])
                    fold = lambda c: {**{k: c[k] for k in top if c[k]}, None: c.total() - sum(c[k] for k in top)}  # noqa: E731, B023
                    by_word = min(by_word, js(fold(own), fold(w)))
        for have, want in ((r["class_distance"], by_class), (r["word_distance"], by_word)):
            assert (have is None) == (want is None) and (want is None or abs(have - want) < 1e-9)
        far = (by_class or 0) > 0.345 or (by_word or 0) > 0.47
        assert r["kept"] == (not r["base_failed"] and not far)
    assert got[102]["class_distance"] is None and not got[101]["kept"]


def test_schedule_mixes_every_prefix(spark):
    """Every beginning of the repeated rows is near the targets' shares."""
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('w ', 20) as text", "concat('s', id % 3) as source")
    out = [r["source"] for r in mixing.repeat(docs).collect()]
    shares = {r["source"]: r["target"] for r in mixing.targets(mixing.sized(docs)).collect()}
    whole = sum(shares.values())
    for n in (300, 1000, 2500, len(out)):
        have = Counter(out[:n])
        assert all(abs(have[s] / n - t / whole) < 0.03 for s, t in shares.items())
