"""Lookup joins: corrections, aliases, caches, inherited places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showbill.functions.text import clean_place, compact_title
from showbill.sources.shared import written


def override(events: DataFrame, overrides: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of curated overrides over those of events with the same compact title.

    overrides: title, start, end (null fits any), ord and new_<column>; non-empty values win, of several overrides the
    later. The equi-join on the title leaves the open dates to a filter, so no nested loop is planned.
    """
    o = overrides.select(compact_title("title").alias("_t"), F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("ord").alias("_o"), *[f"new_{c}" for c in columns])
    fits = (F.col("_s").isNull() | F.col("_s").eqNullSafe(F.col("start"))) & (F.col("_e").isNull() | F.col("_e").eqNullSafe(F.col("end")))
    hits = events.select("key", "start", "end", compact_title("title").alias("_t")).join(o, "_t").where(fits)
    filled = lambda c: F.col(f"new_{c}").isNotNull() & (F.col(f"new_{c}").cast("string") != "")
    best = hits.groupBy("key").agg(*[F.max_by(F.when(filled(c), F.col(f"new_{c}")), F.when(filled(c), F.col("_o"))).alias(f"new_{c}") for c in columns])
    joined = events.join(best, "key", "left")
    return joined.withColumns({c: F.coalesce(f"new_{c}", c) for c in columns}).drop(*[f"new_{c}" for c in columns])


def inherit_places(events: DataFrame, keys: list[str], places: int = 6) -> DataFrame:
    """Fills missing lat and lon from rows that share the first key that has one; place_source tells which.

    A key whose rows lie at more than one place (rounded) is ambiguous and gives nothing, under whichever of the keys it
    was found so.
    """
    at = F.struct(F.bround("lat", places).alias("lat"), F.bround("lon", places).alias("lon"))
    known = events.where("lat is not null and lon is not null")
    tables = {k: known.where(F.col(k).isNotNull() & (F.col(k) != "")).groupBy(F.col(k).alias("_k")).agg(F.min(at).alias("lo"), F.max(at).alias("hi")) for k in keys}
    unclear = None
    for t in tables.values():
        bad = t.where("lo <> hi").select("_k")
        unclear = bad if unclear is None else unclear.union(bad)
    out = events.withColumn("place_source", F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), "own"))
    for k, t in tables.items():
        clear = t.where("lo = hi").join(unclear, "_k", "left_anti").select(F.col("_k").alias(k), F.col("lo").alias("_at"))
        need = F.col("place_source").isNull() & F.col("_at").isNotNull()
        out = out.join(clear, k, "left").withColumns({"lat": F.when(need, F.col("_at.lat")).otherwise(F.col("lat")), "lon": F.when(need, F.col("_at.lon")).otherwise(F.col("lon")), "place_source": F.when(need, k).otherwise(F.col("place_source"))}).drop("_at")
    return out


def cached(events: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Adds cache_state: hit, known_missing (a cached null) or unknown, and the cached lat and lon."""
    c = cache.select(key, F.col("lat").alias("cached_lat"), F.col("lon").alias("cached_lon"), F.lit(True).alias("_in"))
    state = F.when(F.col("_in").isNull(), "unknown").when(F.col("cached_lat").isNull(), "known_missing").otherwise("hit")
    return events.join(c, key, "left").withColumn("cache_state", state).drop("_in")


def first_alias(names: Column, profiles: list[tuple[str, list[str]]]) -> Column:
    """The canonical name of the first profile with a pattern in the name, case ignored, else null; profiles are a fixed list, so no join is needed."""
    low = F.lower(names)
    tests = [F.when(F.greatest(*[F.contains(low, F.lit(p.lower())) for p in sorted(ps, key=len, reverse=True)] + [F.lit(False)]), F.lit(name)) for name, ps in profiles]
    return F.coalesce(*tests)


def _grams(text: Column, lengths: Column) -> Column:
    """The distinct substrings of a text that have one of the lengths."""
    of = lambda n: F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, n))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.flatten(F.transform(lengths, of)))


def pattern_matches(names: DataFrame, patterns: DataFrame, longest_gram: int = 3) -> DataFrame:
    """name, profile and pattern: for each distinct name the first profile that has a pattern in it, and of that profile the longest such pattern.

    names: name; patterns: profile (a number that orders profiles), pattern, place (of equally long ones the first counts). Case is ignored; names
    without a match have no row. The containment join runs through an inverted index: a pattern is looked up by the rarest of its
    grams among the names, a name by its grams that some pattern was given, and pairs that meet are verified. So a gram that most names hold
    is used only by patterns that have no other, and no pattern is compared with all names.
    """
    p = written(patterns.where("pattern <> ''").select("profile", "place", "pattern", F.lower("pattern").alias("_p")))
    n = written(names.where("name <> ''").select("name").distinct().withColumn("_n", F.lower("name")))
    length = F.least(F.length("_p"), F.lit(longest_gram))
    of_pattern = written(p.select("_p", F.explode(_grams(F.col("_p"), F.array(length))).alias("gram")).distinct())
    lengths = F.array(*map(F.lit, range(1, longest_gram + 1)))
    # Grams that no pattern has are left where they are found, before anything is shuffled by gram.
    of_name = written(n.select("name", "_n", F.explode(_grams(F.col("_n"), lengths)).alias("gram")).join(of_pattern.select("gram").distinct(), "gram", "left_semi"))
    held = of_name.groupBy("gram").agg(F.count("*").alias("_held"))
    # A pattern with a gram that no name has is in no name.
    rarest = of_pattern.join(held, "gram", "left").groupBy("_p").agg(F.min(F.struct(F.coalesce("_held", F.lit(0)).alias("h"), "gram")).alias("_g")).where("_g.h > 0")
    index = p.join(rarest.select("_p", "_g.gram"), "_p")
    met = of_name.join(index, "gram").where(F.contains("_n", F.col("_p")))
    best = F.min(F.struct("profile", (-F.length("pattern")).alias("l"), "place", "pattern"))
    return met.groupBy("name").agg(best.alias("_b")).select("name", "_b.profile", "_b.pattern")


def venue_names(events: DataFrame, profiles: DataFrame, venue: str = "venue", detail: str = "venue_detail", read: str | None = None) -> DataFrame:
    """events with the venue that a profile names and the rest of its old name as detail; venues of no profile stay as they are.

    read: the column that is searched, if it isn't the venue itself. profiles: profile, canonical, pattern, place, as feeds.read_profiles gives them: a table of any size, with the same rows as first_alias() for a short list.
    """
    shown = clean_place(read or venue)
    found = pattern_matches(events.select(shown.alias("name")), profiles)
    named = found.join(profiles.select("profile", "canonical").distinct(), "profile").select(F.col("name").alias("_shown"), "canonical", F.col("pattern").alias("_pattern"))
    joined = events.withColumn("_shown", shown).join(named, "_shown", "left")
    at = F.instr("_shown", F.col("_pattern"))
    rest = F.when(at > 0, F.concat(F.substring("_shown", F.lit(1), at - 1), F.substring("_shown", at + F.length("_pattern"), F.length("_shown")))).otherwise(F.col("_shown"))
    got = F.col("canonical").isNotNull()
    cut = F.regexp_replace(clean_place(rest), r"^[\s、,，/\-—－]+", "")
    return joined.withColumns({venue: F.when(got, F.col("canonical")).otherwise(F.col(venue)), detail: F.when(got, cut).otherwise(F.col(detail) if detail in events.columns else F.lit(""))}).drop("_shown", "canonical", "_pattern")


def with_venue_images(events: DataFrame, pictures: DataFrame) -> DataFrame:
    """events with shown_images and media: their own content images, else their venue's picture (venue, image), else nothing (`placeholder`)."""
    from showbill.functions import urls

    own = F.filter(urls.unique_urls(F.when(F.size("images") > 0, F.col("images")).otherwise(F.array("image"))), lambda u: urls.shows_content(u, "app"))
    picture = pictures.select(F.col("venue").alias("_venue"), urls.normalize_url("image").alias("_picture")).where((F.col("_picture") != "") & urls.shows_content(F.col("_picture"), "app") & ~urls.is_blocked("_picture")).groupBy("_venue").agg(F.min("_picture").alias("_picture"))
    joined = events.withColumn("_own", own).join(picture, events["venue"] == F.col("_venue"), "left")
    shown = F.when(F.size("_own") > 0, F.col("_own")).when(F.col("_picture").isNotNull(), F.array("_picture")).otherwise(F.array().cast("array<string>"))
    media = F.when(F.size("_own") > 0, "event").when(F.col("_picture").isNotNull(), "venue").otherwise("placeholder")
    return joined.withColumns({"shown_images": shown, "media": media}).drop("_own", "_venue", "_picture")
