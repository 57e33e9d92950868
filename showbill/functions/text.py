"""Text expressions: Column in, Column out. Regular expressions are Java's; (?U) makes \\s and \\w cover all of Unicode."""

from __future__ import annotations

import difflib
import html
import html.entities
import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

#: A run of blanks is followed to the end from its first one only.
BLANK = r"(?U)^\s+|(?<!\s)\s+$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(c: Column, f) -> Column:
    """f of c, with c computed once however often f uses it: chains of such steps would otherwise grow exponentially.
    try_element_at() and not get(), which derives its type anew, down the whole chain, for every row."""
    return F.try_element_at(F.transform(F.array(c), f), F.lit(1))


def strip(c: Column | str) -> Column:
    """Trims all Unicode white space, unlike trim, which takes spaces only."""
    return F.regexp_replace(col(c), BLANK, "")


def first_value(*cs: Column | str, profile: str = "etl") -> Column:
    """The first value that isn't blank, untrimmed; an empty string if there is none. In the app profile "0" is blank too."""
    blank = lambda x: (strip(x) == "") | (x == "0") if profile == "app" else strip(x) == ""
    return F.coalesce(F.try_element_at(F.filter(F.array(*[col(c) for c in cs]), lambda x: ~blank(x)), F.lit(1)), F.lit(""))


#: The entities that most texts hold; `&amp;` comes last, so that no entity is decoded twice.
ENTITIES = [("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]


def unescape(c: Column | str) -> Column:
    """Common entities, as a short chain that may stand anywhere; unescape_all() decodes more, html_unescape() all of them."""
    return reduce(lambda e, x: F.replace(e, F.lit(x[0]), F.lit(x[1])), ENTITIES, col(c))


#: An entity: a name from the HTML table, or a decimal or hexadecimal code.
ENTITY = r"&(?:#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[A-Za-z][A-Za-z0-9]{1,31};?)"


def _entity_table() -> dict[str, str]:
    """The names of HTML 4 and their characters, and the capital spellings that HTML 5 added. Rarer names of HTML 5 aren't in it."""
    capital = {n: html.entities.html5[f"{n};"] for n in ("AMP", "LT", "GT", "QUOT", "COPY", "REG")}
    return {n: chr(c) for n, c in sorted(html.entities.name2codepoint.items())} | {"apos": "'"} | capital


def unescape_all(c: Column | str) -> Column:
    """Numeric entities and the names of HTML 4, in the JVM: the distinct entities of a text are looked up, and texts without an
    ampersand are left as they are. html_unescape() decodes all of HTML 5, in Python.

    Without a semicolon, names of Latin-1 characters are decoded, as HTML allows. Each entity is decoded once: a marker
    stands for a decoded ampersand until all others are done.
    """
    names = F.from_json(F.lit(json.dumps(_entity_table())), "map<string,string>")

    def named(body: Column) -> Column:
        return let(F.try_element_at(names, F.rtrim(body, F.lit(";"))), lambda x: F.when(body.endswith(";") | (x < F.lit("\u0100")), x))

    def decoded(entity: Column) -> Column:
        body = F.substring(entity, 2, 40)
        digits = F.regexp_extract(body, r"^#([0-9]+)", 1)
        code = F.when(digits != "", digits.try_cast("int")).otherwise(F.conv(F.regexp_extract(body, r"^#[xX]([0-9a-fA-F]+)", 1), 16, 10).try_cast("int"))
        # A code's character, from the four bytes of UTF-32; codes that stand for none give the replacement character.
        valid = lambda n: n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        char = let(code, lambda n: F.when(valid(n), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd")))
        return F.when(body.startswith("#"), char).otherwise(named(body))

    def all_of(t: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(t, F.lit(f"({ENTITY})")))
        # Longer ones first, so that none is taken for the beginning of another.
        ordered = F.array_sort(found, lambda a, b: F.length(b) - F.length(a))
        swap = lambda text, e: F.replace(text, e, F.coalesce(F.replace(decoded(e), F.lit("&"), F.lit("\ue000")), e))
        return F.replace(F.aggregate(ordered, t, swap), F.lit("\ue000"), F.lit("&"))

    return let(col(c), lambda t: F.when(F.contains(t, F.lit("&")), all_of(t)).otherwise(t))


@F.pandas_udf(StringType())
def html_unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def untagged(t: Column, decode=unescape) -> Column:
    """Decoded, line-break tags as line feeds, other tags dropped. After a < that nothing closes the rest is taken at once and left as it is; each < of it would otherwise be followed to the end."""
    return F.regexp_replace(F.regexp_replace(decode(t), r"(?i)<br\s*/?>", "\n"), r"(<[^>]++\z)|<[^>]++>", "$1")


#: What cleaning changes: entities, tags, blanks other than single spaces, and any at the ends. Most fields hold none of it and are left as they are.
UNCLEAN = r"(?U)[&<\t\r\n\f\x0B]|  |^\s|\s$"


def clean_text(c: Column | str, decode=unescape) -> Column:
    """Decoded, line-break tags as line feeds, other tags dropped, runs of blanks and of empty lines shortened, trimmed; null gives an empty string."""

    def cleaned(t: Column) -> Column:
        t = F.regexp_replace(untagged(t, decode), r"[ \t\r\f\x0B]+", " ")
        return strip(F.regexp_replace(t, r"\n{3,}", "\n\n"))

    return let(F.coalesce(col(c), F.lit("")), lambda t: F.when(t.rlike(UNCLEAN), cleaned(t)).otherwise(t))


#: What cleaning a place changes besides: marks at the ends, and wide gaps.
UNCLEAN_PLACE = UNCLEAN + r"|^[=＝:：;；|｜]|[=＝:：;；|｜]$|\s{2}"


def clean_place(c: Column | str) -> Column:
    def cleaned(t: Column) -> Column:
        t = F.regexp_replace(clean_text(t), r"^[=＝:：;；|｜]+|[=＝:：;；|｜]+$", "")
        return F.regexp_replace(strip(t), r"(?U)\s{2,}", " ")

    return let(F.coalesce(col(c), F.lit("")), lambda t: F.when(t.rlike(UNCLEAN_PLACE), cleaned(t)).otherwise(t))


# Fixed words: platform names that titles carry and comparisons ignore.
PLATFORM_WORDS = "opentix|kktix|tixcraft|accupass|udn售票|寬宏售票|年代售票|facebook"


def compact_title(c: Column | str) -> Column:
    """The key by which titles are compared: lower-case letters, digits and Han characters only."""
    t = F.regexp_replace(F.lower(clean_text(c)), r"https?://\S+", "")
    return F.regexp_replace(F.regexp_replace(t, f"(?i)(?:{PLATFORM_WORDS})", ""), r"[^0-9a-z㐀-鿿]+", "")


def drop_lines(c: Column | str, pattern: str) -> Column:
    """The text without the lines that match the pattern; the rest trimmed, blank lines dropped."""
    lines = F.transform(F.split(col(c), r"\R"), strip)
    return F.array_join(F.filter(lines, lambda x: (x != "") & ~x.rlike(pattern)), "\n")


def split_values(c: Column | str) -> Column:
    """The parts of a list written with commas, slashes, bars or semicolons."""
    return F.filter(F.transform(F.split(clean_text(c), r"[、,，/|;；]+"), strip), lambda x: x != "")


def stable_id(*cs: Column | str) -> Column:
    """The first 18 hex digits of the SHA-1 of the non-blank cleaned values, joined by bars."""
    return F.substring(F.sha1(F.concat_ws("|", *[let(clean_text(c), lambda t: F.when(t != "", t)) for c in cs])), 1, 18)


def bigrams(c: Column | str) -> Column:
    """The distinct pairs of neighbouring characters. The text is computed and cut into characters once: finding the n-th in a text reads all before it."""
    pairs = lambda x: F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(F.size(x) - 2, F.lit(0))), lambda i: F.concat(F.get(x, i), F.get(x, i + 1))))
    return let(col(c), lambda t: F.when(F.length(t) < 2, F.array().cast("array<string>")).otherwise(let(F.split(t, ""), pairs)))


@F.pandas_udf(DoubleType())
def similarity_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio of two strings; no built-in equals it."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)])


# Fixed words: parts of titles that say nothing of an event.
COMMON_TOKENS = ("展覽", "活動", "特展", "台灣", "臺灣")


def title_tokens(title: Column | str) -> Column:
    """The parts of a title between marks that can be told on a page: compact, of two characters at least, no common word."""
    parts = F.transform(F.split(clean_text(title), r"(?U)[\s：:、,，/|()（）【】《》\-—]+"), lambda t: compact_title(t))
    return F.filter(parts, lambda t: (F.length(t) >= 2) & ~t.isin(*COMMON_TOKENS))


def token_coverage(title: Column | str, plain: Column) -> Column:
    """The share of a title's tokens that a compact text holds; null without tokens."""
    told = lambda x: F.try_divide(F.size(F.filter(x["ts"], lambda t: F.contains(x["plain"], t))), F.size(x["ts"]))
    return let(F.struct(title_tokens(title).alias("ts"), plain.alias("plain")), told)


def title_score(expected: Column | str, candidate: Column | str, page: Column | str | None = None, ratio: bool = True, plain: Column | str | None = None) -> Column:
    """How surely a page titled `candidate` is about `expected`, 0 to 1, to 4 places: the best of several measures.

    The ratio of matching blocks (a Python function, left out with ratio=False), containment either way, the share of
    the expected title's pairs of characters, whether the title occurs in the whole page, and the share of its tokens that do.
    plain: the page compacted, instead of it, where it is compared with many titles.
    """
    zero = F.lit(0.0)
    titles = [compact_title(expected), compact_title(candidate)]
    read = F.struct(*[t.alias(n) for t, n in zip(titles, "ec")], (similarity_ratio(*titles) if ratio else zero).alias("ratio"))

    def scored(x: Column) -> Column:
        e, c = x["e"], x["c"]
        held = let(bigrams(e), lambda b: F.coalesce(F.try_divide(F.size(F.array_intersect(b, bigrams(c))), F.size(b)), zero))
        best = F.when(c == "", zero).otherwise(F.greatest(F.when(F.contains(c, e), 0.98).when((F.length(c) >= 6) & F.contains(e, c), 0.88).otherwise(zero), held, x["ratio"]))
        if page is not None or plain is not None:
            on_page = lambda plain: F.when(plain == "", zero).otherwise(F.greatest(F.when(F.contains(plain, e), 0.92).otherwise(zero), 0.82 * F.coalesce(token_coverage(expected, plain), zero)))
            best = F.greatest(best, let(compact_title(page) if plain is None else col(plain), on_page))
        return F.when(e == "", zero).otherwise(F.bround(best, 4))

    return let(read, scored)


def summary(c: Column | str, most: int = 180) -> Column:
    return F.when(F.length(col(c)) > most, F.concat(F.rtrim(F.substring(col(c), 1, most)), F.lit("…"))).otherwise(col(c))


def checksum(c: Column | str) -> Column:
    """Sum of the character codes, modulo 997."""
    return F.aggregate(F.split(col(c), ""), F.lit(0), lambda a, x: a + F.ascii(x)) % 997
