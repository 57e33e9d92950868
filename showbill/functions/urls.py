"""URL expressions. Absolute URLs are repaired in the JVM; only relative ones need Python's resolver."""

from __future__ import annotations

from functools import reduce
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from showbill.functions.text import col, let, strip, unescape

# Fixed patterns: hosts that are blocked, that sell tickets, and that are social pages.
BLOCKED_HOST = r"(?i)(?:^|\.)(?:facebook\.com|fb\.me|fbcdn\.net|facebookusercontent\.com)$"
BLOCKED_PATH = r"(?:^|[/_.-])facebook(?:[/_.-]|$)"
SOCIAL_HOST = r"(?i)(?:^|\.)instagram\.com$"
TICKET_HOST = (
    r"(?i)(?:^|\.)(?:opentix\.life|kktix\.com|tixcraft\.com|accupass\.com|udnfunlife\.com|ticketplus\.com\.tw|"
    r"ibon\.com\.tw|famiticket\.com\.tw|ticketscloud\.org|artsticket\.com\.tw)$"
)
# Fixed patterns: parts of a path that mark interface images; the app profile wants them delimited and allows logos and icons.
INTERFACE_IMAGE = {
    "etl": r"(?i)(?:favicon|logo|icon|avatar|spacer|blank|loading|loader|spinner|progress|preload|placeholder|pixel|sprite|qr[_-]?code)",
    "app": r"(?i)(?:^|[/_.-])(?:favicon|avatar|spacer|blank|loading|loader|spinner|progress|preload|placeholder|pixel|sprite|qr[_-]?code)(?:[/_.-]|$)",
}
# Fixed patterns: file names of default pictures, and sizes of thumbnails.
DEFAULT_IMAGE = r"(?:^|[-_])default(?:[-_.]|$)|programinfodefault"
THUMBNAIL = r"(?:^|[/_-])(?:16x16|32x32|50x50|64x64|80x80|100x100)(?:[/_.-]|$)"
# Fixed pattern: hosts of public institutions.
PUBLIC_HOST = r"(?i)(?:^|\.)(?:culture\.tw|gov\.tw)$"


def joined(base: Column | str, ref: Column | str) -> Column:
    """A reference against an absolute http(s) base, in the JVM: absolute and scheme-relative references, paths from the root or
    beside the base, queries and fragments; up to eight steps to a parent directory are taken."""
    b, r = col(base), strip(F.coalesce(col(ref), F.lit("")))
    root = F.regexp_extract(b, r"(?i)^(https?://[^/?#]+)", 1)
    here = F.regexp_extract(b, r"(?i)^https?://[^/?#]+([^?#]*)", 1)
    beside = F.concat(root, F.when(here == "", "/").otherwise(F.regexp_extract(here, "^(.*/)", 1)), r)
    full = (
        F.when(r.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), r).when(r.startswith("//"), F.concat(F.regexp_extract(b, "(?i)^(https?:)", 1), r))
        .when(r.startswith("/"), F.concat(root, r)).when(r.startswith("?"), F.concat(root, here, r)).when(r.startswith("#") | (r == ""), F.concat(F.regexp_extract(b, "^([^#]*)", 1), r)).otherwise(beside)
    )

    def plain(u: Column) -> Column:
        u = F.regexp_replace(u, r"/(?:\./)+", "/")
        for _ in range(8):
            u = F.regexp_replace(u, r"(?i)^(https?://[^/?#]+(?:/[^/?#]+)*?)/(?!\.\./)[^/?#]+/\.\./", "$1/")
        return F.regexp_replace(u, r"(?i)^(https?://[^/?#]+)/(?:\.\./)+", "$1/")

    return let(full, lambda u: F.when(u.rlike(r"/\.\.?/"), plain(u)).otherwise(u))


@F.pandas_udf(StringType())
def resolve(base: pd.Series, url: pd.Series) -> pd.Series:
    """Relative references against a base; null where either can't be read."""

    def one(b, u):
        try:
            return urljoin(b or "", u) if u is not None else None
        except ValueError:
            return None

    return pd.Series([one(b, u) for b, u in zip(base, url, strict=True)], dtype=object)


#: A URL that needs no repair: plain authority and path, no second URL within, no route that is rewritten.
PLAIN_URL = r"""^https?://(?!(?i:(?:www\.)?opentix\.life/program/))(?!(?i:.*https?(?::|%3a)))[A-Za-z0-9][A-Za-z0-9.-]*(?::\d+)?(?:[/?#][^\s&"'<>\\]*)?\z"""


def normalize_url(c: Column | str, base: str | None = None) -> Column:
    """An absolute http(s) URL, repaired; an empty string for anything else. With a base, references that aren't absolute are taken against it.

    Repairs: entities, escaped slashes, a scheme written twice, an encoded scheme, a missing scheme before //, and prose
    glued to the host, of which the leading valid part is kept.
    """

    def repaired(t: Column) -> Column:
        t = F.regexp_replace(strip(unescape(t)), r"""^["']+|["']+$""", "")
        t = F.regexp_replace(F.replace(t, F.lit("\\/"), F.lit("/")), r"(?is)^https?://[^/?#]+(https?://.+)$", "$1")
        # After quoted markup, the last of several URLs counts, up to the next quote.
        t = F.regexp_replace(t, r"""(?is)^.*https?://.*(?:\\?&q;|\\?&quot;|["'<>]).*(https?://(?:(?!\\?&q;|\\?&quot;|https?://)[^"'<>\\\s])*).*$""", "$1")
        t = let(t, lambda x: F.when(x.rlike(r"(?i)^https?%3A"), F.try_url_decode(x)).otherwise(x))
        t = F.regexp_replace(t, "^//", "https://")
        # Of an authority with other characters, the valid beginning stays and the rest of the URL goes; none may be left.
        t = F.regexp_replace(t, r"(?i)^(https?://[A-Za-z0-9.-]+(?::\d+)?)[^A-Za-z0-9.\-:\[\]/?#\s].*$", "$1")
        if base is not None:
            t = let(t, lambda x: F.when((x == "") | x.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), x).otherwise(joined(F.lit(base), x)))
        # One ticket host serves an event's content at its event route only.
        t = F.regexp_replace(t, r"(?i)^(https?://(?:www\.)?opentix\.life)/program/(\d+/?)(?=$|[?#])", "$1/event/$2")
        return F.regexp_extract(t, r"(?is)^https?://[A-Za-z0-9\[][^/?#\s]*.*$", 0)

    return let(F.coalesce(col(c), F.lit("")), lambda t: F.when((t == "") | t.rlike(PLAIN_URL), t).otherwise(repaired(t)))


def host_of(u: Column) -> Column:
    return F.lower(F.regexp_extract(u, r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def path_of(u: Column) -> Column:
    return F.regexp_extract(u, r"(?is)^https?://[^/?#]*([^?#]*)", 1)


def url_host(c: Column | str) -> Column:
    return host_of(normalize_url(c))


def url_path(c: Column | str) -> Column:
    return path_of(normalize_url(c))


def decoded_path(u: Column) -> Column:
    return F.lower(F.coalesce(F.try_url_decode(path_of(u)), F.lit("")))


def is_blocked(c: Column | str) -> Column:
    return let(normalize_url(c), lambda u: (u != "") & (host_of(u).rlike(BLOCKED_HOST) | decoded_path(u).rlike(BLOCKED_PATH)))


def is_blocked_group(c: Column | str) -> Column:
    """A group's page on a blocked host."""
    return let(normalize_url(c), lambda u: host_of(u).rlike(BLOCKED_HOST) & F.contains(F.lower(path_of(u)), F.lit("/groups/")))


def is_ticketing(c: Column | str) -> Column:
    return url_host(c).rlike(TICKET_HOST)


def is_ticket_home(c: Column | str) -> Column:
    """A ticket host's front page, which says nothing of an event."""
    return let(normalize_url(c), lambda u: u.rlike(r"^https?://[^/?#]+/*$") & host_of(u).rlike(TICKET_HOST))


def needs_title_check(c: Column | str) -> Column:
    return let(url_host(c), lambda h: h.rlike(TICKET_HOST) | h.rlike(SOCIAL_HOST))


def is_content_image(c: Column | str, profile: str = "etl") -> Column:
    return let(normalize_url(c), lambda u: (u != "") & shows_content(u, profile))


def shows_content(u: Column, profile: str = "etl") -> Column:
    """Whether a repaired URL's path may be an event's picture; the app profile only leaves out interface images."""
    path = decoded_path(u)
    bad = [path.rlike(INTERFACE_IMAGE[profile])]
    if profile == "etl":
        bad += [F.regexp_extract(path, "[^/]*$", 0).rlike(DEFAULT_IMAGE), path.rlike(r"\.(?:svg|gif|ico)$"), path.rlike(THUMBNAIL)]
    return ~reduce(lambda a, b: a | b, bad)


def unique_urls(urls: Column | str) -> Column:
    """Repaired, without blocked hosts, each once, in order."""
    return F.array_distinct(F.filter(F.transform(col(urls), normalize_url), lambda u: (u != "") & ~(host_of(u).rlike(BLOCKED_HOST) | decoded_path(u).rlike(BLOCKED_PATH))))


def encode(c: Column | str) -> Column:
    """Percent-encoding with %20 for spaces."""
    return F.replace(F.url_encode(col(c)), F.lit("+"), F.lit("%20"))
