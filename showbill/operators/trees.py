"""JSON trees of any depth and shape: a recursive query over rows, and the same descent within one expression.

Members keep the order in which they are written, which VARIANT objects don't: a container's children are read as texts, in
order, and beside them as VARIANTs, which tell a nested object from a text that looks like one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showbill.functions.text import let, strip
from showbill.sources.shared import written

#: What opens a container, also where a text within a text escapes it.
OPENERS = r"[\[{]|\\u00[57][bB]"


def kind(v: Column) -> Column:
    """object, array or value."""
    listed, named = F.try_variant_get(v, "$", "array<variant>"), F.try_variant_get(v, "$", "map<string,variant>")
    # The schema of a VARIANT is that of all within; its members alone are a cut.
    return F.when(named.isNotNull(), "object").when(listed.isNotNull(), "array").otherwise("value")


def parsed(json: Column | str) -> Column:
    """A JSON text's VARIANT, null where it isn't JSON."""
    return F.try_parse_json(json)


def children(json: Column, of: Column) -> Column:
    """The members or elements of a container in their order: array of struct(name, json, kind); name is null in arrays. A text's json is the text itself."""
    # Only what begins like a container is asked for its kind.
    opens = lambda t: F.coalesce(t.rlike(r"^\s*[\[{]"), F.lit(False))
    one = lambda x: F.struct(x["name"].alias("name"), x["json"].alias("json"), F.when(opens(x["json"]), F.coalesce(kind(x["v"]), F.lit("value"))).otherwise("value").alias("kind"))
    texts, values = F.from_json(json, "map<string,string>"), F.from_json(json, "map<string,variant>")
    members = F.arrays_zip(F.map_keys(texts).alias("name"), F.map_values(texts).alias("json"), F.map_values(values).alias("v"))
    items = F.from_json(json, "array<string>")
    elements = F.arrays_zip(F.transform(items, lambda _: F.lit(None).cast("string")).alias("name"), items.alias("json"), F.from_json(json, "array<variant>").alias("v"))
    return F.when(of == "object", F.transform(members, one)).otherwise(F.transform(elements, one))


def objects(rows: DataFrame, json: str, keys: Sequence[str]) -> DataFrame:
    """The keys, path and json of every object in each row's JSON text, however deep.

    path: the position in each container from the root down, so that rows of a tree in the order of path are the tree in
    depth-first order. Texts that aren't JSON, and null, have no objects. A recursive query: each step opens all
    containers of one depth, writes what is within and reads it again, and none is left after as many steps as the deepest tree has
    levels (the JSON reader refuses more than 1,000).
    """
    root = rows.select(*keys, F.array().cast("array<int>").alias("path"), F.col(json).alias("json"), kind(parsed(json)).alias("kind"))
    level, found = written(root.where("kind <> 'value'")), []
    while not level.isEmpty():
        found.append(level.where("kind = 'object'").select(*keys, "path", "json"))
        within = level.select(*keys, "path", F.posexplode(children(F.col("json"), F.col("kind"))).alias("at", "c"))
        level = written(within.where("c.kind <> 'value'").select(*keys, F.concat("path", F.array("at")).alias("path"), "c.json", "c.kind"))
    out = level.select(*keys, "path", "json") if not found else found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def leaves(c: Column | str, preferred: Sequence[str]) -> Column:
    """The texts in a value that is a text, or JSON of lists and objects nested to any depth, also within texts; in order, blank ones left out.

    Of an object's members those named in `preferred` count, in that order, if it has any, else all. Each round opens
    the containers there are; a text has at most as many depths as characters that open one.
    """
    opens = lambda t: t.rlike(r"(?s)^\s*(?:\[.*\]|\{.*\})\s*$")

    def opened(t: Column) -> Column:
        m = F.from_json(strip(t), "map<string,string>")
        named = F.transform(F.filter(F.array(*map(F.lit, preferred)), lambda k: F.map_contains_key(m, k)), lambda k: F.try_element_at(m, k))
        members = F.when(F.size(named) > 0, named).otherwise(F.map_values(m))
        inner = F.when(strip(t).startswith("{"), members).otherwise(F.from_json(strip(t), "array<string>"))
        return F.when(opens(t) & parsed(t).isNotNull(), F.coalesce(F.array_compact(inner), F.array(t))).otherwise(F.array(t))

    def descended(t: Column) -> Column:
        rounds = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(F.regexp_extract_all(t, F.lit(f"({OPENERS})")))))
        step = lambda acc, _: F.when(F.exists(acc, opens), F.flatten(F.transform(acc, opened))).otherwise(acc)
        return F.aggregate(rounds, F.array(t), step)

    value = F.col(c) if isinstance(c, str) else c
    found = let(value, lambda t: F.when(opens(t), descended(t)).otherwise(F.array(t)))
    return F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda x: strip(x) != "")
