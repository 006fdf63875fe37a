"""Deeply nested records as related flat tables.

Method: a merged schema is inferred from all records of a group (an endpoint, say); each array level is exploded
into child rows that carry their parent's surrogate key and the ordinal in the array. The levels are a table that
the rows are joined with, so there is one pass for each depth of nesting, whatever the number of levels.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import at_hand, saved

#: Kinds of JSON values in the merged schema.
KINDS = "object, array, string, number, boolean, null"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often it occurs in it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parsed(text: Column) -> Column:
    """The JSON text as variant; null where it isn't valid. A byte order mark is dropped, JSON given as a JSON string is opened, however often it was wrapped.

    Each wrapping doubles the backslashes, so a text of n characters is wrapped log2(n) + 2 times at most.
    """

    def open_all(t: Column) -> Column:
        rounds = F.sequence(F.lit(1), F.ceil(F.log2(F.length(t) + 2)).cast("int") + 2)
        unwrapped = lambda x, _: F.when(x.startswith('"'), F.trim(F.try_variant_get(F.try_parse_json(x), "$", "string"))).otherwise(x)
        return F.when(t.startswith('"'), F.aggregate(rounds, t, unwrapped)).otherwise(t)

    return F.try_parse_json(_once(F.regexp_replace(text, "^[\\uFEFF\\s]+", ""), open_all))


def document(body: Column) -> Column:
    """The body as variant; see parsed."""
    return parsed(body)


def text_at(node: Column, path: str | Column) -> Column:
    """A scalar as trimmed text, null where it is missing, null, or blank. A path as text is relative to the node, one as column begins with $."""
    value = F.trim(F.try_variant_get(node, f"$.{path}" if isinstance(path, str) else path, "string"))
    return F.when(value != "", value)


def elements(node: Column) -> Column:
    """array<variant>: a list's elements, or the one object that stands where a list is usual, either of them perhaps as JSON text."""

    def listed(v: Column) -> Column:
        single = F.when(F.try_variant_get(v, "$", "map<string,variant>").isNotNull(), F.array(v))
        return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), single)

    def opened(v: Column) -> Column:
        return F.coalesce(parsed(F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))), v)

    return _once(node, lambda v: listed(F.when(F.schema_of_variant(v) == "STRING", opened(v)).otherwise(v)))


def _child(path: str, name: str) -> str | None:
    """The path of a field, in the notation of variant paths; None for a name that it can't say."""
    if name and not any(c in ".[]'\"" for c in name):
        return f"{path}.{name}" if path else name
    return f"{path}['{name}']" if name and "'" not in name else f'{path}["{name}"]' if name and '"' not in name else None


def _walk(value: object, path: str, found: dict) -> None:
    kind = (
        "object" if isinstance(value, dict) else "array" if isinstance(value, list) else "string" if isinstance(value, str)
        else "boolean" if isinstance(value, bool) else "null" if value is None else "number"
    )
    found[path, kind] = found.get((path, kind), 0) + 1
    if kind == "object":
        for name, child in value.items():
            if (there := _child(path, name)) is not None:
                _walk(child, there, found)
    elif kind == "array":
        for child in value:
            _walk(child, path, found)


def merged_schema(records: DataFrame, variant: str, group: str | None = None) -> DataFrame:
    """(_group, path, kind, n): every path of any record of a group with each kind of value seen there, over all records.

    An array's elements are counted at the array's own path. Each task hands on one row per path and
    kind, so what is shuffled grows with the schema, not with the records. Without `group` _group is ''.
    """

    def catalogue(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, dict] = {}
        for batch in batches:
            for name, body in zip(batch["_group"], batch["body"]):
                _walk(json.loads(body), "", found.setdefault(name, {}))
        rows = [(name, *k, n) for name, own in found.items() for k, n in own.items()]
        if rows:
            yield pd.DataFrame(rows, columns=["_group", "path", "kind", "n"])

    own = F.coalesce(F.col(group).cast("string"), F.lit("")) if group else F.lit("")
    bodies = records.where(F.col(variant).isNotNull()).select(own.alias("_group"), F.to_json(F.col(variant)).alias("body"))
    return bodies.mapInPandas(catalogue, "_group string, path string, kind string, n long").groupBy("_group", "path", "kind").agg(F.sum("n").alias("n"))


def inside(path: Column, level: Column) -> Column:
    """Whether a path lies at or below a level; '' is the record itself."""
    return (level == "") | (path == level) | path.startswith(F.concat(level, F.lit("."))) | path.startswith(F.concat(level, F.lit("[")))


def relative(path: Column, level: Column) -> Column:
    """A path below a level as variant path from the level's node."""
    rest = F.substring(path, F.length(level) + 1, F.length(path))
    return F.when(rest == "", "$").when(rest.startswith(".") | rest.startswith("["), F.concat(F.lit("$"), rest)).otherwise(F.concat(F.lit("$."), rest))


def array_levels(schema: DataFrame) -> DataFrame:
    """(_group, level, _above, _inner, depth): the paths where any record of a group has an array, each with the nearest level above it ('' is the record).

    The table is of the schema's size.
    """
    paths = schema.where("kind = 'array'").select("_group", F.col("path").alias("level")).distinct()
    above = paths.alias("c").join(paths.alias("p"), (F.col("c._group") == F.col("p._group")) & (F.col("c.level") != F.col("p.level")) & inside(F.col("c.level"), F.col("p.level")))
    nearest = above.where("p.level <> ''").groupBy("c._group", "c.level").agg(F.max_by("p.level", F.length("p.level")).alias("_above"), F.count("*").alias("_n"))
    named = paths.join(nearest, ["_group", "level"], "left").select("_group", "level", F.coalesce("_above", F.lit("")).alias("_above"), (F.coalesce("_n", F.lit(0)) + 1).alias("depth"))
    return named.select("_group", "level", "_above", relative(F.col("level"), F.col("_above")).alias("_inner"), "depth")


def exploded(records: DataFrame, key: str, variant: str, group: str | None = None, schema: DataFrame | None = None) -> DataFrame:
    """The rows of all levels: key, _group, level, _sk, _parent_sk, _ordinal, _up, _node.

    level '' has the records themselves. _sk is the surrogate key, the place of the row in its record; _ordinal counts from 0; _up
    lists (level, sk) of the row and all above it; _node is the row as variant. `key` must tell the records apart. A single object
    where other records have a list is a list of one; nulls, and scalars where containers are usual, give no rows; elements that are no
    objects stay, as scalars. The schema is inferred unless it is given. Explodes are narrow: no record is shuffled.
    """
    schema = merged_schema(records, variant, group) if schema is None else schema
    levels = saved(array_levels(schema), "levels")
    deepest, n_levels = levels.agg(F.coalesce(F.max("depth"), F.lit(0)), F.count("*")).first()
    own = F.coalesce(F.col(group).cast("string"), F.lit("")) if group else F.lit("")
    root = F.struct(F.lit("").alias("level"), F.lit("$").alias("sk"))
    rows = records.where(F.col(variant).isNotNull()).select(
        key, own.alias("_group"), F.lit("").alias("level"), F.lit("$").alias("_sk"), F.lit(None).cast("string").alias("_parent_sk"), F.lit(0).alias("_ordinal"), F.array(root).alias("_up"), F.col(variant).alias("_node")
    )
    found = [rows]
    for depth in range(1, deepest + 1):
        own_levels = at_hand(levels.where(F.col("depth") == depth).withColumnRenamed("level", "_level"), n_levels)
        met = rows.join(own_levels, (rows["_group"] == own_levels["_group"]) & (rows["level"] == own_levels["_above"])).drop(own_levels["_group"])
        each = met.select(key, "_group", F.col("_level").alias("level"), F.col("_sk").alias("_parent_sk"), "_inner", "_up", F.posexplode(elements(F.try_variant_get("_node", F.col("_inner"), "variant"))).alias("_ordinal", "_node"))
        sk = F.concat("_parent_sk", F.substring("_inner", 2, 1_000_000), F.lit("["), F.col("_ordinal").cast("string"), F.lit("]"))
        up = F.concat("_up", F.array(F.struct(F.col("level"), F.col("_sk").alias("sk"))))
        rows = saved(each.withColumn("_sk", sk).select(key, "_group", "level", "_sk", "_parent_sk", "_ordinal", up.alias("_up"), "_node"), "level")
        found.append(rows)
    return reduce(DataFrame.unionByName, found)


def values(rows: DataFrame, key: str, schema: DataFrame) -> DataFrame:
    """(key, level, _sk, _parent_sk, _ordinal, name, value): every scalar of the rows of `exploded`, by the name it has in its level; null ones left out.

    So levels of any number of fields are one table.
    """
    fields = homes(schema.where("kind not in ('object', 'array', 'null')").select("_group", "path").distinct(), rows_levels(schema), "path")
    fields = fields.select("_group", F.col("home").alias("level"), relative(F.col("path"), F.col("home")).alias("_rel"))
    each = rows.join(at_hand(saved(fields, "fields")), ["_group", "level"]).withColumn("value", F.try_variant_get("_node", F.col("_rel"), "string")).where("value is not null")
    return each.select(key, "level", "_sk", "_parent_sk", "_ordinal", F.regexp_replace("_rel", r"^\$\.?", "").alias("name"), "value")


def rows_levels(schema: DataFrame) -> DataFrame:
    """(_group, level): the array levels and '' of every group."""
    return schema.where("kind = 'array'").select("_group", F.col("path").alias("level")).unionByName(schema.select("_group", F.lit("").alias("level"))).distinct()


def homes(paths: DataFrame, levels: DataFrame, path: str, name: str = "home", also: str | None = None) -> DataFrame:
    """Adds `name`, the nearest level at or above a path (and, with `also`, at or above that level). Tables of the schema's size."""
    p, lv = paths.alias("p"), levels.alias("l")
    fits = (F.col("p._group") == F.col("l._group")) & inside(F.col(f"p.{path}"), F.col("l.level"))
    if also:
        fits &= inside(F.col(f"p.{also}"), F.col("l.level"))
    columns = [F.col(f"p.{c}") for c in paths.columns]
    return p.join(lv, fits).groupBy(*columns).agg(F.max_by("l.level", F.length("l.level")).alias(name))


def flat_tables(records: DataFrame, key: str, variant: str, most_columns: int = 2_000) -> dict[str, DataFrame]:
    """Every array level as a flat table: key, _sk, _parent_sk, _ordinal and a text column for each scalar path.

    Columns are part of the plan: with more than `most_columns` in all, use `values`, which has a row for each instead.
    """
    schema = saved(merged_schema(records, variant), "schema")
    fields = homes(schema.where("kind not in ('object', 'array', 'null')").select("_group", "path").distinct(), rows_levels(schema), "path")
    fields = fields.select("home", relative(F.col("path"), F.col("home")).alias("rel")).orderBy("home", "rel").limit(most_columns + 1).collect()
    if len(fields) > most_columns:
        raise ValueError(f"more than {most_columns} scalar paths: take values()")
    rows = exploded(records, key, variant, schema=schema)
    found = {}
    for level in [r[0] for r in rows_levels(schema).select("level").distinct().limit(most_columns).collect()]:
        own = [f["rel"] for f in fields if f["home"] == level]
        found[level] = rows.where(F.col("level") == level).select(
            key, "_sk", "_parent_sk", "_ordinal", *[F.try_variant_get("_node", p, "string").alias(p.lstrip("$.").replace(".", "__") or "value") for p in own]
        )
    return found
