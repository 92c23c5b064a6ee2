"""Attribute-value rows into wide tables: one row per entity, typed columns.

Pairs are first resolved per (entity, name) with a partial, map-side aggregate, so
that an entity holding a third of all rows costs one aggregation buffer per name
and no more; only then is each entity's handful of winners gathered into a
key-value map of their texts as they stand, from which the known keys are projected and
cast. What doesn't cast stays, as text, in a map of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that stand for no value.
NO_VALUE = ("na", "n/a", "null")
TEXT = "string"


def has_value(value: Column) -> Column:
    """Whether a text says anything: it has a letter or digit (A-Z, a-z, 0-9) and isn't NA, N/A or null."""
    return value.rlike("[A-Za-z0-9]") & ~F.lower(value).isin(*NO_VALUE)


def leading_number(value: Column) -> Column:
    """The whole number that a text begins with, without leading zeros; '' if there is none."""
    return F.regexp_extract(value, r"^0*(\d+)", 1)


def widen(pairs: DataFrame, entity: Sequence[str], name: str, value: str, columns: Mapping[str, str], latest: Sequence[Column]) -> DataFrame:
    """One row per entity: each of ``columns`` (name -> Spark type) as a typed column,
    ``other`` with the names that aren't columns, ``cast_failures`` with the texts that
    their column's type can't hold.

    Columns that aren't strings are whole numbers: a value is the number that it begins
    with. Values that say nothing (:func:`has_value`) fill nothing. Of several values of
    a cell the one with the greatest ``latest`` key counts, nulls being least and ties
    going to the later columns and at last to the greatest value; values that don't
    begin with a number don't compete for a number's cell, but the latest of them is kept
    in cast_failures, and so is a number beyond the type. Names absent from an entity give
    null. The result has a row for every entity with a value and no others; an empty
    input gives an empty table.
    """
    keys = [F.col(f"`{c}`") for c in entity]
    key, text = F.col(f"`{name}`"), F.col(f"`{value}`")
    numbers = [c for c, kind in columns.items() if kind != TEXT]
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(latest)], text.alias("v"))
    is_number = key.isin(*numbers) if numbers else F.lit(False)
    fits = F.when(is_number, text.rlike("^[0-9]")).otherwise(True)
    rows = pairs.filter(text.isNotNull() & has_value(text))
    won = rows.groupBy(*keys, key.alias("__name")).agg(F.max(F.when(fits, order))["v"].alias("__v"), F.max(F.when(~fits, order))["v"].alias("__f"))
    as_map = lambda c: F.map_from_entries(F.array_compact(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(F.col("__name").alias("key"), F.col(c).alias("value"))))))
    maps = won.groupBy(*keys).agg(as_map("__v").alias("__map"), as_map("__f").alias("__failed"))
    at = {c: F.col("__map")[c] for c in columns}
    cast = {c: (at[c] if kind == TEXT else leading_number(at[c]).try_cast(kind)) for c, kind in columns.items()}
    too_long = F.array_compact(F.array(*[F.when(at[c].isNotNull() & cast[c].isNull(), F.struct(F.lit(c).alias("key"), at[c].alias("value"))) for c in numbers] or [F.lit(None).cast("struct<key:string,value:string>")]))
    beyond = F.map_from_entries(too_long)
    return maps.select(
        *keys,
        *[cast[c].alias(c) for c in columns],
        F.map_filter("__map", lambda k, v: ~k.isin(*columns)).alias("other"),
        F.map_concat(beyond, F.map_filter("__failed", lambda k, v: ~F.map_contains_key(beyond, k))).alias("cast_failures"),
    )


def unpivot_wide(wide: DataFrame, entity: Sequence[str], columns: Mapping[str, str], name: str = "attr_name", value: str = "attr_value") -> DataFrame:
    """Every filled cell of a wide table as a row: the inverse of :func:`widen`.

    A number that its column's type can't hold is a cell, too; other cast failures aren't.
    """
    typed = F.map_from_entries(F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").cast("string").alias("value"))) for c in columns])))
    numbers = F.map_filter(F.transform_values("cast_failures", lambda k, v: leading_number(v)), lambda k, v: (v != "") & ~F.map_contains_key(typed, k))
    return wide.select(*[F.col(f"`{c}`") for c in entity], F.explode(F.map_concat(typed, F.col("other"), numbers)).alias(name, value))
