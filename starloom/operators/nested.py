"""Lists of rows under each object.

A nested table has the key columns, an integer ``segment`` and an array of
structs ordered by time.  An object has one row, segment 0, whatever the length
of its list, so a function of a row is a function of an object.  Only where the
caller names ``max_list`` are lists cut into consecutive segments of that
length; element-wise work (filter, derive, split) ignores them, counts and
object-level decisions add them up.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.ordered import is_hot, ordered

# Rows of one list in jobs that add up segments by themselves.
MAX_LIST = 200_000


def pack(df: DataFrame, keys: list[str], fields: list[str], order: list[str], name: str = "lc", max_list: int | None = None, biggest: int | None = None, tasks: int | None = None) -> DataFrame:
    """Group rows into arrays of structs sorted by ``order`` (which come first in the struct).

    ``max_list`` cuts longer lists into segments; ``biggest`` is then an upper
    bound of the rows per key, if one is known.
    ``tasks`` fixes the number of partitions, for costly work on the lists.
    """
    names = [*order, *[f for f in fields if f not in order]]
    rows = df.select(*keys, *[c for c in names if c not in keys])
    spread = list(keys)
    if max_list is None or not is_hot(rows, keys, max_list, biggest):
        rows = rows.withColumn("segment", F.lit(0))
    else:
        rows = ordered(rows, keys, order, rank="__rn").withColumn("segment", F.floor((F.col("__rn") - 1) / max_list).cast("int"))
        spread.append("segment")
    if tasks:
        # the constant segment is not part of the grouping Spark plans, so not of the partitioning either
        rows = rows.repartition(tasks, *spread)
    packed = rows.groupBy(*keys, "segment").agg(F.array_sort(F.collect_list(F.struct(*names))).alias(name))
    return packed


def join_nested(parent: DataFrame, child: DataFrame, left_on: str, right_on: str, fields: list[str], order: list[str], name: str, **kw) -> DataFrame:
    """Parent rows with their child rows packed; parents without children keep a null list."""
    packed = pack(child, [right_on], fields, order, name, **kw)
    seg = f"{name}_segment"
    packed = packed.withColumnsRenamed({right_on: "__k", "segment": seg})
    return parent.join(packed, parent[left_on] == packed["__k"], "left").drop("__k").withColumn(seg, F.coalesce(seg, F.lit(0)))


def nest_lists(df: DataFrame, lists: list[str], name: str) -> DataFrame:
    """Parallel arrays to one array of structs."""
    return df.withColumn(name, F.arrays_zip(*lists)).drop(*lists)


def flatten(df: DataFrame, name: str, outer: bool = False) -> DataFrame:
    """One row per element with the struct fields as columns."""
    rest = [c for c in df.columns if c != name]
    gen = F.inline_outer(name) if outer else F.inline(name)
    return df.select(*rest, gen)


def filter_nested(df: DataFrame, name: str, cond) -> DataFrame:
    """Drop elements that fail ``cond`` (element -> Column); objects stay."""
    return df.withColumn(name, F.filter(name, cond))


def dropna_elements(df: DataFrame, name: str, fields: list[str]) -> DataFrame:
    """Drop elements in which any of the fields is null or NaN."""
    types = {f.name: f.dataType.typeName() for f in df.schema[name].dataType.elementType.fields}

    def ok(x):
        conds = []
        for f in fields:
            c = x[f].isNotNull()
            conds.append(c & ~F.isnan(x[f]) if types[f] in ("float", "double") else c)
        return reduce(lambda a, b: a & b, conds)

    return df.withColumn(name, F.filter(name, ok))


def drop_empty(df: DataFrame, name: str) -> DataFrame:
    """Drop rows whose list is null or empty."""
    return df.where(F.size(name) > 0)


def sort_nested(df: DataFrame, name: str, by: str, ascending: bool = True) -> DataFrame:
    """Sort each list by one field; the whole struct breaks ties."""
    fields = df.schema[name].dataType.elementType.fieldNames()
    keyed = F.transform(name, lambda x: F.struct(x[by].alias("__k"), x.alias("__x")))
    out = F.transform(F.array_sort(keyed), lambda x: F.struct(*[x["__x"][f].alias(f) for f in fields]))
    return df.withColumn(name, out if ascending else F.reverse(out))


def derive(df: DataFrame, name: str, **new) -> DataFrame:
    """Add or replace fields of each element; values are functions element -> Column."""
    fields = df.schema[name].dataType.elementType.fieldNames()

    def build(x):
        cols = [(new[f](x) if f in new else x[f]).alias(f) for f in fields]
        return F.struct(*cols, *[fn(x).alias(f) for f, fn in new.items() if f not in fields])

    return df.withColumn(name, F.transform(name, build))


def select_fields(df: DataFrame, name: str, fields: list[str]) -> DataFrame:
    return df.withColumn(name, F.transform(name, lambda x: F.struct(*[x[f].alias(f) for f in fields])))


def _with_value(name: str, by: str, value) -> Column:
    return F.filter(name, lambda x: x[by] == value)


def count_nested(df: DataFrame, keys: list[str], name: str, by: str | None = None, values: list | None = None) -> DataFrame:
    """List length per object, or one count per value of a field (0 where absent)."""
    size = lambda c: F.greatest(F.lit(0), F.coalesce(F.size(c), F.lit(0))).cast("long")
    if by is None:
        return df.groupBy(*keys).agg(F.sum(size(F.col(name))).alias(f"n_{name}"))
    aggs = [F.sum(size(_with_value(name, by, v))).alias(f"n_{name}_{v}") for v in values]
    return df.groupBy(*keys).agg(*aggs)


def split_by(df: DataFrame, name: str, by: str, values: list) -> DataFrame:
    """One list per value of a field; the source list is dropped."""
    return df.withColumns({f"{name}_{v}": _with_value(name, by, v) for v in values}).drop(name)


def long_enough(df: DataFrame, keys: list[str], lists: list[str], min_len: int) -> DataFrame:
    """Keep objects with at least one of the lists of ``min_len`` elements or more, all segments counted."""
    totals = df.groupBy(*keys).agg(*[F.sum(F.size(c)).alias(c) for c in lists])
    keep = totals.where(reduce(lambda a, b: a | b, [F.col(c) >= min_len for c in lists])).select(*keys)
    return df.join(keep, keys, "left_semi")


def list_sum(name: str, value) -> Column:
    """Sum of an element expression over a list."""
    return F.aggregate(name, F.lit(0.0), lambda acc, x: acc + value(x))
