"""User functions on tables, nested rows and groups.

User code runs on Arrow batches inside tasks.  No function here hands a whole
group or tile to one task unless the caller's own tiles bound it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_partitions(df: DataFrame, fn: Callable, schema: str | T.StructType, **kwargs) -> DataFrame:
    """Apply ``fn(frame, **kwargs)`` to batches of rows; it may keep, change or reduce rows.

    A batch may be empty and holds any rows of the table: a function that needs
    all rows of a tile belongs in ``map_tiles``, a statistic in ``aggregate``.
    """

    def run(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            yield fn(pdf, **kwargs)

    return df.mapInPandas(run, schema)


def map_tiles(df: DataFrame, tile: list[str], fn: Callable, schema: str | T.StructType, include_tile: bool = False, **kwargs) -> DataFrame:
    """Apply ``fn(frame, **kwargs)`` to all rows of each tile at once.

    With ``include_tile`` the function gets the tile's values first, as
    ``fn(frame, tile, **kwargs)``.  A task holds one tile; adaptive tiling bounds
    tiles by rows.
    """
    if include_tile:
        return df.groupBy(*tile).applyInPandas(lambda key, pdf: fn(pdf, key, **kwargs), schema)
    return df.groupBy(*tile).applyInPandas(lambda pdf: fn(pdf, **kwargs), schema)


def map_rows(
    df: DataFrame, fn: Callable, columns: list[str], schema: str, row_container: str = "args", append_columns: bool = False,
    output_names: list[str] | None = None, **kwargs,
) -> DataFrame:
    """Call ``fn`` once per row and collect its results as columns.

    ``columns`` may name ``list.field``, given to ``fn`` as an array.  With
    ``row_container="dict"`` the row comes as one dict.  ``fn`` returns a dict, or
    a tuple named by ``output_names``.  ``list.field`` keys with array values come
    back as nested lists.  Arrow moves the rows; only the named columns travel.
    """
    out_type = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    flat = [c.replace(".", "__") for c in columns]
    picked = []
    for c, f in zip(columns, flat):
        if "." in c:
            head, leaf = c.split(".", 1)
            picked.append(F.col(head).getField(leaf).alias(f))
        else:
            picked.append(F.col(c).alias(f))
    keep = df.columns if append_columns else []
    names = [f.name for f in out_type.fields]

    @F.pandas_udf(out_type)
    def apply(s: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for rec in s.itertuples(index=False):
            values = dict(zip(columns, rec))
            res = fn(values, **kwargs) if row_container == "dict" else fn(*values.values(), **kwargs)
            if not isinstance(res, dict):
                res = dict(zip(output_names or names, res if isinstance(res, tuple) else (res,)))
            rows.append([res[n] for n in names])
        return pd.DataFrame(rows, columns=names)

    out = df.select(*keep, apply(F.struct(*picked)).alias("__r"))
    return out.select(*keep, "__r.*")


def reduce_rows(df: DataFrame, fn: Callable, *columns: str, schema: str, append_columns: bool = False, **kwargs) -> DataFrame:
    """``map_rows`` with the columns as positional arguments."""
    return map_rows(df, fn, list(columns), schema, append_columns=append_columns, **kwargs)


def explode_rows(df: DataFrame, fn: Callable, columns: list[str], schema: str, keep: list[str], **kwargs) -> DataFrame:
    """Row to many rows: ``fn`` yields tuples; kept columns repeat (a lateral table function)."""

    class Rows:
        def eval(self, *args):
            yield from fn(*args, **kwargs)

    table = F.udtf(Rows, returnType=schema, useArrow=True)
    return df.lateralJoin(table(*[F.col(c).outer() for c in columns])).select(*keep, *T.StructType.fromDDL(schema).fieldNames())


def aggregate(df: DataFrame, keys: list[str], partial: Callable, state_schema: str, merge: dict[str, str] | None = None) -> DataFrame:
    """User aggregate in two steps.

    ``partial(frame)`` gives one row per key of a batch with additive state
    columns.  Spark merges states by sum (or min / max as named in ``merge``), so
    a huge group is reduced in many tasks and never gathered.
    """
    fields = T.StructType.fromDDL(state_schema)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + [state_schema])

    def run(frames):
        for pdf in frames:
            yield partial(pdf)

    fns = {"sum": F.sum, "min": F.min, "max": F.max}
    how = merge or {}
    state = df.mapInPandas(run, schema)
    return state.groupBy(*keys).agg(*[fns[how.get(f.name, "sum")](f.name).alias(f.name) for f in fields.fields])
