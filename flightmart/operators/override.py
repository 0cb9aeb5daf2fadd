"""Keyed override: replace some columns for rows whose key is in a mapping.

The replacement is unconditional on a key match (a present value is
overwritten too); rows whose key is not in the mapping, or is NULL, are
untouched.

One contract holds for every kind and size of mapping: mapping keys are
cast to the key column's type and mapped values to their columns' types;
a key or value that is NULL or has no such cast is an error, and so is a
key that repeats (it would multiply rows).  Column names match without
regard to case.

Two physical forms give the same rows:

* a ``dict`` with up to ``max_literal_keys`` entries becomes literal map
  lookups inside the projection: no join, no shuffle, no broadcast;
* a larger ``dict`` or a DataFrame is joined.  One aggregate checks it; the
  planner picks the join from sizes it knows (automatic broadcast below its
  byte threshold, otherwise a shuffle join that AQE can split).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import resolve_names
from ..functions.sqltext import ident

MAX_LITERAL_KEYS = 1000

_HIT = "__override_hit"


def _prefixed(c: str) -> str:
    return f"__override_{c}"


def _cast_literals(df: DataFrame, values: Sequence[object], col: str) -> list[object]:
    """Python values cast to the type of ``col``: a projection of a local row, which runs no job."""
    to = df.schema[col].dataType
    row = df.sparkSession.createDataFrame([(0,)], "x int")
    cast = row.select(*[F.lit(v).try_cast(to).alias(f"v{i}") for i, v in enumerate(values)]).collect()[0]
    wrong = [v for v, c in zip(values, cast) if c is None]
    if wrong:
        raise ValueError(f"mapping holds a NULL value or one that is no {to.simpleString()} for {col}: {wrong[0]!r}")
    return list(cast)


def _override_with_literals(
    df: DataFrame, key: str, mapping: Mapping[object, Sequence[object]], cols: Sequence[str]
) -> DataFrame:
    keys = _cast_literals(df, list(mapping), key)
    if len(set(keys)) < len(keys):
        raise ValueError("override mapping has a repeated key")
    at = F.expr(ident(key))
    hit = at.isin(keys)
    exprs: dict[str, Column] = {}
    for i, c in enumerate(cols):
        pairs: list[Column] = []
        for k, v in zip(keys, _cast_literals(df, [values[i] for values in mapping.values()], c)):
            pairs += [F.lit(k).cast(df.schema[key].dataType), F.lit(v).cast(df.schema[c].dataType)]
        exprs[c] = F.when(hit, F.try_element_at(F.create_map(*pairs), at)).otherwise(F.expr(ident(c)))
    return df.withColumns(exprs)


def _check_mapping(mapping: DataFrame, names: Sequence[str]) -> None:
    """Keys unique, nothing NULL: one grouped aggregate, one row to the driver."""
    key = names[0]
    per_key = mapping.groupBy(F.expr(ident(key)).alias("k")).agg(
        F.count("*").alias("n"),
        F.count_if(F.array_contains(F.array(*[F.expr(ident(c)).isNull() for c in names]), True)).alias("nulls"),
    )
    found = per_key.agg(F.sum("nulls").alias("nulls"), F.max(F.when(F.col("n") > 1, F.col("k"))).alias("again")).first()
    if found.nulls:
        raise ValueError(f"mapping holds a NULL value or one without a cast in {found.nulls} rows")
    if found.again is not None:
        raise ValueError(f"override mapping has a repeated key: {found.again!r}")


def mapping_frame(
    spark: SparkSession,
    key: str,
    mapping: Mapping[object, Sequence[object]],
    cols: Sequence[str],
) -> DataFrame:
    """A DataFrame (key, *cols) from a dict mapping."""
    rows = [(k, *v) for k, v in mapping.items()]
    return spark.createDataFrame(rows, [key, *cols])


def _override_with_join(df: DataFrame, key: str, mapping: DataFrame, cols: Sequence[str]) -> DataFrame:
    names = [key, *cols]
    own = resolve_names(mapping, names)
    right = mapping.select(
        *[F.expr(ident(o)).try_cast(df.schema[c].dataType).alias(_prefixed(c)) for c, o in zip(names, own)]
    )
    _check_mapping(right, [_prefixed(c) for c in names])
    right = right.withColumn(_HIT, F.lit(True))
    joined = df.join(right, F.expr(ident(key)) == F.expr(ident(_prefixed(key))), "left")
    out = []
    for name in df.columns:
        value = F.expr(ident(name))
        if name in cols:
            value = F.when(F.col(_HIT), F.expr(ident(_prefixed(name)))).otherwise(value)
        out.append(value.alias(name))
    return joined.select(*out)


def override_by_key(
    df: DataFrame,
    key: str,
    mapping: Mapping[object, Sequence[object]] | DataFrame,
    cols: Sequence[str],
    max_literal_keys: int = MAX_LITERAL_KEYS,
) -> DataFrame:
    """Overwrite ``cols`` from ``mapping`` where ``df[key]`` matches.

    ``mapping`` is either ``{key_value: (value_for_cols[0], ...)}`` or a
    DataFrame with columns ``key`` and ``cols``.  An empty mapping leaves
    the frame as it is.
    """
    given = list(cols)
    key, *cols = resolve_names(df, [key, *given])
    if isinstance(mapping, DataFrame):
        return _override_with_join(df, key, mapping, cols)
    for k, values in mapping.items():
        if len(values) != len(cols):
            raise ValueError(f"mapping for {k!r} has {len(values)} values, expected {len(cols)}")
        if k is None or any(v is None for v in values):
            raise ValueError(f"mapping for {k!r} holds a NULL value")
    if not mapping:
        return df
    if len(mapping) <= max_literal_keys:
        return _override_with_literals(df, key, mapping, cols)
    return _override_with_join(df, key, mapping_frame(df.sparkSession, key, mapping, cols), cols)
