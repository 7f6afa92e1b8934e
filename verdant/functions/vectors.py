"""Array/vector column helpers that stay in JVM expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot_fixed_weights(arr, weights: Sequence[float], intercept: float = 0.0) -> Column:
    """``intercept + sum_i arr[i] * weights[i]`` for a small, fixed weight
    vector (a literal array in the plan; summed left to right)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    w = F.array(*[F.lit(float(x)) for x in weights])
    prod = F.zip_with(a, w, lambda x, y: x.cast("double") * y)
    return F.aggregate(prod, F.lit(float(intercept)), lambda acc, x: acc + x)


def linear_margin(arr, weights: Sequence[float], intercept: float = 0.0) -> Column:
    return dot_fixed_weights(arr, weights, intercept)


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


_VECTOR = "v struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def entries_of(parts) -> Column:
    """``struct(indices, values)`` of the active entries from the stored parts of a vector; a dense one has all."""
    v = F.col(parts) if isinstance(parts, str) else parts
    size = F.size(v["values"])
    all_of_them = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    return F.struct(F.coalesce(v["indices"], all_of_them).alias("indices"), v["values"].alias("values"))


def active_entries(features) -> Column:
    """``struct(indices, values)`` of the active entries of an ML vector, in built-in expressions: a sparse vector is
    never made dense."""
    f = F.col(features) if isinstance(features, str) else features
    return entries_of(F.from_json(F.to_json(F.struct(f.alias("v"))), _VECTOR)["v"])


def sparse_margin(entries: Column, weights: Column, intercept: float = 0.0) -> Column:
    """``intercept + sum value * weights[index]`` over active entries, in their order."""
    terms = F.zip_with(entries["indices"], entries["values"], lambda i, x: x * weights[i])
    return F.aggregate(terms, F.lit(float(intercept)), lambda acc, x: acc + x)
