"""Event-parameter lookup on the repeated key/value column.

``event_params`` is ``array<struct<key, value: struct<string_value,
int_value>>>``. Keys may repeat, so the column is not turned into a map
(``map_from_entries`` throws on duplicate keys). A lookup is a
higher-order ``filter`` plus ``get``: no explode, no join, no shuffle,
and it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortloom.functions import dims


def _matches(params: Column, key: str) -> Column:
    return F.filter(params, lambda p: p["key"] == F.lit(key))


def param(key: str, slot: str = "string_value", params: str | Column = "event_params",
          strict: bool = False) -> Column:
    """Value slot of the first parameter named ``key``; null if absent.

    ``array_position`` over the key field finds the first match (0 when
    absent, so ``get`` at -1 gives null) without a lambda, so the lookup
    stays in generated code. With ``strict=True`` a key given twice raises
    at run time, as the scalar subquery form does.
    """
    arr = F.col(params) if isinstance(params, str) else params
    pos = F.array_position(arr["key"], F.lit(key))
    value = F.get(arr, (pos - F.lit(1)).cast("int"))["value"][slot]
    if strict:
        value = F.when(F.size(_matches(arr, key)) > 1,
                       F.raise_error(F.lit(f"event parameter '{key}' occurs more than once"))
                       ).otherwise(value)
    return value


def signup_method_raw(params: str | Column = "event_params", strict: bool = False) -> Column:
    """Lower-cased sign-up method: ``signup_method`` text, else ``method`` text.

    An empty string is not null and so blocks the fallback.
    """
    return F.lower(F.coalesce(param("signup_method", params=params, strict=strict),
                              param("method", params=params, strict=strict)))


def success_value(params: str | Column = "event_params", strict: bool = False) -> Column:
    """Lower-cased success value: ``is_success`` text, else ``is_success``
    integer as text, else ``result`` text."""
    return F.lower(F.coalesce(
        param("is_success", params=params, strict=strict),
        param("is_success", "int_value", params=params, strict=strict).cast("string"),
        param("result", params=params, strict=strict)))


def is_success(params: str | Column = "event_params", values=None, strict: bool = False) -> Column:
    """True when the success value is one of ``values``; null value -> false."""
    vals = list(values or dims.SUCCESS_VALUES)
    return F.coalesce(success_value(params, strict).isin(vals), F.lit(False))


def recode_method(raw: Column, methods=None) -> Column:
    """Known method as itself; anything else, null included, -> unknown."""
    known = list(methods or dims.SIGNUP_METHODS)
    return F.when(raw.isin(known), raw).otherwise(F.lit(dims.UNKNOWN_METHOD))


def country_code(country: Column, mapping=None, other: str = dims.OTHER_COUNTRY) -> Column:
    """Country name -> code by a simple CASE; null or unlisted -> ``other``."""
    pairs = list(mapping or dims.SIGNUP_COUNTRY_CODES)
    expr = None
    for name, code in pairs:
        expr = (F.when(country == F.lit(name), F.lit(code)) if expr is None
                else expr.when(country == F.lit(name), F.lit(code)))
    return expr.otherwise(F.lit(other)) if expr is not None else F.lit(other)
