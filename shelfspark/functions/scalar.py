"""Column-level helpers (built-in expressions only, all JVM-side and codegen'd)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def recode(c: str | Column, mapping: Mapping[Any, Any]) -> Column:
    """Dictionary replace; values not in the mapping stay unchanged."""
    col = _c(c)
    if not mapping:
        return col
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(lookup[col], col)


def code_lookup(c: str | Column, mapping: Mapping[Any, Any], dtype: str | None = None) -> Column:
    """Strict lookup: values not in the mapping become null."""
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    out = lookup[_c(c)]
    return out.cast(dtype) if dtype else out


def set_when_in(target: str | Column, test: str | Column, values: Iterable[Any], new_value: Any) -> Column:
    """``new_value`` where ``test`` is in ``values``; ``target`` elsewhere."""
    values = list(values)
    return F.when(_c(test).isin(values), F.lit(new_value)).otherwise(_c(target))


def age_from_year(c: str | Column, ref_year: int) -> Column:
    return (F.lit(int(ref_year)) - _c(c)).cast("int")


def underscore_blanks(c: str | Column) -> Column:
    return F.translate(_c(c), " ", "_")


def dash_to_underscore(c: str | Column) -> Column:
    return F.translate(_c(c), "-", "_")


def strip_line_end(c: str | Column) -> Column:
    return F.regexp_replace(_c(c), r"[\r\n]+$", "")


def prefix(c: str | Column, n: int = 2) -> Column:
    return F.substring(_c(c), 1, n)


def iso_date(c: str | Column) -> Column:
    """Date (or timestamp) to ``yyyy-MM-dd`` text; text keeps its first 10 characters."""
    return F.date_format(F.to_date(F.substring(_c(c).cast("string"), 1, 10)), "yyyy-MM-dd")


def json_field(c: str | Column, path: str) -> Column:
    return F.get_json_object(_c(c), path)


def safe_name(label: str) -> str:
    """Column-name form of a label: blanks and dashes become underscores."""
    return str(label).replace(" ", "_").replace("-", "_")
