"""Indicator expressions with pandas' NaN semantics.

pandas turns a comparison against NaN into ``False`` for ``==``, ``>``, ``in``
and into ``True`` for ``!=``; Spark returns NULL for all of them.  Every
indicator the reference builds is a 0/1 integer that is never missing, so each
helper coalesces the three-valued result before the cast.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def qcol(name: str) -> Column:
    """Column by exact name, safe for dots, spaces, ``&`` and parentheses."""
    return F.col("`" + name.replace("`", "``") + "`")


def _c(x) -> Column:
    return qcol(x) if isinstance(x, str) else x


def flag(cond: Column, when_null: bool = False) -> Column:
    """0/1 integer of a predicate; a NULL predicate counts as ``when_null``."""
    return F.coalesce(cond, F.lit(when_null)).cast("int")


def _other(b) -> Column:
    """Right-hand side: a Column stays a Column, anything else is a literal."""
    return b if isinstance(b, Column) else F.lit(b)


def eq_flag(a, b) -> Column:
    """``(a == b) * 1``: NULL on either side gives 0."""
    return flag(_c(a) == _other(b))


def ne_flag(a, b) -> Column:
    """``(a != b) * 1``: NULL on either side (even both) gives 1, as pandas does."""
    return flag(_c(a) != _other(b), when_null=True)


def gt_flag(a, b=0) -> Column:
    """``(a > b) * 1``: NULL gives 0."""
    return flag(_c(a) > _other(b))


def isin_flag(a, values: Iterable) -> Column:
    """``a in values``: NULL gives 0."""
    return flag(_c(a).isin(list(values)))


_UNSAFE = re.compile(r"[^0-9A-Za-z_]+")


def safe_name(name: str) -> str:
    """Name with every run of characters outside ``[0-9A-Za-z_]`` turned into ``_``."""
    return _UNSAFE.sub("_", name)
