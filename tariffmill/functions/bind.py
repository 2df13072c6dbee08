"""Names inside expressions, and literal maps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value to a name inside an expression, so that it is computed once per row.

    Needed where a computed value is used inside a lambda: Spark would compute it again per element.
    """
    return F.element_at(F.transform(F.array(value), lambda bound: body(bound)), 1)


def fixed_map(values: dict[str, str]) -> Column:
    """Literal map; written as one text, which the optimizer folds, as hundreds of literals are slow to plan."""
    pairs = "\x02".join(f"{k}\x03{v}" for k, v in values.items())
    return F.str_to_map(F.lit(pairs), F.lit("\x02"), F.lit("\x03"))
