"""Binding a value to a name inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once.

    An expression used inside the lambda of a higher-order function is otherwise computed anew
    for each array element.
    """
    return F.get(F.transform(F.array(value), body), 0)
