"""Operators and functions replaced by user ones in expressions that are built here.

The parser offers no hook from Python, so the builder methods consult the registry. Replacement
happens at every depth, since every call goes through the builder. Calls on literals alone keep
their meaning: constants are folded before replacement. A replacement that fails on its arguments
is left out, and the reason is logged.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column
from pyspark.sql import functions as F

log = logging.getLogger(__name__)
_OPERATORS: dict[str, Callable[..., Column]] = {
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "*": lambda a, b: a * b,
    "/": lambda a, b: a / b,
    "%": lambda a, b: a % b,
    "negate": lambda a: -a,
}


class Replacements:
    """A registry from names to functions of Columns; the last registration of a name wins."""

    def __init__(self):
        self._by_name: dict[str, tuple[Callable[..., Column], list[str] | None, str | None]] = {}

    def replace(self, name: str, f: Callable[..., Column], arguments: list[str] | None = None, result: str | None = None) -> Replacements:
        """arguments: types that they are cast to; result: the type that the outcome is cast back to."""
        self._by_name[name.lower()] = (f, arguments, result)
        return self

    def clear(self) -> None:
        self._by_name.clear()

    def names(self) -> list[str]:
        return sorted(self._by_name)

    def call(self, name: str, *args: Column | int | float | str) -> Column:
        """The operator or SQL function of that name on the arguments; plain Python values are literals."""
        columns = [a if isinstance(a, Column) else F.lit(a) for a in args]
        found = self._by_name.get(name.lower())
        if found and any(isinstance(a, Column) for a in args):
            f, kinds, result = found
            try:
                out = f(*(c.cast(k) for c, k in zip(columns, kinds, strict=True)) if kinds else columns)
                return out.cast(result) if result else out
            except (TypeError, ValueError, PySparkException) as e:
                log.warning("%s is not replaced: %s", name, e)
        return _OPERATORS[name](*columns) if name in _OPERATORS else F.call_function(name, *columns)

    def add(self, a, b) -> Column:
        return self.call("+", a, b)

    def sub(self, a, b) -> Column:
        return self.call("-", a, b)

    def mul(self, a, b) -> Column:
        return self.call("*", a, b)

    def div(self, a, b) -> Column:
        return self.call("/", a, b)
