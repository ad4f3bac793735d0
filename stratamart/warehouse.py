"""Named tables of a layered warehouse.

A plan is a plain function from DataFrames to a DataFrame.  Its parameter names
say which tables it reads, so a warehouse can hand it either a stored table or
the result of the plan that makes that table::

    @plan
    def dws_user_order_td(dws_user_order_1d): ...

    Warehouse(spark.table, as_of="2025-06-30").table("dws_user_order_td")
"""

from __future__ import annotations

import datetime as dt
import inspect
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

PLANS: dict[str, Callable[..., DataFrame]] = {}


def plan(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    if fn.__name__ in PLANS:
        raise ValueError(f"two plans are named {fn.__name__}")
    PLANS[fn.__name__] = fn
    return fn


def as_date(day: str | dt.date) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


class Warehouse:
    """Resolves table names.

    ``reader``   opens a stored table by name (``spark.table`` on a cluster).
    ``inputs``   functions that derive a source table from stored ones.
    ``stored``   names to read through ``reader`` although a plan could make
                 them: a layer that an earlier job has already written.
    ``as_of``    the business date of the run; ``log_as_of`` the one of the
                 click logs when it differs.
    """

    def __init__(
        self,
        reader: Callable[[str], DataFrame],
        as_of: str | dt.date,
        log_as_of: str | dt.date | None = None,
        zone: str = "GMT+8",
        inputs: Mapping[str, Callable[..., DataFrame]] | None = None,
        stored: frozenset[str] | set[str] = frozenset(),
    ):
        self.reader = reader
        self.settings = {
            "as_of": as_date(as_of),
            "log_as_of": as_date(log_as_of or as_of),
            "zone": zone,
        }
        self.inputs = dict(inputs or {})
        self.stored = set(stored)
        self._open: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._make(name)
        return self._open[name]

    def _make(self, name: str) -> DataFrame:
        maker = self.inputs.get(name)
        if maker is None and name not in self.stored:
            maker = PLANS.get(name)
        if maker is None:
            return self.reader(name)
        wanted = inspect.signature(maker).parameters
        return maker(**{p: self.settings[p] if p in self.settings else self.table(p) for p in wanted})
