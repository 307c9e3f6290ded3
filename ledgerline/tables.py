"""A read-only mapping whose DataFrames are built on first access.

A layer is a ``name -> DataFrame`` mapping; building a DataFrame already costs
driver round trips (file listing, Parquet footers, analysis). With this
mapping a query only constructs the tables it actually touches, while code
that iterates the whole layer still sees every table.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyTables(Mapping[str, DataFrame]):
    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}
        # Writers build tables from several threads; build each one once.
        self._lock = threading.RLock()

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._built:
                self._built[name] = self._builders[name]()
            return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def __repr__(self) -> str:
        return f"LazyTables({list(self._builders)})"


def renamed(tables: Mapping[str, DataFrame], rename: Callable[[str], str]) -> LazyTables:
    """The same tables under new names, still built on access."""
    return LazyTables({rename(n): (lambda n=n: tables[n]) for n in tables})
