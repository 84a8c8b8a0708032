"""Value pools: written once, shared by all columns that draw from them, removed after the last."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Hashable

from pyspark.sql import SparkSession

from twinloom.session import shared_folder
from twinloom.sinks.folders import delete_folder


class Pools:
    """Each pool has a folder of its own and a number of uses that are still to come."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._uses: Counter = Counter()
        self._held: dict[Hashable, tuple[str, object]] = {}

    def expect(self, key: Hashable, uses: int = 1) -> None:
        self._uses[key] += uses

    def expected(self, key: Hashable) -> bool:
        return self._uses[key] > 0

    def get(self, key: Hashable, build: Callable[[str], object]) -> object:
        """The pool, built into a folder if this is the first time it is asked for."""
        if key not in self._held:
            folder = shared_folder(self._spark, "pool")
            try:
                self._held[key] = folder, build(folder)
            except BaseException:
                delete_folder(self._spark, folder)
                raise
        return self._held[key][1]

    def release(self, key: Hashable) -> None:
        """One use is over."""
        self._uses[key] -= 1
        if self._uses[key] <= 0 and key in self._held:
            delete_folder(self._spark, self._held.pop(key)[0])

    def close(self) -> None:
        for folder, _ in self._held.values():
            delete_folder(self._spark, folder)
        self._held.clear()

    @property
    def folders(self) -> list[str]:
        return [folder for folder, _ in self._held.values()]
