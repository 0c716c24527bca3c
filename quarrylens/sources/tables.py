"""Name -> DataFrame registry: the one place a query looks its inputs up."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Union

from pyspark.sql import DataFrame, SparkSession

Provider = Union[DataFrame, str, Callable[["Tables"], DataFrame]]


class Tables(Mapping):
    """Lazy registry.  A provider is a DataFrame, a catalogue table name, or a builder.

    A builder gets the registry itself, so views can be stacked; nothing is computed
    until an action runs on the final frame.
    """

    def __init__(self, spark: SparkSession, providers: Mapping[str, Provider]):
        self.spark = spark
        self._providers = dict(providers)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            provider = self._providers[name]
            if isinstance(provider, str):
                frame = self.spark.table(provider)
            elif callable(provider):
                frame = provider(self)
            else:
                frame = provider
            self._frames[name] = frame
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._providers)

    def __len__(self) -> int:
        return len(self._providers)

    def with_tables(self, **more: Provider) -> "Tables":
        return Tables(self.spark, {**self._providers, **more})

    def sql(self, text: str, **args) -> DataFrame:
        """Run SQL naming tables as ``{name}`` and parameters as ``:name``.

        Values are bound, never pasted into the text.
        """
        used = {name: self[name] for name in self if "{" + name + "}" in text}
        return self.spark.sql(text, args=args or None, **used)

    def register_views(self, prefix: str = "") -> None:
        """Expose every table to Spark SQL as a temporary view."""
        for name in self:
            self[name].createOrReplaceTempView(prefix + name)
