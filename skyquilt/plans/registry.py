"""Analyzers as plug-ins: functions from a DataFrame to a DataFrame, run in order, failures kept apart."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyquilt.functions.spectral import normalized_difference


@dataclass
class Result:
    analyzer: str
    success: bool
    skipped: bool = False
    error: str | None = None
    output: DataFrame | None = None


@dataclass
class Registry:
    """Analyzers by name, in the order they were added. An analyzer may name the parameters it wants: its settings, and
    ``previous``, the outputs of those before it."""

    analyzers: dict[str, Callable[..., DataFrame]] = field(default_factory=dict)

    def add(self, name: str):
        def decorate(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            self.analyzers[name] = f
            return f

        return decorate

    def run(self, df: DataFrame, config: dict[str, dict] | None = None) -> list[Result]:
        """``config``: by name, ``enabled`` and settings; without one all run. Plans are lazy: an error here is one of analysis."""
        out, previous = [], {}
        for name, f in self.analyzers.items():
            given = dict((config or {}).get(name, {}))
            if config is not None and not given.pop("enabled", name in config):
                out.append(Result(name, True, skipped=True))
                continue
            wanted = inspect.signature(f).parameters
            kwargs = {k: v for k, v in {**given, "previous": previous}.items() if k in wanted}
            try:
                previous[name] = f(df, **kwargs)
                out.append(Result(name, True, output=previous[name]))
            except Exception as error:  # one analyzer's failure is its own
                out.append(Result(name, False, error=f"{type(error).__name__}: {error}"))
        return out


#: The library's own analyzers, in the order they run.
ANALYZERS = Registry()


@ANALYZERS.add("brightness")
def brightness(df: DataFrame, key: str) -> DataFrame:
    """Mean value of each key."""
    return df.groupBy(key).agg(F.avg("value").alias("mean"))


@ANALYZERS.add("change")
def change(df: DataFrame, previous: dict[str, DataFrame], above: float) -> DataFrame:
    """Keys whose mean, as found before, lies above a limit; to 12 places, so that a mean at the limit isn't above it by the order of its sum."""
    return previous["brightness"].where(F.round("mean", 12) > above)


@ANALYZERS.add("vegetation")
def vegetation(df: DataFrame) -> DataFrame:
    return df.select(normalized_difference("nir", "red").alias("ndvi"))


@ANALYZERS.add("water")
def water(df: DataFrame, band: str = "red") -> DataFrame:
    return df.select(normalized_difference(band, "nir").alias("ndwi"))
