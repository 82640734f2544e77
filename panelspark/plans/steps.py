"""A registry of named steps from DataFrame to DataFrame, and a runner that chains chosen ones."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

STEPS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def step(name: str) -> Callable[[Callable[[DataFrame], DataFrame]], Callable[[DataFrame], DataFrame]]:
    """Registers a function under a name; a name is taken once."""

    def add(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        if name in STEPS:
            raise ValueError(f"there is a step {name!r} already")
        STEPS[name] = f
        return f

    return add


def run_steps(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The steps in the order given, as one plan; an unknown name is an error before anything runs."""
    chosen = list(names)
    unknown = [n for n in chosen if n not in STEPS]
    if unknown:
        raise ValueError(f"unknown steps {unknown}; there are {sorted(STEPS)}")
    for n in chosen:
        df = df.transform(STEPS[n])
    return df
