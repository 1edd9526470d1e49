"""Models and what they are computed from: only what is asked for is built, each model once."""

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Model:
    """An operator over other models or raw tables; ``stored`` ones are written before others read them."""

    operator: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    stored: bool = False


def needed(models: Mapping[str, Model], targets: Iterable[str], given: Iterable[str]) -> list[str]:
    """The models that the targets take, ancestors first; a cycle or an unknown name is refused."""
    given, waiting, links = set(given), list(targets), {}
    while waiting:
        name = waiting.pop()
        if name in links or name in given:
            continue
        if name not in models:
            raise ValueError(f"no model or table {name!r}")
        links[name] = models[name].inputs
        waiting += models[name].inputs
    try:
        order = TopologicalSorter(links).static_order()
        return [name for name in order if name not in given]
    except CycleError as cycle:
        raise ValueError(f"models depend on each other: {' <- '.join(cycle.args[1])}") from cycle


def build(
    models: Mapping[str, Model],
    tables: Mapping[str, DataFrame],
    targets: Iterable[str],
    store: Callable[[str, DataFrame], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The targets and all that they are computed from, by name.

    ``store`` writes a stored model and gives it back as written; without it nothing is written.
    """
    built = dict(tables)
    for name in needed(models, targets, tables):
        model = models[name]
        rows = model.operator(*[built[source] for source in model.inputs])
        built[name] = store(name, rows) if store and model.stored else rows
    return built
