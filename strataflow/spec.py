"""What a pipeline is told about its tables: column roles, storage format, layer names."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class FeatureSpec:
    """Column roles of a raw table.

    ``keys`` identify a row through all layers, ``categorical`` columns are one-hot
    encoded, ``numeric`` columns are min-max scaled, ``label`` is the class to learn.
    A column may be a key and categorical at once.
    """

    keys: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    label: str | None = None

    def __post_init__(self):
        for role in ("keys", "categorical", "numeric"):
            names = tuple(getattr(self, role))
            object.__setattr__(self, role, names)
            if len({n.lower() for n in names}) != len(names):
                raise ValueError(f"{role} names a column twice: {names}")
        if not self.keys:
            raise ValueError("at least one key column is needed")
        if not self.categorical and not self.numeric:
            raise ValueError("at least one categorical or numeric column is needed")


@dataclass(frozen=True)
class TableFormat:
    """Storage of catalog tables.

    ``streamed`` tables also take micro-batches: where the format has no transactions of
    its own they carry two partition columns that make a replayed batch replace itself.
    """

    name: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    streamed: bool = False

    @property
    def transactional(self) -> bool:
        return self.name.lower() == "delta"

    @property
    def batch_partitions(self) -> bool:
        return self.streamed and not self.transactional


@dataclass(frozen=True)
class Layers:
    """The three tables of a pipeline, in one database and one format."""

    database: str
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    fmt: TableFormat = TableFormat()

    def table(self, layer: str) -> str:
        return f"{self.database}.{getattr(self, layer)}"
