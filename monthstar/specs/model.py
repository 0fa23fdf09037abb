"""What a star schema is made of, as data."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthstar.functions import all_but_yes, br_date, br_number, month_of, year_of


@dataclass(frozen=True)
class Field:
    """An output column: where it comes from and how it is parsed.

    ``source`` is one header, quoted as it stands, or a tuple of struct names.
    """

    name: str
    source: str | tuple[str, ...]
    parse: Callable[[Column], Column] | None = None

    def column(self) -> Column:
        path = (self.source,) if isinstance(self.source, str) else self.source
        raw = F.col(".".join("`" + part.replace("`", "``") + "`" for part in path))
        return (self.parse(raw) if self.parse else raw).alias(self.name)


def text(name: str, source: str) -> Field:
    """A top-level column taken as it is."""
    return Field(name, source)


def leaf(name: str, path: str) -> Field:
    """A struct field, ``a.b.c``; null where any parent is null."""
    return Field(name, tuple(path.split(".")))


def day(name: str, source: str) -> Field:
    return Field(name, source, br_date)


def year_field(source: str, name: str = "year") -> Field:
    return Field(name, source, lambda raw: year_of(br_date(raw)))


def month_field(source: str, name: str = "month") -> Field:
    return Field(name, source, lambda raw: month_of(br_date(raw)))


def amount(name: str, source: str | tuple[str, ...], mode: str = "thousands") -> Field:
    return Field(name, source, partial(br_number, mode=mode))


def flag(name: str, source: str) -> Field:
    """False where the text is the word yes."""
    return Field(name, source, all_but_yes)


@dataclass(frozen=True)
class Family:
    """Raw files of one kind. ``pattern`` is relative to the root and may use
    ``{year}`` and ``{month:02d}``."""

    name: str
    pattern: str
    format: str = "csv"
    schema: T.StructType | str | None = None
    separator: str = ";"
    encoding: str = "UTF-8"

    def glob(self, year: int, month: int) -> str:
        return self.pattern.format(year=int(year), month=int(month))


@dataclass(frozen=True)
class StagedSource:
    """Members one side contributes to a dimension, staged under ``name``."""

    name: str
    families: tuple[Family, ...]
    fields: tuple[Field, ...]

    @property
    def schema(self) -> T.StructType:
        """Schema of the staging table; attributes taken from raw files are text."""
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])


@dataclass(frozen=True)
class Dimension:
    """A dimension, its natural key, and one or two staged sources.

    With two sources the first wins where both know an attribute.
    """

    name: str
    keys: tuple[str, ...]
    sources: tuple[StagedSource, ...]
    bucket: Callable[[], Column] | None = None

    def __post_init__(self):
        if len(self.sources) not in (1, 2):
            raise ValueError(f"dimension {self.name} needs one or two sources")
        for source in self.sources:
            missing = set(self.keys) - {f.name for f in source.fields}
            if missing:
                raise ValueError(f"source {source.name} lacks keys {sorted(missing)} of {self.name}")

    @property
    def id_column(self) -> str:
        return f"{self.name}_id"

    @property
    def columns(self) -> tuple[str, ...]:
        """Columns in stored order."""
        names = [tuple(f.name for f in source.fields) for source in self.sources]
        if len(names) == 1:
            return (self.id_column, *names[0])
        left, right = names
        return (
            self.id_column,
            *self.keys,
            *[name for name in left if name not in right],
            *[name for name in right if name not in left],
            *[name for name in left if name in right and name not in self.keys],
        )

    @property
    def schema(self) -> T.StructType:
        """Schema of the stored table; attributes taken from raw files are text."""
        return T.StructType([T.StructField(self.id_column, T.LongType()), *self.member_schema.fields])

    @property
    def member_schema(self) -> T.StructType:
        """The same without the id."""
        return T.StructType([T.StructField(name, T.StringType()) for name in self.columns[1:]])


@dataclass(frozen=True)
class Fact:
    """A fact, the dimensions it looks up, and the keys its check requires.

    ``row_period`` tells whether ``fields`` hold ``year`` and ``month`` of each
    row; otherwise the run's period is used for all rows.
    """

    name: str
    family: Family
    fields: tuple[Field, ...]
    dimensions: tuple[str, ...]
    row_period: bool = True
    required: tuple[str, ...] = ()
    max_null_percent: float = 2

    def __post_init__(self):
        if self.row_period and not {"year", "month"} <= {f.name for f in self.fields}:
            raise ValueError(f"fact {self.name} needs the fields year and month")

    def with_number_mode(self, mode: str) -> Fact:
        """The same fact, its amounts parsed by another rule."""
        amounts = {f.name for f in self.fields if isinstance(f.parse, partial) and f.parse.func is br_number}
        fields = [amount(f.name, f.source, mode) if f.name in amounts else f for f in self.fields]
        return replace(self, fields=tuple(fields))


@dataclass(frozen=True)
class Star:
    """Dimensions and facts that are loaded together."""

    dimensions: tuple[Dimension, ...]
    facts: tuple[Fact, ...] = field(default=())

    def __post_init__(self):
        names = [source.name for dimension in self.dimensions for source in dimension.sources]
        twice = sorted({name for name in names if names.count(name) > 1})
        if twice:
            raise ValueError(f"staging tables {twice} belong to more than one source")

    def dimension(self, name: str) -> Dimension:
        return _named(self.dimensions, name, "dimension")

    def fact(self, name: str) -> Fact:
        return _named(self.facts, name, "fact")

    def with_number_mode(self, mode: str) -> Star:
        """The same star, all amounts parsed by another rule of ``br_number``."""
        return replace(self, facts=tuple(fact.with_number_mode(mode) for fact in self.facts))


def _named(tables: tuple, name: str, kind: str):
    for table in tables:
        if table.name == name:
            return table
    raise ValueError(f"unknown {kind} {name!r}; known: {', '.join(t.name for t in tables)}")
