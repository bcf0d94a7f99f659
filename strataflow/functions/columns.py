"""Names, completeness and numbers."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD_NUMBER_MODES = ("error", "null")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col(quoted(name))


def feature_name(source: str, category: str) -> str:
    return f"{source}_{category}".replace(" ", "_")


def check_names(names: Iterable[str]) -> None:
    """Raise if two names are equal in a catalog that ignores case."""
    seen: dict[str, str] = {}
    for name in names:
        if name.lower() in seen:
            raise ValueError(f"columns {seen[name.lower()]!r} and {name!r} collide")
        seen[name.lower()] = name


def sanitize_names(df: DataFrame) -> DataFrame:
    """Replace blanks in column names by underscores."""
    renamed = [name.replace(" ", "_") for name in df.columns]
    check_names(renamed)
    return df.toDF(*renamed)


def combine(operation: Callable[[Column, Column], Column], terms: Sequence[Column], empty: Column) -> Column:
    """Combine by halves, so that the expression stays shallow for many terms."""
    terms = list(terms)
    while len(terms) > 1:
        pairs = [operation(a, b) for a, b in zip(terms[::2], terms[1::2])]
        terms = pairs + terms[len(pairs) * 2 :]
    return terms[0] if terms else empty


def present(field: T.StructField) -> Column:
    value = column(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return value.isNotNull() & ~F.isnan(value)
    return value.isNotNull()


def all_present(schema: T.StructType, names: Sequence[str]) -> Column:
    """True where none of the columns is null or NaN.

    A conjunction of ``isNotNull`` reaches the Parquet scan as pushed filters, which the
    count of non-null columns behind ``dropna`` does not.
    """
    return combine(operator.and_, [present(schema[name]) for name in names], F.lit(True))


def complete_rows(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Rows with a value in each of the columns (all columns by default).

    ``isNotNull`` reaches the scan, ``dropna`` then has NaN left to look for: it is one
    expression, where one ``isnan`` per column of a wide table is slow.
    """
    names = df.columns if names is None else names
    filled = df.filter(combine(operator.and_, [column(name).isNotNull() for name in names], F.lit(True)))
    fractions = [name for name in names if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))]
    return filled.dropna(subset=[quoted(name) for name in fractions]) if fractions else filled


def number(name: str, data_type: T.DataType, on_bad: str = "error", shown: str | None = None) -> Column:
    """The column as double, NaN as null.

    Text that is no number and infinite values raise, or become null with
    ``on_bad="null"``. Does not depend on the session's ANSI setting.
    """
    if on_bad not in BAD_NUMBER_MODES:
        raise ValueError(f"on_bad must be one of {BAD_NUMBER_MODES}, not {on_bad!r}")
    raw = column(name)
    if isinstance(data_type, (T.IntegralType, T.DecimalType)):
        return raw.cast("double")
    fractional = isinstance(data_type, T.FractionalType)
    value = raw.cast("double") if fractional else raw.try_cast("double")
    bad = F.abs(value) == F.lit(float("inf"))
    if not fractional:
        # a cast takes "12d" and "12f" for numbers
        suffix = F.substring(F.trim(raw.cast("string")), -1, 1).isin("d", "D", "f", "F")
        bad = bad | (raw.isNotNull() & value.isNull()) | suffix
    if on_bad == "null":
        return F.when(~(bad | F.isnan(value)), value)
    message = F.concat(F.lit(f"not a finite number in {shown or name}: "), raw.cast("string"))
    return F.when(bad, F.raise_error(message)).when(~F.isnan(value), value)


def number_present(name: str, data_type: T.DataType, on_bad: str = "error") -> Column:
    """Where :func:`number` gives a value or raises. Never raises itself, so it may be a filter."""
    raw = column(name)
    if isinstance(data_type, (T.IntegralType, T.DecimalType)):
        return raw.isNotNull()
    if on_bad == "error":
        return raw.isNotNull() & ~F.isnan(raw.try_cast("double"))
    return raw.isNotNull() & number(name, data_type, on_bad).isNotNull()


def numbers_present(schema: T.StructType, names: Sequence[str], on_bad: str = "error") -> Column:
    """True where every one of the columns has a number."""
    return combine(operator.and_, [number_present(n, schema[n].dataType, on_bad) for n in names], F.lit(True))
