"""Column expressions for projecting and cleaning source rows.

Every function returns a ``Column`` made of built-in expressions, so the whole
projection stays inside one generated stage and filters on it can be pushed
towards the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping as MappingType, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

UNKNOWN_PLACE = "Tidak Diketahui"


def first_existing_column(
    df: DataFrame, candidates: Sequence[str], *, required: bool = False
) -> str | None:
    """The first of ``candidates`` that ``df`` has, decided from its schema."""
    present = set(df.columns)
    found = next((name for name in candidates if name in present), None)
    if found is None and required:
        raise ValueError(
            f"none of the columns {list(candidates)} exists; the table has {df.columns}"
        )
    return found


def literal_tags(df: DataFrame, **tags: str) -> DataFrame:
    """Add constant columns which say where the rows come from."""
    return df.withColumns({name: F.lit(value) for name, value in tags.items()})


def prefixed_id(prefix: str, native_id: Column | str) -> Column:
    """``prefix || id``; a NULL native id stays NULL so that a gate can see it."""
    return F.concat(F.lit(prefix), _col(native_id).cast("string"))


def text_key(column: Column | str) -> Column:
    """P5: a join key as string, whatever numeric type the source uses."""
    return _col(column).cast("string")


def safe_date(column: Column | str) -> Column:
    """A date, or NULL where the text is no date (never an error under ANSI)."""
    return _col(column).try_cast("date")


def rescale(
    column: Column | str, decimal_type: str, *, times: int = 1, divided_by: int = 1
) -> Column:
    """Convert a unit or a scale and fix the precision of the result.

    The value is NULL when it does not fit ``decimal_type``, so that an absurd
    measure is rejected by the gate and does not abort the job.  The plain
    comparison before the cast keeps such values off its slow path.
    """
    value = _col(column)
    kind = DecimalType.fromDDL(decimal_type)
    if times != 1:
        value = value * F.lit(times)
    if divided_by != 1:
        value = value / F.lit(divided_by)
    limit = F.lit(float(10 ** (kind.precision - kind.scale)))
    return F.when(F.abs(value.try_cast("double")) < limit, value.try_cast(decimal_type))


def threshold_label(
    value: Column, threshold: float, passed: str = "lulus", failed: str = "tidak_lulus"
) -> Column:
    """P10: a pass/fail label; NULL counts as failed."""
    return F.when(value >= F.lit(threshold), F.lit(passed)).otherwise(F.lit(failed))


def blank_to_unknown(column: Column | str | None, unknown: str = UNKNOWN_PLACE) -> Column:
    """NULL, blank and ``nan`` become ``unknown``; other text stays untrimmed.

    ``None`` stands for a source which has no such column.
    """
    if column is None:
        return F.lit(unknown)
    value = _col(column)
    squeezed = F.lower(F.trim(value))
    return F.when(value.isNull() | squeezed.isin("", "nan"), F.lit(unknown)).otherwise(value)


def recode(value: Column, cases: MappingType[str, str]) -> Column:
    """Replace some values and keep the others."""
    return _case(value, cases).otherwise(value)


def category_of(
    value: Column, categories: MappingType[str, Iterable[str]], otherwise: str
) -> Column:
    """The name of the category that lists the value."""
    result = None
    for name, members in categories.items():
        test = value.isin(*members)
        result = F.when(test, F.lit(name)) if result is None else result.when(test, F.lit(name))
    return result.otherwise(F.lit(otherwise))


def ordinal_rank(value: Column, ranks: MappingType[str, int], otherwise: int) -> Column:
    """P20: the rank of an ordered category."""
    return _case(value, ranks).otherwise(F.lit(otherwise))


def equality_flag(value: Column, wanted: str) -> Column:
    """1 where the value equals ``wanted``, else 0 (also for NULL)."""
    return F.when(value == F.lit(wanted), F.lit(1)).otherwise(F.lit(0))


def presence_flag(value: Column) -> Column:
    """1 where there is a value; an empty string is a value."""
    return F.when(value.isNotNull(), F.lit(1)).otherwise(F.lit(0))


def whole_number(value: Column) -> Column:
    """Cut off the fraction."""
    return value.cast("int")


def _case(value: Column, cases: MappingType[str, object]) -> Column:
    result = None
    for key, label in cases.items():
        test = value == F.lit(key)
        result = F.when(test, F.lit(label)) if result is None else result.when(test, F.lit(label))
    return result


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
