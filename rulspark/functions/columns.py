"""Column expressions; all of them stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """A top-level column whose name may hold blanks or dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def clip(value: Column, upper: float | None = None, lower: float | None = None) -> Column:
    """Bound a value on either side; NULL and NaN stay as they are."""
    out = value
    if lower is not None:
        out = F.when(value < F.lit(float(lower)), F.lit(float(lower))).otherwise(out)
    if upper is not None:
        above = (value > F.lit(float(upper))) & ~F.isnan(value)
        out = F.when(above, F.lit(float(upper))).otherwise(out)
    return out


def unit_id(dataset: Column, unit_orig: Column) -> Column:
    """``DS03_012``; numbers wider than the padding are kept whole."""
    return F.format_string("DS%02d_%03d", dataset.cast("int"), unit_orig.cast("int"))


def unit_dataset(unit: Column) -> Column:
    """The dataset part of a unit id, ``unknown`` where there is none."""
    return F.when(
        F.instr(unit, "_") > 0, F.split_part(unit, F.lit("_"), F.lit(1))
    ).otherwise(F.lit("unknown"))


def path_dataset(path: Column) -> Column:
    """The dataset number in a path such as ``.../dataset=3/...`` or ``.../dataset3/...``."""
    return F.regexp_extract(path, r"dataset=?(\d+)", 1).try_cast("int")


def pct_change(new: Column, base: Column) -> Column:
    return F.try_divide((new - base) * F.lit(100.0), base)


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation as an aggregate, NULL where a side is constant or a pair is missing."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def squared(value: Column) -> Column:
    return value * value


def signed_error(predicted: Column, actual: Column) -> Column:
    return (predicted - actual).cast("float")
