"""Work units: one symbol, one year, one month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barlake.schema import UNIT_COLUMNS

# Up to this many units are turned into literals, which prune partitions and
# files before anything is read. More are joined as Spark sees fit; the rows are the same.
MAX_LITERAL_UNITS = 5_000

# ``{symbol}-1m-{yyyy}-{mm}.{extension}``
_NAME_PATTERN = r"([^/]+)-1m-(\d+)-(\d+)\.[^./]+$"


def units_from_name(file_name: Column) -> list[Column]:
    """Unit columns read off a bar file's name."""
    return [F.regexp_extract(file_name, _NAME_PATTERN, i + 1).alias(c) for i, c in enumerate(UNIT_COLUMNS)]


def has_unit_name(file_name: Column) -> Column:
    return file_name.rlike(_NAME_PATTERN)


def unit_label() -> Column:
    """``"yyyy-mm symbol"``: its text order is the order units are loaded in."""
    return F.concat(F.col("year"), F.lit("-"), F.col("month"), F.lit(" "), F.col("symbol"))


def _literal_filter(rows: list) -> Column:
    """The units as predicates on single columns, so that each prunes by itself."""
    values = {c: sorted({row[c] for row in rows}) for c in UNIT_COLUMNS}
    keep = F.lit(True)
    for name, wanted in values.items():
        keep = keep & F.col(name).isin(wanted)
    if len(rows) < len(values["symbol"]) * len(values["year"]) * len(values["month"]):
        keep = keep & unit_label().isin([f"{r['year']}-{r['month']} {r['symbol']}" for r in rows])
    return keep


def few_units(units: DataFrame) -> list | None:
    """The units as rows if there are few enough for literals. Runs a small job on the plan."""
    rows = units.select(*UNIT_COLUMNS).na.drop().distinct().limit(MAX_LITERAL_UNITS + 1).collect()
    return rows if len(rows) <= MAX_LITERAL_UNITS else None


def only_units(df: DataFrame, units: DataFrame) -> DataFrame:
    """Rows of ``df`` that belong to one of ``units``."""
    rows = few_units(units)
    if rows is not None:
        return df.filter(_literal_filter(rows) if rows else F.lit(False))
    units = units.select(*UNIT_COLUMNS).na.drop()
    # One value per calendar month still prunes whole partitions.
    months = [tuple(r) for r in units.select("year", "month").distinct().collect()]
    in_month = F.concat_ws("-", "year", "month").isin([f"{y}-{m}" for y, m in months])
    return df.filter(in_month).join(units, UNIT_COLUMNS, "left_semi")
