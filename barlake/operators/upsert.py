"""Upsert into the bar table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from barlake.operators.partitions import Version, in_partitions, loaded_partitions, partition_columns
from barlake.operators.table import clustered, current, symbol_buckets, with_partitions
from barlake.schema import BUCKET_COLUMN, MONTH_COLUMN
from barlake.session import Stage, shared_dir

DEFAULT_KEYS = ("event_time",)

_ACTION = "merge_action"
_ROWS = "source_rows"
_LEFT_OUT = "left out"
_ALONE = "merge_alone"
_IS_SOURCE = "merge_is_source"


@dataclass(frozen=True)
class MergeResult:
    """Row counts of one merge, and the rows without a key that were kept out."""

    source: int
    updated: int
    inserted: int
    rejected: int
    rejects: DataFrame


def _at_most_one(rows: Column) -> Column:
    """True, or an error for more than one row. As a filter it is never optimized away."""
    error = F.raise_error(F.lit("several source rows match one target row"))
    return F.when(rows > 1, error.cast("boolean")).otherwise(True)


def _by_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per source key with its values and the number of rows it had.

    Grouping shrinks a key with many copies before the shuffle.
    """
    values = [c for c in source.columns if c not in keys]
    return source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(_ROWS), *(F.any_value(c).alias(f"new_{c}") for c in values)
    )


def _already_by_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same for a source in which no key repeats, without grouping."""
    return source.select(
        *(F.col(c) if c in keys else F.col(c).alias(f"new_{c}") for c in source.columns), F.lit(1).alias(_ROWS)
    )


def _apply(target: DataFrame, source: DataFrame, by_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    columns = target.columns
    hit = F.col(_ROWS).isNotNull()
    present = (
        target.join(by_key, list(keys), "left")
        .filter(_at_most_one(F.col(_ROWS)))
        .select(
            *(c if c in keys else F.when(hit, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in columns),
            F.when(hit, "updated").otherwise("kept").alias(_ACTION),
        )
    )
    # Grouped before the semi join, so that a key with many target rows is
    # reduced in the map tasks; Catalyst turns the two around where the source
    # is small enough to be broadcast.
    taken = target.select(*keys).distinct().join(by_key.select(*keys), list(keys), "left_semi")
    new = source.join(taken, list(keys), "left_anti").select(*columns)
    return present.unionByName(new.withColumn(_ACTION, F.lit("inserted")))


def merge_actions(target: DataFrame, source: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Target rows after an upsert of ``source``, with what became of each in ``merge_action``.

    A target row whose key is in the source takes the source's values
    (``updated``), the others stay (``kept``); source rows without a target row
    are added (``inserted``). Keys match by equality, so a NULL key never does.
    Two source rows for one target row are an error, raised when the rows are
    computed; source rows that match nothing may share a key.
    """
    source = source.select(*target.columns)
    return _apply(target, source, _by_key(source, keys), keys)


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Target rows after an upsert of ``source``."""
    return merge_actions(target, source, keys).drop(_ACTION)


def merge_by_grouping(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The upsert in one shuffle: rows with their action, and the keys that repeat, which have a row ``left out`` there.

    Target and source are put on one pile and grouped by key. Where a key has at most one row of each, as
    keys of bars do, the group tells what becomes of it. Repeated keys shrink to one row in the map tasks, so a hot one
    reaches no task whole; their rows are for ``merge_actions``. A row with a NULL in its key matches nothing and is a group of its own.
    """
    columns = target.columns
    values = [c for c in columns if c not in keys]
    nothing = _any_null(keys)

    def tagged(rows: DataFrame, own: Column, is_source: bool) -> DataFrame:
        return rows.select(*columns, F.when(nothing, own).alias(_ALONE), F.lit(is_source).alias(_IS_SOURCE))

    number = F.monotonically_increasing_id()
    pile = tagged(target, number, False).unionByName(tagged(source, -1 - number, True))
    of_source, of_target = F.col(_IS_SOURCE), ~F.col(_IS_SOURCE)
    groups = pile.groupBy(*keys, _ALONE).agg(
        F.count_if(of_target).alias("n_target"),
        F.count_if(of_source).alias(_ROWS),
        *(F.any_value(F.when(of_target, F.col(c)), True).alias(f"old_{c}") for c in values),
        *(F.any_value(F.when(of_source, F.col(c)), True).alias(f"new_{c}") for c in values),
    )
    single, new = (F.col("n_target") <= 1) & (F.col(_ROWS) <= 1), F.col(_ROWS) == 1
    rows = groups.select(
        *(c if c in keys else F.when(new, F.col(f"new_{c}")).otherwise(F.col(f"old_{c}")).alias(c) for c in columns),
        F.when(~single, _LEFT_OUT).when(F.col("n_target") == 0, "inserted").when(new, "updated").otherwise("kept").alias(_ACTION),
    )
    counts = pile.groupBy(*keys, _ALONE).agg(F.count_if(of_target).alias("n_target"), F.count_if(of_source).alias(_ROWS))
    return rows, counts.filter(~single).select(*keys)


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))


def _out_of_range() -> Column:
    """Times of years that a date can't be written for, such as microseconds read as milliseconds."""
    return F.coalesce(~F.year("event_time").between(1, 9999), F.lit(False))


def _partitions_in(
    staged: DataFrame, parts: Sequence[str], bad: Column, keys: Sequence[str], unit: str | None
) -> list:
    """One row per partition of the source: rows, rows to keep out, and whether units may clash.

    Units that share no key cannot clash. With the symbol in the key, only a row
    outside the month of its unit can meet a row of another unit.
    """
    rows = [F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected")]
    totals = [F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected")]
    if unit is None:
        per_unit, clash = staged.groupBy(*parts).agg(*rows), F.lit(False)
    else:
        per_unit = staged.groupBy(*parts, unit).agg(*rows)
        clash = F.count(F.lit(1)) > 1
        if "symbol" in keys:
            clash = F.bool_or(F.substring(unit, 1, 7) != F.date_format(MONTH_COLUMN, "yyyy-MM"))
    return per_unit.groupBy(*parts).agg(*totals, F.coalesce(clash, F.lit(False)).alias("clash")).collect()


def _one_unit_after_another(stage: Stage, source: DataFrame, keys: Sequence[str], unit: str) -> DataFrame:
    """What loading the units in turn would leave of rows that share a key.

    The first unit inserts its rows and each later one overwrites their values,
    so the first unit's rows stay and carry the last unit's values. A later unit
    with several rows for the key is the same error as in the merge.
    """
    values = [c for c in source.columns if c not in (*keys, unit)]
    per_unit = source.groupBy(*keys, unit).agg(
        F.count(F.lit(1)).alias("n"), F.any_value(F.struct(*values)).alias("new")
    )
    per_key = per_unit.groupBy(*keys).agg(
        F.min(F.struct(unit, "n")).alias("first"),
        F.max(unit).alias("last"),
        F.max_by("new", unit).alias("new"),
        F.count_if(F.col("n") > 1).alias("repeated"),
    )
    later_repeats = F.col("repeated") - (F.col("first.n") > 1).cast("int")
    # Stored, because adaptive execution splits a hot key only between a join and
    # its two shuffles, with no grouping in between.
    resolved = stage.store(per_key.filter(_at_most_one(later_repeats + 1)))
    joined = source.join(resolved, list(keys), "left")
    first = F.col(f"first.{unit}")
    stay = joined.filter(first.isNull() | (F.col(unit) == first))
    overwritten = F.col("last") != first
    return stay.select(
        *(F.when(overwritten, F.col("new")[c]).otherwise(F.col(c)).alias(c) if c in values else c for c in source.columns)
    )


def merge_into(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    unit: str | None = None,
    null_keys: str = "reject",
) -> MergeResult:
    """Upsert ``source`` into ``table``, rewriting only the partitions it has rows for.

    A row goes to the month of its own time; rows of years beyond 1 to 9999 are kept out as well. Partitions the table does not hold yet
    are written without any join. Rows without a key are kept out and returned
    in ``rejects``; with ``null_keys="insert"`` they are inserted, again on every
    call, as equality makes them. ``unit`` names a column that orders units
    loaded together, see ``_one_unit_after_another``.

    New rows are written beside the old ones and swapped in partition by partition: if the driver is lost, each
    partition has its old or its new rows. The table has no snapshots: one writer at a time, and a reader may
    see some months before others. A table with symbol buckets needs the symbol among the keys.
    """
    if "symbol" not in keys and BUCKET_COLUMN in spark.table(table).columns:
        raise ValueError("keys of a table with symbol buckets must include the symbol")
    if null_keys not in ("reject", "insert"):
        raise ValueError(f"unknown null_keys: {null_keys}")
    with Stage(spark) as stage:
        return _merge_staged(spark, stage, table, source, keys, unit, null_keys == "reject")


def _keep(spark: SparkSession, rows: DataFrame) -> DataFrame:
    path = shared_dir(spark, "rejects")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _write(version: Version, result: DataFrame, columns: Sequence[str], parts: Sequence[str]) -> list[int]:
    """Rows updated and inserted, and keys left out. Counted behind the last shuffle: tasks that are run again after a loss count once there."""
    counted = Observation()
    actions = "updated", "inserted", _LEFT_OUT
    rows = clustered(result, *parts).observe(counted, *(F.count_if(F.col(_ACTION) == a).alias(a) for a in actions))
    rows = rows.filter(F.col(_ACTION) != _LEFT_OUT)
    version.write(rows.select(*columns).sortWithinPartitions(*parts, "event_time"))
    return [counted.get[a] for a in actions]


def _merge_staged(
    spark: SparkSession,
    stage: Stage,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    unit: str | None,
    reject_null_keys: bool,
) -> MergeResult:
    columns, parts = spark.table(table).columns, partition_columns(spark, table)
    month = F.when(~_out_of_range(), F.col(MONTH_COLUMN)).alias(MONTH_COLUMN)
    staged = with_partitions(source, symbol_buckets(spark, table)).select(*columns, *([unit] if unit else []))
    usable = stage.store(staged.select(*(month if c == MONTH_COLUMN else c for c in staged.columns)))
    bad = _out_of_range() | _any_null(keys) if reject_null_keys else _out_of_range()
    summary = _partitions_in(usable, parts, bad, keys, unit)
    rows, rejected = sum(m["rows"] for m in summary), sum(m["rejected"] for m in summary)
    rejects = _keep(spark, usable.filter(bad)) if rejected else spark.createDataFrame([], usable.schema)
    usable = usable.filter(~bad)
    summary = [m for m in summary if m["rows"] > m["rejected"]]
    if not summary:
        return MergeResult(rows, 0, 0, rejected, rejects)

    partition = lambda m: tuple(m[c] for c in parts)
    touched = [partition(m) for m in summary]
    clashing = [partition(m) for m in summary if m["clash"]]
    if clashing:
        mixed = _one_unit_after_another(stage, usable.filter(in_partitions(clashing, parts)), keys, unit)
        plain = [p for p in touched if p not in clashing]
        usable = mixed.unionByName(usable.filter(in_partitions(plain, parts))) if plain else mixed
    usable = usable.select(*columns)

    folders = loaded_partitions(spark, table, [p[0] for p in touched])
    old = {p: folders[p] for p in touched if p in folders}
    new = [p for p in touched if p not in old]
    results = []
    if new:
        results.append(usable.filter(in_partitions(new, parts)).withColumn(_ACTION, F.lit("inserted")))
    if old:
        held = in_partitions(old, parts)
        target, incoming = current(spark, table).filter(held), usable.filter(held)
        grouped, repeated_keys = merge_by_grouping(target, incoming, keys)
        results.append(grouped)
    with Version(spark, table) as version:
        updated, inserted, repeated = _write(version, reduce(DataFrame.unionByName, results), columns, parts)
        if repeated:
            left_out = stage.store(repeated_keys)
            target, incoming = (x.join(left_out, list(keys), "left_semi") for x in (target, incoming))
            # Stored and grouped, so that a hot target key can be split in the join.
            more = _write(version, _apply(target, incoming, stage.store(_by_key(incoming, keys)), keys), columns, parts)
            updated, inserted = updated + more[0], inserted + more[1]
        version.swap(old)
    return MergeResult(rows, updated, inserted, rejected, rejects)
