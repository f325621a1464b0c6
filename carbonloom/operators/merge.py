"""Type-1 dimension merge and idempotent reload on plain DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .keys import dense_keys


def one_row_per_key(source: DataFrame, key: str) -> DataFrame:
    """The source unchanged, or a failed job if a key occurs twice: a merge must not fan out."""
    others = [c for c in source.columns if c != key]
    packed = source.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*others)).alias("_row")
    )
    message = F.concat(F.lit("several source rows for key "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    # a filter, so that no projection can prune the check away
    unique = F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return packed.where(unique).select(key, *(F.col(f"_row.{c}").alias(c) for c in others))


def scd1_merge(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: Sequence[str],
    surrogate: str,
    keep_if_null: Sequence[str] = (),
    insert_default: dict[str, object] | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """The target after an upsert of ``source``.

    ``update`` names the columns that a match overwrites and an insert fills; other target columns
    stay as they are and are NULL on insert. A NULL in a ``keep_if_null`` column leaves the old
    value. ``insert_default`` replaces NULL on insert only. Existing surrogate keys survive; new
    rows get the next ones. An empty source leaves the target as it is.
    """
    defaults = insert_default or {}
    fixed = [c for c in target.columns if c not in (key, surrogate, *update)]
    if check_unique:
        source = one_row_per_key(source.select(key, *update), key)
    new = source.select(key, *(F.col(c).alias(f"_s_{c}") for c in update), F.lit(True).alias("_matched"))

    def as_target(column: str, value: Column) -> Column:
        return value.cast(target.schema[column].dataType).alias(column)

    def updated(column: str) -> Column:
        value, old = F.col(f"_s_{column}"), F.col(column)
        return F.when(F.col("_matched"), F.coalesce(value, old) if column in keep_if_null else value).otherwise(old)

    def inserted(column: str) -> Column:
        value = F.col(column)
        return F.coalesce(value, F.lit(defaults[column])) if column in defaults else value

    known = target.join(new, key, "left").select(
        *(as_target(c, updated(c)) if c in update else F.col(c) for c in target.columns)
    )
    last = target.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("last")).scalar()
    fresh = dense_keys(source.join(target.select(key), key, "left_anti"), key, surrogate, last).select(
        F.col(surrogate),
        F.col(key),
        *(as_target(c, inserted(c)) for c in update),
        *(as_target(c, F.lit(None)) for c in fixed),
    )
    return known.unionByName(fresh).select(*target.columns)


def staged_keys(staged: DataFrame, key: str) -> DataFrame:
    """The key values that a reload replaces: those staged, before any lookup loses rows."""
    return staged.select(key).where(F.col(key).isNotNull()).distinct()


def replace_slices(existing: DataFrame, rows: DataFrame, key: str, staged: DataFrame | None = None) -> DataFrame:
    """Idempotent reload: rows of every ``key`` value of ``staged`` (``rows`` itself if not given) give way to ``rows``.

    A staged value whose rows the lookups have all lost is left without rows.
    """
    keys = staged_keys(rows if staged is None else staged, key)
    return existing.join(keys, key, "left_anti").unionByName(rows.select(*existing.columns))
