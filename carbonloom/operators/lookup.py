"""Star lookups: facts joined to dimensions on natural keys, and the rows those joins lose.

How a dimension is joined is left to Spark: it broadcasts by its own size estimate, at run time too, and
splits skewed partitions of a shuffled join. A caller who knows better asks for salts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def spread_lookup(
    fact: DataFrame, dim: DataFrame, on: str, row_id: Column, how: str = "inner", salts: int | None = None
) -> DataFrame:
    """Lookup in a dimension without a size bound; with ``salts``, see :func:`salted_lookup`."""
    return fact.join(dim, on, how) if salts is None else salted_lookup(fact, dim, on, row_id, salts, how)


def salted_lookup(
    fact: DataFrame, dim: DataFrame, on: str, row_id: Column, salts: int, how: str = "inner"
) -> DataFrame:
    """Shuffled lookup in which each key's fact rows go to ``salts`` groups.

    ``row_id`` only spreads the rows; a function of the row keeps the split the same when a task
    is run again. Each dimension row is repeated once per salt.
    """
    if how not in ("inner", "left"):
        raise ValueError("only the fact side may be kept whole")
    spread = fact.withColumn("_salt", F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int"))
    repeated = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [on, "_salt"], how).drop("_salt")


def star(fact: DataFrame, *lookups: tuple[DataFrame, str]) -> DataFrame:
    """Inner lookups in order; fact rows without a match are lost, as :func:`lookup_losses` counts.

    Without a hint: Spark broadcasts a dimension whose known size is below its threshold, and
    splits skewed partitions of a shuffled join.
    """
    return reduce(lambda joined, step: joined.join(step[0], step[1], "inner"), lookups, fact)


def missing_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks (NULL keys are not counted)."""
    keys = left.select(F.col(left_key).alias("key")).where(F.col("key").isNotNull()).distinct()
    return keys.join(right.select(F.col(right_key).alias("key")), "key", "left_anti")


def key_difference(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Both directions at once: (side, key) with side 'missing' (not in right) or 'extra'."""
    return (
        missing_keys(left, left_key, right, right_key)
        .withColumn("side", F.lit("missing"))
        .unionByName(missing_keys(right, right_key, left, left_key).withColumn("side", F.lit("extra")))
        .select("side", "key")
    )


def lookup_losses(fact: DataFrame, dims: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Rows that each inner lookup would drop: (lookup, rows_lost), from one scan of ``fact``.

    ``dims`` maps a lookup name to (dimension, fact key, dimension key). Rows are counted per lookup and key before the one
    join, so a hot key reaches it as one row; keys meet as text, NULL ones are lost.
    """

    def entry(number: int, key: Column) -> Column:
        return F.struct(F.lit(number).alias("_l"), key.cast("string").alias("_k"))

    lookups = list(dims.items())
    wanted = F.array(*(entry(i, F.col(fact_key)) for i, (_, (_, fact_key, _)) in enumerate(lookups)))
    per_key = fact.select(F.inline(wanted)).groupBy("_l", "_k").agg(F.count(F.lit(1)).alias("_n"))
    known = reduce(
        DataFrame.unionByName,
        [dim.select(F.lit(i).alias("_l"), F.col(dim_key).cast("string").alias("_k")) for i, (_, (dim, _, dim_key)) in enumerate(lookups)],
    )
    lost = per_key.join(known, ["_l", "_k"], "left_anti")
    # a lookup that loses nothing, or a fact without rows, has a row all the same
    names = F.array(*(F.struct(F.lit(i).alias("_l"), F.lit(name).alias("lookup")) for i, (name, _) in enumerate(lookups)))
    numbers = fact.sparkSession.range(1).select(F.inline(names))
    sums = lost.groupBy("_l").agg(F.sum("_n").alias("rows_lost"))
    return numbers.join(sums, "_l", "left").select("lookup", F.coalesce("rows_lost", F.lit(0)).cast("long").alias("rows_lost"))
