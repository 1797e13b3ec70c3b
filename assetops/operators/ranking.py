"""Ranks and dense numbers over a whole table without a one-partition window.

``RANK() OVER (ORDER BY v)`` would sort every row in a single task.  Here the
distinct values are counted first (ties, however many, become one row), range-
partitioned into ordered buckets, numbered inside each bucket and shifted by
the totals of the buckets before it.  Buckets are written out, so a task that is
retried finds them unchanged.  There is one path, whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetops.storage import cut

HOT_SHARE = 1024  # a value with a 1024th of all rows is hot: at most so many are


@dataclass(frozen=True)
class RankBy:
    """``out`` = rank by ``col`` among the rows that agree on ``within``; NULLs
    come first when descending and last when ascending.  Any orderable type."""

    col: str
    out: str
    descending: bool = True
    dense: bool = False
    within: tuple[str, ...] = ()

    def order(self, col: str | None = None) -> Column:
        column = F.col(col or self.col)
        return column.desc_nulls_first() if self.descending else column.asc_nulls_last()


def bounded_rank(df: DataFrame, ranks: list[RankBy]) -> DataFrame:
    """Ranks by plain windows, for frames the model bounds (departments)."""
    return df.withColumns(
        {
            by.out: (F.dense_rank() if by.dense else F.rank())
            .over(Window.partitionBy(*by.within).orderBy(by.order()))
            .cast("bigint")
            for by in ranks
        }
    )


def _bucketed(df: DataFrame, *columns: str) -> DataFrame:
    """Adds ``bucket``, monotone in the order of ``columns``, and writes it out."""
    order = [F.col(c).asc_nulls_last() for c in columns]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartitionByRange(parts, *order).withColumn("bucket", F.spark_partition_id()))


Spec = tuple[str, tuple[str, ...]]  # a ranked column and the groups it is ranked in


def _fields(specs: list[Spec]) -> tuple[list[str], list[str]]:
    """Names of the stacked groups and values: each spec has fields of its own."""
    groups = [f"_w{j}_{i}" for j, (_, within) in enumerate(specs) for i in range(len(within))]
    return groups, [f"_v{j}" for j in range(len(specs))]


def _bucketed_values(df: DataFrame, col: str, within: tuple[str, ...], *more: Spec) -> DataFrame:
    """Distinct (spec, groups, value) with the number of ties and a bucket, for all
    specs in one pass: a row is stacked once per spec with the others' fields NULL."""
    specs = [(col, within), *more]
    groups, values = _fields(specs)
    source = {f"_w{j}_{i}": c for j, (_, names) in enumerate(specs) for i, c in enumerate(names)}
    source |= {f"_v{j}": c for j, (c, _) in enumerate(specs)}

    def entry(j: int) -> Column:
        own = {*(f"_w{j}_{i}" for i in range(len(specs[j][1]))), f"_v{j}"}
        fields = [F.when(F.lit(name in own), F.col(source[name])).alias(name) for name in (*groups, *values)]
        return F.struct(F.lit(j).alias("_spec"), *fields)

    stacked = df.select(F.inline(F.array(*(entry(j) for j in range(len(specs))))))
    counted = stacked.groupBy("_spec", *groups, *values).agg(F.count(F.lit(1)).alias("_ties"))
    return _bucketed(counted, "_spec", *groups, *values)


def _offsets(bucketed: DataFrame, within: list[str]) -> DataFrame:
    """Per group and bucket the ties (``_t``) and values (``_n``) in the buckets
    before it and in the whole group.  A group has at most one row per shuffle
    partition here, which bounds the windows."""
    totals = bucketed.groupBy(*within, "bucket").agg(F.sum("_ties").alias("t"), F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*within)
    before = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *within,
        "bucket",
        *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}_before") for c in ("t", "n")),
        *(F.sum(c).over(group).alias(f"_{c}_all") for c in ("t", "n")),
    )


def _positions(bucketed: DataFrame, specs: list[Spec], ranks: list[RankBy]) -> DataFrame:
    """(spec, groups, values, ties, rank, ...): what lies before a value inside its
    bucket, in the buckets before, and, for descending ranks, after it."""
    groups, values = _fields(specs)
    within = ["_spec", *groups]
    inside = Window.partitionBy(*within, "bucket").orderBy(*(F.col(v).asc_nulls_last() for v in values))
    counted = bucketed.withColumns(
        {
            "_t_in": F.coalesce(F.sum("_ties").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_n_in": F.row_number().over(inside) - 1,
        }
    )
    same = F.col("in.bucket") == F.col("at.bucket")
    for c in within:
        same = same & F.col(f"in.{c}").eqNullSafe(F.col(f"at.{c}"))
    offsets = _offsets(bucketed, within)
    # Without groups the offsets are one row per shuffle partition and spec.
    side = offsets if groups else F.broadcast(offsets)
    ties_before, values_before = F.col("_t_before") + F.col("_t_in"), F.col("_n_before") + F.col("_n_in")

    def rank(by: RankBy) -> Column:
        # NULLs are last ascending and first descending, so the orders are mirrored.
        if by.dense:
            out = F.col("_n_all") - values_before if by.descending else values_before + 1
        else:
            out = F.col("_t_all") - ties_before - F.col("_ties") + 1 if by.descending else ties_before + 1
        return out.cast("bigint").alias(by.out)

    columns = [*(F.col(f"in.{c}") for c in (*within, *values)), F.col("_ties")]
    return counted.alias("in").join(side.alias("at"), same).select(*columns, *(rank(by) for by in ranks))


def global_rank(df: DataFrame, ranks: list[RankBy], is_cut: bool = False) -> DataFrame:
    """Adds each rank as a column, all of them in one pass over the distinct values
    of their columns.  ``df`` is cut first, so its own inputs are read once.  Ranks
    join back by value: hot values, of which there are at most ``HOT_SHARE``, as a
    broadcast, so that no task of the shuffled join gets more than that share of
    the rows by one value."""
    ranked = base = df if is_cut else cut(df)
    specs = list(dict.fromkeys((by.col, by.within) for by in ranks))
    places = cut(_positions(_bucketed_values(base, *specs[0], *specs[1:]), specs, ranks))
    # No more than HOT_SHARE values can reach this bound.
    hot = F.col("_ties") * HOT_SHARE >= base.count()
    for j, (col, within) in enumerate(specs):
        names = {f"_w{j}_{i}": c for i, c in enumerate(within)} | {f"_v{j}": col}
        mine = [by.out for by in ranks if (by.col, by.within) == (col, within)]
        own = places.where(F.col("_spec") == j).select(*names, "_ties", *mine)
        same = F.lit(True)
        for name, c in names.items():
            same = same & F.col(c).eqNullSafe(F.col(name))
        few = F.broadcast(own.where(hot))
        rest = ranked.join(few.select(*names), same, "left_anti")
        both = ranked.join(few, same).unionByName(rest.join(own.where(~hot), same))
        ranked = both.drop("_ties", *names)
    return ranked.select(*base.columns, *(by.out for by in ranks))


def row_numbers(df: DataFrame, by: RankBy, unique: str, also: list[RankBy] | None = None) -> DataFrame:
    """Adds ``by.out`` = ROW_NUMBER by ``by.col``, ties in order of ``unique``:
    the rank of the value plus the position among its ties; and the ranks ``also``."""
    ties = RankBy(unique, "_tie", descending=False, within=(*by.within, by.col))
    ranked = global_rank(df, [by, *(also or []), ties])
    return ranked.withColumn(by.out, F.col(by.out) + F.col("_tie") - 1).drop("_tie")


def dense_numbers(df: DataFrame, key: str, out: str, start: int = 0) -> DataFrame:
    """``start + 1, start + 2, ...`` in the order of the unique ``key``."""
    bucketed = _bucketed(df, key).withColumn("_ties", F.lit(1))
    offsets = _offsets(bucketed, []).select("bucket", F.col("_t_before").alias("offset0"))
    number = F.row_number().over(Window.partitionBy("bucket").orderBy(F.col(key).asc_nulls_last()))
    return (
        bucketed.join(F.broadcast(offsets), "bucket")
        .withColumn(out, (number + F.col("offset0") + start).cast("bigint"))
        .drop("bucket", "offset0", "_ties")
    )


def append_with_keys(base: DataFrame, new: DataFrame, key: str, order_by: str) -> DataFrame:
    """``new`` with keys that continue after the highest key of ``base``."""
    top = base.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).first()["top"]
    return dense_numbers(new, order_by, key, start=int(top))


def random_parents(rows: DataFrame, row_key: str, parents: dict[str, DataFrame], seed: int = 1) -> DataFrame:
    """``rows`` with a random key of each parent table in the column of its name.

    ``parents`` gives, per new column, a frame whose first column holds the keys;
    they may be sparse, repeat, or be NULL.  The distinct keys get dense positions,
    a row's digest of seed, column and row key is reduced to one of them, and the
    two meet in an equi-join.  The choice depends on nothing else, so a retried
    task or a re-run draws the same; positions are even, so no parent is hot.
    Without parents the column is NULL."""
    out = rows
    for name, keys in parents.items():
        key = F.col(keys.columns[0])
        places = cut(dense_numbers(keys.select(key.alias(name)).where(key.isNotNull()).distinct(), name, "_place"))
        total = places.count()
        digest = F.md5(F.concat_ws(":", F.lit(seed), F.lit(name), F.col(row_key).cast("string")))
        drawn = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % max(1, total) + 1
        out = out.withColumn("_drawn", drawn).join(places, F.col("_drawn") == F.col("_place"), "left").drop("_drawn", "_place")
    return out
