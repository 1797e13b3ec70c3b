"""Constraint violations kept up to date by change feeds.

Stored are, per key rule, how often every value is used, per parent how often it
has every key, and per rule the violations.  A feed changes these counts by +1 for
a new image and -1 for an old one; a rule's violations change only through values
whose uses or whose parent changed, so only the buckets these lie in are read.  All
counts of a feed go into one step of one table: a stop leaves the state before or
after the feed, and a feed that comes again is skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetops.operators.quality import ParentRule, RowRule, Rule, UniqueRule, by_table, stacked
from assetops.sources.versioned import CountTable

USE, KEY, SUM = "use", "key", "sum"
BUCKETS = 16
_KEYS = T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "table_name", "rule", "parent", "value")])


def _bucket() -> Column:
    """Uses and keys of one value share a bucket; sums have one of their own."""
    return F.when(F.col("kind") == SUM, SUM).otherwise(F.pmod(F.xxhash64("value"), F.lit(BUCKETS)).cast("string"))


def _role(*names: Column | str) -> Column:
    """Kind, table, rule and parent as one text.  A use without a parent has three
    parts, one with a parent four, a key two."""
    return F.concat_ws("\u0001", *names)


def whole(df: DataFrame) -> DataFrame:
    """A table as the feed of its first load."""
    new = F.struct("*")
    return df.select(F.lit(None).cast(df.schema).alias("old"), new.alias("new"))


class ConstraintState:
    def __init__(self, spark: SparkSession, path: str, rules: list[Rule]):
        self.rules, self.spark = rules, spark
        self.state = CountTable(spark, path, _KEYS, _bucket())

    def _images(self, feed: DataFrame) -> DataFrame:
        new = feed.where("new is not null").select("new.*", F.lit(1).alias("_d"))
        return new.unionByName(feed.where("old is not null").select("old.*", F.lit(-1).alias("_d")))

    def _row_rules(self, images: DataFrame, table: str, rules: list[RowRule]) -> DataFrame:
        totals = images.agg(*(F.coalesce(F.sum(F.when(r.broken, F.col("_d"))), F.lit(0)).alias(f"r{i}") for i, r in enumerate(rules)))
        pairs = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("n")) for i, r in enumerate(rules)))
        return totals.select(F.lit(SUM).alias("kind"), F.lit(table).alias("table_name"), F.inline(pairs))

    def _key_counts(self, images: DataFrame, table: str, rules: list[UniqueRule | ParentRule], keys: list[str]) -> DataFrame:
        """Uses by rule and the table's own keys, as changes; equal values are
        summed map-side, so a hot one is a row per task.  Whole numbers become
        texts, and entries get their names, once per different value."""
        uses = [(USE, table, r.name, r.parent if isinstance(r, ParentRule) else None, r.column) for r in rules]
        entries = uses + [(KEY, None, None, table, key) for key in keys]
        values = []
        for i, (*_, column) in enumerate(entries):
            whole_number = isinstance(images.schema[column].dataType, T.IntegralType)
            whole = F.col(column) if whole_number else F.lit(None)
            text = F.lit(None) if whole_number else F.col(column)
            values.append(F.struct(F.lit(i).alias("i"), whole.cast("bigint").alias("whole"), text.cast("string").alias("text")))
        rows = images.select("_d", F.inline(F.array(*values))).where("whole is not null or text is not null")
        summed = rows.groupBy("i", "whole", "text").agg(F.sum("_d").alias("n")).where("n <> 0")
        named = {c: F.array(*(F.lit(entry[k]).cast("string") for entry in entries)) for k, c in enumerate(_KEYS.names[:-1])}
        value = F.coalesce("text", F.col("whole").cast("string")).alias("value")
        return summed.select(*(F.get(names, F.col("i")).alias(c) for c, names in named.items()), value, "n")

    def apply(self, feeds: dict[str, DataFrame], batch: int) -> None:
        """Takes in feeds (old, new: whole rows) by table.  Batches are numbered
        upwards; one that was taken in already changes nothing."""
        entry = self.state.entry()
        if batch <= entry.get("batch", -1):
            return
        row_rules, key_rules = by_table(self.rules, RowRule), by_table(self.rules, UniqueRule, ParentRule)
        parents: dict[str, set[str]] = {}
        for r in self.rules:
            if isinstance(r, ParentRule):
                parents.setdefault(r.parent, set()).add(r.key)
        sums, counts = [], []
        for table, feed in feeds.items():
            images = self._images(feed)
            if table in row_rules:
                sums.append(self._row_rules(images, table, row_rules[table]))
            if table in key_rules or table in parents:
                counts.append(self._key_counts(images, table, key_rules.get(table, []), sorted(parents.get(table, ()))))
        written = []
        if counts:
            folders, moved = self.state.stored(stacked(counts))
            written.append(folders)
            sums.append(self._moved_sums(entry, sorted(folders), moved))
        if sums:
            blank = {c: F.lit(None).cast("string") for c in ("parent", "value")}
            made = [s.withColumns(blank).select(*_KEYS.names, F.col("n").cast("bigint").alias("n")) for s in sums]
            written.append(self.state.stored(stacked(made).where("n <> 0"))[0])
        self.state.take_in(written, batch=batch)

    def _moved_sums(self, entry: dict, touched: list[str], moved: DataFrame) -> DataFrame:
        """How the violations of the key rules change by ``moved``, which lies in the
        buckets ``touched``.  Known and moved counts of a rule's value, and those of
        its parent's key, meet in one grouping."""
        rules = [r for r in self.rules if isinstance(r, UniqueRule | ParentRule)]
        # Which rule's uses or parent keys a row counts; as many rows as there are rules, twice.
        roles = []
        for i, r in enumerate(rules):
            parent = r.parent if isinstance(r, ParentRule) else None
            roles.append((USE, r.table, r.name, parent, i))
            if parent is not None:
                roles.append((KEY, None, None, parent, i))
        named = F.array(*(F.struct(_role(*(F.lit(v) for v in role[:-1])).alias("role"), F.lit(role[-1]).alias("i")) for role in roles))
        role = F.broadcast(self.spark.range(1, numPartitions=1).select(F.inline(named)))
        known, zero = self.state.rows(entry, touched), F.lit(0).cast("bigint")
        counts = known.select(*_KEYS.names, F.col("n").alias("n0"), zero.alias("d")).unionByName(
            moved.select(*_KEYS.names, zero.alias("n0"), F.col("n").alias("d"))
        )
        line = counts.withColumn("role", _role(*_KEYS.names[:-1])).join(role, "role").groupBy("i", "value").agg(
            *(F.sum(F.when(F.col("kind") == kind, F.col(n)).otherwise(0)).alias(f"{kind}_{n}") for kind in (USE, KEY) for n in ("n0", "d"))
        )
        has_parent = F.get(F.array(*(F.lit(isinstance(r, ParentRule)) for r in rules)), F.col("i"))

        def broken(n: Column, parent: Column) -> Column:
            without = F.when(parent <= 0, n).otherwise(0)
            return F.when(has_parent, without).otherwise(F.greatest(n - 1, F.lit(0)))

        uses, keys = F.col("use_n0"), F.col("key_n0")
        change = broken(uses + F.col("use_d"), keys + F.col("key_d")) - broken(uses, keys)
        of = {c: F.get(F.array(*(F.lit(getattr(r, a)) for r in rules)), F.col("i")) for c, a in (("table_name", "table"), ("rule", "name"))}
        summed = line.groupBy("i").agg(F.sum(change).alias("n"))
        return summed.select(F.lit(SUM).alias("kind"), *(name.alias(c) for c, name in of.items()), "n")

    def violations(self) -> DataFrame:
        """(table_name, rule, violations) of every rule; only the sums are read."""
        names = F.array(*(F.struct(F.lit(r.table).alias("table_name"), F.lit(r.name).alias("rule")) for r in self.rules))
        none = self.spark.range(1, numPartitions=1).select(F.inline(names)).withColumn("n", F.lit(0).cast("bigint"))
        found = self.state.load([SUM]).select("table_name", "rule", "n")
        return none.unionByName(found).groupBy("table_name", "rule").agg(F.sum("n").alias("violations"))
