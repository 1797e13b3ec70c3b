"""Distributed ranks and numbers equal the one-window forms."""

import random
import subprocess
import sys
from decimal import Decimal

import pytest
from conftest import ROOT, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from assetops.operators.ranking import RankBy, append_with_keys, dense_numbers, global_rank, row_numbers
from assetops.storage import shared_folder


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one value, some have none, the rest tie a little."""
    rng = random.Random(5)
    data = []
    for i in range(6000):
        if i % 3 == 0:
            v = Decimal("7.50")
        elif i % 50 == 1:
            v = None
        else:
            v = Decimal(rng.randrange(-3000, 3000)) / 4
        data.append((i, "hot" if i % 4 else f"g{i % 16}", v))
    return spark.createDataFrame(data, "id bigint, g string, v decimal(12,2)")


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("dense", [True, False])
@pytest.mark.parametrize("within", [(), ("g",)])
def test_equals_plain_rank(skewed, descending, dense, within):
    by = RankBy("v", "r", descending, dense, within)
    order = F.col("v").desc_nulls_first() if descending else F.col("v").asc_nulls_last()
    plain = (F.dense_rank() if dense else F.rank()).over(Window.partitionBy(*within).orderBy(order))
    expected = skewed.withColumn("r", plain.cast("bigint"))
    assert rows(global_rank(skewed, [by])) == rows(expected)


def test_row_numbers_break_ties_by_id(skewed):
    plain = F.row_number().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_first(), "id"))
    got = row_numbers(skewed, RankBy("v", "n", within=("g",)), "id")
    assert rows(got) == rows(skewed.withColumn("n", plain.cast("bigint")))


def test_hot_value_is_one_row_of_the_window(skewed):
    """No window of the distributed form sees more rows than a bucket holds."""
    from assetops.operators.ranking import _bucketed_values

    values = _bucketed_values(skewed, "v", ())
    largest = values.groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert largest <= 0.4 * values.count() and values.count() < 4000


def test_any_orderable_type(spark):
    df = spark.createDataFrame([(f"w{i * 7 % 23}", i % 5) for i in range(200)], "s string, g int")
    df = df.withColumn("d", F.date_add(F.lit("2020-01-01").cast("date"), F.col("g")))
    for col in ("s", "d"):
        expected = df.withColumn("r", F.rank().over(Window.orderBy(F.col(col).desc_nulls_first())).cast("bigint"))
        assert rows(global_rank(df, [RankBy(col, "r")])) == rows(expected)


def test_dense_numbers(spark):
    df = spark.range(0, 3000, 7).select((F.col("id") * 13 % 100003).alias("k"))
    expected = df.withColumn("n", (F.row_number().over(Window.orderBy("k")) + 40).cast("bigint"))
    assert rows(dense_numbers(df, "k", "n", 40)) == rows(expected)


def test_append_continues_after_the_highest_key(spark):
    base = spark.createDataFrame([(3,), (9,)], "id bigint")
    new = spark.createDataFrame([(5, "b"), (2, "a")], "request bigint, x string")
    got = {r.x: r.id for r in append_with_keys(base, new, "id", "request").collect()}
    assert got == {"a": 10, "b": 11}
    assert append_with_keys(base.limit(0), new, "id", "request").agg(F.max("id")).first()[0] == 2


def test_empty_frame(spark):
    df = spark.createDataFrame([], "v bigint")
    assert global_rank(df, [RankBy("v", "r")]).collect() == []


SETTING = """
import sys; sys.path.insert(0, {root!r})
from assetops.operators.ranking import RankBy, global_rank
from assetops.storage import shared_folder
from assetops.session import build_session
spark = build_session("local[2]", 2, spark__checkpoint__dir={folder!r})
assert shared_folder(spark) == {folder!r}
assert global_rank(spark.range(5), [RankBy("id", "r")]).count() == 5
"""


def test_shared_folder_is_the_one_the_session_names(tmp_path):
    script = SETTING.format(root=str(ROOT), folder=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert any(p.name.startswith("cut-") for p in tmp_path.iterdir())


def test_no_scratch_folder_on_a_cluster():
    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)  # noqa: N815
        getConf = staticmethod(dict)  # noqa: N815

    class Session:
        sparkContext = Context  # noqa: N815
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def test_ranks_of_several_columns_in_one_pass(spark, skewed):
    """Columns of different types, with and without groups, ties, NULLs and a hot value."""
    df = skewed.withColumns({"s": F.when(F.col("id") % 11 > 0, F.format_string("w%05d", F.col("id") % 700)), "n": F.col("id") % 97})
    ranks = [
        RankBy("v", "a"),
        RankBy("v", "b", descending=False, dense=True),
        RankBy("v", "c", within=("g",)),
        RankBy("s", "d", dense=True, within=("g", "n")),
        RankBy("n", "e", descending=False),
        RankBy("s", "f", descending=False, within=("n",)),
    ]
    expected = df
    for by in ranks:
        plain = F.dense_rank() if by.dense else F.rank()
        expected = expected.withColumn(by.out, plain.over(Window.partitionBy(*by.within).orderBy(by.order())).cast("bigint"))
    got = global_rank(df, ranks)
    assert got.columns == expected.columns and rows(got) == rows(expected)


def test_one_pass_writes_twice(skewed, monkeypatch):
    """The frame is cut, its values and their positions are written, whatever the number of columns."""
    from assetops.operators import ranking

    written = []
    monkeypatch.setattr(ranking, "cut", lambda df: written.append(df.columns) or df)
    ranking.global_rank(skewed, [RankBy("v", "a"), RankBy("g", "b"), RankBy("id", "c", within=("g",))])
    assert len(written) == 3
