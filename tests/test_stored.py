"""Updates of stored tables: values, files, refusals, failures."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources import stored

SCHEMA = "id bigint, `the value` string, n int, day string, shop string"
ROWS = [(1, "a", 1, "01", "x"), (2, None, 2, "01", "y"), (3, "c", 3, "02", "x"), (4, None, 4, None, "x"),
        (5, "e", None, "02", "y"), (6, "e", 6, "02", "y")]


@pytest.fixture
def path(spark):
    p = scratch_path(spark, "stored")
    stored.write_stored(spark.createDataFrame(ROWS, SCHEMA), p, ["day", "shop"])
    return p


def rows(spark, path):
    return sorted(tuple(r) for r in stored.read_stored(spark, path, SCHEMA).collect())


def files(path):
    out = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out.setdefault(os.path.relpath(folder, path), set()).add(n)
    return out


def update(spark, path, changes, where, **kw):
    return stored.update_stored(spark, path, SCHEMA, ["day", "shop"], changes, where, **kw)


def test_only_touched_folders_get_new_files(spark, path):
    old = files(path)
    got = update(spark, path, {"the value": F.lit("new"), "n": F.col("n") + 10}, F.col("the value").isNull())
    assert got == [(None, "x"), ("01", "y")]
    assert rows(spark, path) == sorted(
        (i, "new", n + 10, d, s) if v is None else (i, v, n, d, s) for i, v, n, d, s in ROWS)
    new = files(path)
    assert set(new) == set(old)
    for folder, names in old.items():
        touched = folder in ("day=01/shop=y", "day=__HIVE_DEFAULT_PARTITION__/shop=x")
        assert (new[folder] & names == set()) if touched else new[folder] == names


def test_other_rows_of_a_touched_folder_stay(spark, path):
    assert update(spark, path, {"the value": F.lit(7)}, F.col("n") > 5) == [("02", "y")]    # null > 5: no
    want = [(i, "7" if i == 6 else v, n, d, s) for i, v, n, d, s in ROWS]
    assert rows(spark, path) == sorted(want)


def test_update_from_the_table_itself(spark, path):
    table = stored.read_stored(spark, path, SCHEMA)
    best = table.groupBy("shop").agg(F.max("the value").alias("best"))
    update(spark, path, {"the value": F.col("best")}, F.col("the value").isNull(), using=best, on=["shop"])
    assert [r[1] for r in rows(spark, path)] == ["a", "e", "c", "c", "e", "e"]


def test_nothing_to_change_and_empty_table(spark, path):
    old = files(path)
    assert update(spark, path, {"n": F.lit(0)}, F.col("n") > 100) == [] and files(path) == old
    empty = scratch_path(spark, "stored")
    stored.write_stored(spark.createDataFrame([], SCHEMA), empty, ["day", "shop"])
    assert update(spark, empty, {"n": F.lit(0)}, F.col("n") > 0) == [] and rows(spark, empty) == []


def test_refusals(spark, path):
    twice = spark.createDataFrame([("x", 1), ("x", 2)], "shop string, m int")
    clash = spark.createDataFrame([("x", 1)], "shop string, n int")
    some = F.col("n") > 0
    for kw in ({"using": twice, "on": ["shop"]}, {"using": clash, "on": ["shop"]}, {"using": clash}):
        with pytest.raises(ValueError):
            update(spark, path, {"n": F.lit(0)}, some, **kw)
    for column in ("day", "unknown"):
        with pytest.raises(ValueError):
            update(spark, path, {column: F.lit("03")}, some)
    assert rows(spark, path) == sorted(ROWS)


def test_a_failed_write_leaves_the_table(spark, path):
    old = files(path)
    wrong = F.when(F.col("id") == 6, F.raise_error(F.lit("broken"))).otherwise(F.col("n"))
    with pytest.raises(Exception, match="broken"):
        update(spark, path, {"n": wrong}, F.col("n").isNotNull())
    assert files(path) == old and rows(spark, path) == sorted(ROWS)


def test_untouched_folders_are_not_read_again(spark, path):
    """The second scan is pruned to the folders found by the first."""
    for folder, names in files(path).items():
        if folder.startswith("day=02"):
            for n in names:
                with open(os.path.join(path, folder, n), "wb") as f:
                    f.write(b"no parquet")
    assert update(spark, path, {"n": F.lit(0)}, F.col("day").isNull()) == [(None, "x")]
