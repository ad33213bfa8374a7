import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wardspark.operators import mutate
from wardspark.sources.keyed import KeyedTable


def files_of(spark, path):
    return {r[0]: r[1] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
            .load(path).select("path", "modificationTime").collect()}


def people(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("P"), "id").alias("k"), F.col("id").alias("v"), F.lit("old").alias("note"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upsert_rewrites_only_what_it_touches(spark, tmp_path):
    path, base = str(tmp_path / "t"), people(spark, 0, 2000)
    table = KeyedTable.create(base, path, "k", buckets=4, parts=16)
    before = files_of(spark, path)
    assert len(before) <= 16 * 4
    batch = spark.createDataFrame([("P7", 70, "new"), ("P99999", 1, "new")], "k string, v long, note string")
    parts = table.upsert(batch, ["v"])
    assert 1 <= len(parts) <= 2
    after = files_of(spark, path)
    untouched = {p: t for p, t in before.items() if not any(f"key_part={n}/" in p for n in parts)}
    assert untouched and all(after[p] == t for p, t in untouched.items())
    assert not set(before) - set(untouched) & set(after)
    expected = rows(mutate.upsert(base, batch, "k", ["v"]))
    assert rows(table.read()) == expected and ("P7", 70, "old") in expected
    table.upsert(batch, ["v"])  # repeated, it changes nothing
    assert rows(table.read()) == expected
    again = KeyedTable.open(spark, path, "k", buckets=4, parts=16)
    assert rows(again.read()) == expected
    table.drop_name()
    assert rows(again.read()) == expected


def test_stored_side_is_not_shuffled(spark, tmp_path):
    table = KeyedTable.create(people(spark, 0, 3000), str(tmp_path / "t"), "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changes = people(spark, 100, 200)
        merged = plan_of(mutate.upsert(table.read([1, 2]), changes, "k", ["v"]))
        left = plan_of(table.read([1, 2]).join(changes.select("k").distinct(), "k", "left_anti"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in (merged, left):
        stored = plan.split("Join", 1)[1].split("FileScan")[0]
        assert "Bucketed: true" in plan and "key_part" in plan and "Exchange" not in stored


def test_delete_and_empty_partitions(spark, tmp_path):
    path, base = str(tmp_path / "t"), people(spark, 0, 300)
    table = KeyedTable.create(base.unionAll(base), path, "k", parts=8)  # a key may repeat
    one = table.read([3]).select("k").distinct()
    keys = [r.k for r in one.collect()]
    assert keys and table.delete(spark.createDataFrame([(k,) for k in keys], "k string")) == [3]
    assert table.read([3]).count() == 0 and not any("key_part=3/" in p for p in files_of(spark, path))
    assert table.read().count() == 600 - 2 * len(keys)
    assert table.delete(base.select("k").where("false")) == []
    assert table.delete(people(spark, 5000, 5010)) and table.read().count() == 600 - 2 * len(keys)


@pytest.mark.parametrize("key", [None, ""])
def test_null_and_empty_keys(spark, tmp_path, key):
    df = spark.createDataFrame([(key, 1), ("a", 2)], "k string, v long")
    table = KeyedTable.create(df, str(tmp_path / "t"), "k", parts=4)
    assert rows(table.read()) == rows(df)
    table.upsert(spark.createDataFrame([("a", 5)], df.schema), ["v"])
    assert sorted(r.v for r in table.read().collect()) == [1, 5]


def test_files_grow_with_buckets_not_with_buckets_times_partitions(spark, tmp_path):
    path, base = str(tmp_path / "t"), people(spark, 0, 6000)
    table = KeyedTable.create(base, path, "k", buckets=48, parts=32)
    assert len(files_of(spark, path)) == 48
    assert {r[0] for r in spark.table(table.name).select("key_part").distinct().collect()} == set(range(32))
    batch = people(spark, 5000, 7000).withColumn("note", F.lit("new"))
    assert table.upsert(batch, ["note"]) == list(range(32))
    assert len(files_of(spark, path)) == 48
    assert rows(table.read()) == rows(mutate.upsert(base, batch, "k", ["note"]))
    assert table.delete(people(spark, 0, 6990)) and table.read().count() == 10
    few = str(tmp_path / "few")
    table = KeyedTable.create(base, few, "k", buckets=4, parts=16)
    assert len(files_of(spark, few)) == 16 and len(table.touched(base)) == 16


def test_keys_of_another_type_find_their_partition(spark, tmp_path):
    base = spark.range(0, 500).selectExpr("cast(id as bigint) k", "id v")
    table = KeyedTable.create(base, str(tmp_path / "t"), "k")
    keys = spark.range(0, 500).selectExpr("cast(id as int) k")
    assert table.touched(keys) == table.touched(base)
    table.upsert(keys.where("k < 100").selectExpr("k", "cast(-k as bigint) v"), ["v"])
    table.delete(keys.where("k >= 300").selectExpr("cast(k as decimal(12,2)) k"))
    assert rows(table.read()) == sorted(((n, -n if n < 100 else n) for n in range(300)), key=repr)


def test_open_refuses_other_numbers(spark, tmp_path):
    path = str(tmp_path / "t")
    KeyedTable.create(people(spark, 0, 300), path, "k", parts=8)
    with pytest.raises(ValueError, match="not written with"):
        KeyedTable.open(spark, path, "k", buckets=4, parts=16)
    assert KeyedTable.open(spark, path, "k", buckets=4, parts=8).read().count() == 300
