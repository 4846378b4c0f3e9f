import pytest
from pyspark.sql import functions as F

from docframe.operators.frame import DocFrame
from docframe.sources.schema import DocSchema, FieldInfo, field_names, split_meta
from docframe.sources.store import Store
from docframe.streaming import follow, open_stream


def test_store_changes(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), "id")
    with pytest.raises(FileNotFoundError):
        store.read()
    store.update(spark.createDataFrame([("2", True, 2.0), ("3", True, 4.0), ("4", False, 3.0)], "id string, inStock boolean, price double"))
    store.update([{"id": "1112211111", "name": "my name!"}])
    row = store.frame().doc("1112211111")
    assert row == {"id": "1112211111", "name": "my name!"}
    store.update([{"id": "3", "price": 9.0}], atomic=True)
    assert store.frame().doc("3") == {"id": "3", "inStock": True, "price": 9.0}
    store.update([{"id": "3", "price": 1.0}])
    assert store.frame().doc("3") == {"id": "3", "price": 1.0}
    store.update_batch({"2": None, "9": {"price": 7.0}})
    assert store.frame().doc("2") is None and store.frame().doc("9")["price"] == 7.0
    store.delete(F.col("price") > 5)
    assert sorted(r.id for r in store.read().collect()) == ["1112211111", "3", "4"]
    store.set_columns(F.col("id") == "4", price=None)
    assert "price" not in store.frame().doc("4")
    store.delete(["4"])
    store.replace_query(store.frame().subset("id = '3'"), spark.createDataFrame([("8", 8.0)], "id string, price double"))
    assert sorted(r.id for r in store.read().collect()) == ["1112211111", "8"]
    n = len(store.versions())
    store.purge()
    assert n > 5 and len(store.versions()) == 1
    store.delete()
    assert store.read().count() == 0


def test_schema(spark):
    df = spark.createDataFrame([("a", 1, None, ["x"]), ("b", 2, 1.5, None)], "id string, n int, d double, m array<string>")
    schema = DocSchema.derive(df, "t", "id", version_field=True)
    assert [(f.name, f.type, f.multi_valued, f.required) for f in schema.fields[:4]] == [("id", "string", False, True), ("n", "int", False, True), ("d", "double", False, False), ("m", "string", True, False)]
    assert schema["_version_"].hidden and DocSchema.from_json(schema.to_json()) == schema
    dyn = DocSchema("d", (FieldInfo("id", "string"), FieldInfo("a_*", "int"), FieldInfo("*_i", "bigint")), copy_fields=(("id", "key_i"),))
    assert dyn["a_i"].type == "int" and "zzz" not in dyn and dyn.static_names() == ["id"] and not dyn.struct()["id"].nullable is False
    with pytest.raises(KeyError):
        dyn.conform(df)
    assert field_names(df.withColumn("void_", F.lit(None).cast("int")), present_only=True) == ["id", "n", "d", "m"]
    seen, hidden = split_meta(df.withColumn("_v_", F.lit(1)))
    assert hidden.columns == ["_v_"] and "_v_" not in seen.columns


def test_stream(spark, sf, tmp_path):
    table = spark.read.parquet(f"{sf}/supplier.parquet")
    table.repartition(3).write.parquet(str(tmp_path / "in"))
    f = open_stream(spark, str(tmp_path / "in"), table.schema, "s_suppkey")
    q = follow(f, lambda x: x.subset("s_acctbal > 0").transform(twice="s_acctbal * 2").subset(fields=["s_suppkey", "twice"]), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == table.where("s_acctbal > 0").count()
    with pytest.raises(ValueError, match="end"):
        follow(f, lambda x: x.head(3), str(tmp_path / "o2"), str(tmp_path / "c2"))


def test_open_and_pandas(spark, sf):
    f = DocFrame.open(spark, f"{sf}/supplier.parquet", "s_suppkey", normalize_nan=True)
    assert f.to_pandas().shape == f.dim() and f.ids().columns == ["s_suppkey"]
    assert f.head(2).docs()[0].keys() == set(f.names())
    plan = DocFrame.open(spark, f"{sf}/supplier.parquet").subset("s_acctbal > 0", fields=["s_name"]).result()._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(s_acctbal), GreaterThan(s_acctbal,0.0)" in plan and "ReadSchema: struct<s_name:string,s_acctbal:double>" in plan
