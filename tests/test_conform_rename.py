import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonekit.operators.conform import bad_values, conform
from zonekit.operators.rename import rename_columns, rename_nested, trim_column_names
from zonekit.schemas import income_schema, listing_schema


def test_conform_matches_struct_fields_by_name(spark):
    # source struct order {RFD, pop, year}; declared {year, pop, RFD}
    df = spark.createDataFrame([(1, [("1.5", "10", "2017")])],
                               "_id int, info array<struct<RFD:string,pop:string,year:string>>")
    out = conform(df, income_schema())
    r = out.first()
    assert r.info[0].year == 2017 and r.info[0].pop == 10 and r.info[0].RFD == 1.5
    assert out.schema == income_schema() or [f.name for f in out.schema.fields] == income_schema().fieldNames()


def test_conform_missing_extra_and_bad_values(spark):
    df = spark.createDataFrame([("3x", "a", "extra"), ("4", "b", "extra")],
                               "floor string, address string, junk string")
    schema = T.StructType([T.StructField("floor", T.IntegerType()), T.StructField("rooms", T.IntegerType()),
                           T.StructField("address", T.StringType())])
    out = conform(df, schema)
    assert out.columns == ["floor", "rooms", "address"]
    assert {r.address: (r.floor, r.rooms) for r in out.collect()} == {"a": (None, None), "b": (4, None)}
    assert bad_values(df, schema, "floor").count() == 1
    assert "junk" in conform(df, schema, keep_extra=True).columns


def test_conform_nested_listing_schema(spark):
    df = spark.createDataFrame([("b1", [("100.5", ("12.5", "true"))])],
                               "_id string, value array<struct<price:string,"
                               "parkingSpace:struct<parkingSpacePrice:string,hasParkingSpace:string>>>")
    schema = T.StructType([T.StructField("_id", T.StringType()),
                           T.StructField("value", T.ArrayType(listing_schema()))])
    item = conform(df, schema).first().value[0]
    assert item.price == 100.5 and item.parkingSpace.hasParkingSpace is True
    assert item.parkingSpace.parkingSpacePrice == 12.5 and item.address is None


def test_conform_null_and_empty_arrays(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "_id int, info array<struct<year:string>>")
    out = {r._id: r.info for r in conform(df, income_schema()).collect()}
    assert out[1] is None and out[2] == []


def test_rename_reports_missing_and_handles_trailing_space(spark):
    df = spark.createDataFrame([(1, "x")], "_id int, `neigh_name ` string")
    out, missing = rename_columns(df, {"neigh_name": "neighborhood_name", "nope": "x"})
    assert out.columns == ["_id", "neighborhood_name"] and missing == ["nope"]
    assert trim_column_names(df).columns == ["_id", "neigh_name"]


def test_rename_nested_in_array_of_structs(spark):
    df = spark.createDataFrame([("a", [(2017, 1.0, 2.0)])],
                               "n string, info array<struct<year:int,`density(inh/ha)`:double,"
                               "`net_density (inh/ha)`:double>>")
    out, missing = rename_columns(df, {"info.density(inh/ha)": "density",
                                       "info.net_density (inh/ha)": "net_density"})
    assert not missing
    e = out.select(F.explode("info").alias("e")).select("e.*")
    assert e.columns == ["year", "density", "net_density"]
    with pytest.raises(ValueError):
        rename_nested(df, "info", {"absent": "x"})


def test_conform_through_maps(spark):
    df = spark.createDataFrame([({"a": "1", "b": "x"},)], "m map<string,string>")
    schema = T.StructType([T.StructField("m", T.MapType(T.StringType(), T.IntegerType()))])
    assert conform(df, schema).first().m == {"a": 1, "b": None}


def test_rename_nested_in_plain_struct(spark):
    df = spark.createDataFrame([(1, ("t", "s"))], "k int, suggestedTexts struct<title:string,subtitle:string>")
    out = rename_nested(df, "suggestedTexts", {"title": "headline"})
    assert out.schema["suggestedTexts"].dataType.fieldNames() == ["headline", "subtitle"]
    assert out.first().suggestedTexts.headline == "t"


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_DECLARED = [("year", "int"), ("pop", "int"), ("RFD", "double"), ("label", "string"), ("ok", "boolean")]


@settings(max_examples=15, deadline=None)
@given(st.permutations(_DECLARED), st.integers(0, 4), st.integers(1, 5))
def test_conform_by_name_for_any_field_order(spark, order, drop_at, n_rows):
    present = [f for i, f in enumerate(order) if i != drop_at]          # one field missing
    ddl = ", ".join(f"`{n}`: string" for n, _ in present)
    values = {"year": lambda i: str(2000 + i), "pop": lambda i: str(10 * i), "RFD": lambda i: f"{i}.5",
              "label": lambda i: f"n{i}", "ok": lambda i: "true" if i % 2 else "false"}
    rows_ = [(i, [tuple(values[n](i) for n, _ in present)]) for i in range(n_rows)]
    df = spark.createDataFrame(rows_, f"k int, info array<struct<{ddl}>>")
    target = T.StructType([T.StructField("k", T.IntegerType()),
                           T.StructField("info", T.ArrayType(T.StructType(
                               [T.StructField(n, T.DataType.fromDDL(t)) for n, t in _DECLARED])))])
    got = {r.k: r.info[0].asDict() for r in conform(df, target).collect()}
    names = {n for n, _ in present}
    for i in range(n_rows):
        want = {"year": 2000 + i, "pop": 10 * i, "RFD": i + 0.5, "label": f"n{i}", "ok": bool(i % 2)}
        assert got[i] == {n: (v if n in names else None) for n, v in want.items()}


def test_rename_refuses_to_create_duplicate_names(spark):
    df = spark.createDataFrame([(1, "a", "b")], "_id int, neighborhood string, neighborhood_name string")
    with pytest.raises(ValueError):
        rename_columns(df, {"neighborhood": "neighborhood_name"})
    # swapping two names is fine
    out, _ = rename_columns(df, {"neighborhood": "neighborhood_name", "neighborhood_name": "neighborhood"})
    assert out.first().neighborhood == "b"
