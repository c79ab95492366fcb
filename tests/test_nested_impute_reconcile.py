
from conftest import rows
from pyspark.sql import functions as F
from zonekit.functions.arrays import array_mean
from zonekit.operators.impute import impute
from zonekit.operators.nested import explode_rows, flatten_if_nested, has_array_of_structs
from zonekit.operators.reconcile import alias_table, reconcile


def test_explode_null_and_empty_give_no_row_unless_outer(spark):
    df = spark.createDataFrame([("a", [(1, "x"), (2, "y")]), ("b", None), ("c", [])],
                               "_id string, value array<struct<n:int,_id:string>>")
    assert has_array_of_structs(df, "value") and not has_array_of_structs(df, "_id")
    out = explode_rows(df, "value", keep=["_id"])
    assert out.columns == ["_id", "n", "item__id"]
    assert rows(out, "_id", "n") == [("a", 1), ("a", 2)]
    assert explode_rows(df, "value", keep=["_id"], outer=True).count() == 4
    assert flatten_if_nested(df, "value").count() == 2


def test_array_mean_edge_cases(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, []), (3, None), (4, [1.0, None, 3.0])],
                               "k int, a array<double>")
    got = {r.k: (r.m, r.s) for r in df.select("k", array_mean("a").alias("m"),
                                              array_mean("a", skip_nulls=True).alias("s")).collect()}
    assert got == {1: (1.5, 1.5), 2: (None, None), 3: (None, None), 4: (None, 2.0)}


def test_impute_strategies(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0)], "k string, x double")
    none = {r.k: (r.x, r.x_imputed) for r in impute(df, ["x"]).collect()}
    assert none["b"] == (None, True) and none["a"] == (1.0, False)
    assert {r.k: r.x for r in impute(df, ["x"], "constant", value=7.0).collect()}["b"] == 7.0
    assert {r.k: r.x for r in impute(df, ["x"], "mean").collect()}["b"] == 2.0
    assert {r.k: r.x for r in impute(df, ["x"], "median").collect()}["b"] in (1.0, 3.0)
    keyed = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    r1 = rows(impute(keyed, ["x", "y"], "random", seed=3, key=["k"]).repartition(7), "k", "x", "y")
    r2 = rows(impute(keyed.repartition(5), ["x", "y"], "random", seed=3, key=["k"]), "k", "x", "y")
    assert r1 == r2 and all(0 <= x < 1000 for _, x, _ in r1) and len({x for _, x, _ in r1}) > 490
    assert all(x != y for _, x, y in r1)
    assert r1 != rows(impute(keyed, ["x", "y"], "random", seed=4, key=["k"]), "k", "x", "y")
    assert 0 <= impute(df, ["x"], "random", seed=3).where("k = 'b'").first().x <= 1000


def _lookups(spark):
    income = spark.createDataFrame(
        [("Q1", "Vall-Llençol", "vall llencol", "Vall-Llençol"),
         ("Q2", "el Port Nòu", "el nou", "New Harbour")],
        "_id string, neighborhood string, neighborhood_name string, neighborhood_reconciled string")
    rent = spark.createDataFrame([("Q2", "Port Nou", "port nou", "New Harbour")],
                                 "_id string, ne string, ne_n string, ne_re string")
    return income, rent


def test_alias_table_flags_ambiguous_aliases(spark):
    a = spark.createDataFrame([("Q1", "Gracia"), ("Q2", "Gràcia")], "_id string, neighborhood string")
    al = alias_table([(a, ["neighborhood"])])
    r = al.first()
    assert r.alias == "gracia" and r.ambiguous is True


def test_reconcile_canon_keeps_rows_and_matches_spellings(spark):
    income, rent = _lookups(spark)
    names = ["neighborhood", "neighborhood_name", "neighborhood_reconciled", "ne", "ne_n", "ne_re"]
    al = alias_table([(income, names), (rent, names)], display=income,
                     display_col="neighborhood_reconciled")
    src = spark.createDataFrame([(1, "VALL - LLENÇOL"), (2, "Port  Nòu"), (3, "Nowhere"), (4, None)],
                                "id int, neighborhood_name string")
    out = reconcile(src, "neighborhood_name", al, "neigh_name_reconciled", "neighborhood_id")
    assert out.count() == 4
    got = {r.id: (r.neighborhood_id, r.neigh_name_reconciled) for r in out.collect()}
    assert got == {1: ("Q1", "Vall-Llençol"), 2: ("Q2", "New Harbour"), 3: (None, None), 4: (None, None)}


def test_reconcile_basic_mode_is_the_reference_behaviour(spark):
    al = spark.createDataFrame([("vall llencol", "Q1", "Vall-Llençol"), ("twice", "Q1", "One"), ("Twice", "Q2", "Other")], "alias string, id string, reconciled string")
    src = spark.createDataFrame([(1, "Vall Llencol"), (2, "Vall-Llençol"), (3, "twice")], "id int, neighborhood_name string")
    out = reconcile(src, "neighborhood_name", al, "rec", mode="basic")
    got = {r.id: r.rec for r in out.collect()}
    assert got == {1: "Vall-Llençol", 2: None, 3: None}  # a name of two ids is skipped


def test_names_of_any_script_and_repeated_display_rows(spark):
    a = spark.createDataFrame([("Q1", "Київ"), ("Q1", "Київ"), ("Q2", "東京 都"), ("Q3", "Αθήνα")], "_id string, neighborhood string")
    al = alias_table([(a, ["neighborhood"])], display=a, display_col="neighborhood")
    src = spark.createDataFrame([(1, "КИЇВ"), (2, "東京-都"), (3, "αθήνα"), (4, "?!")], "id int, n string")
    out = reconcile(src, "n", al, "rec", "rid")
    assert {r.id: r.rid for r in out.collect()} == {1: "Q1", 2: "Q2", 3: "Q3", 4: None} and out.count() == 4


def test_reconcile_without_display_names_uses_ids(spark):
    a = spark.createDataFrame([("Q1", "Poble Sec"), ("Q1", "el Poble-sec")], "_id string, neighborhood string")
    al = alias_table([(a, ["neighborhood"])])
    src = spark.createDataFrame([(1, "POBLE\u00a0SEC")], "id int, n string")
    r = reconcile(src, "n", al, "rec", "rid").first()
    assert r.rid == "Q1" and r.rec == "Q1"


def test_explode_with_positions(spark):
    df = spark.createDataFrame([("a", [(1,), (2,)]), ("b", None)], "_id string, value array<struct<n:int>>")
    out = explode_rows(df, "value", keep=["_id"], position="pos")
    assert rows(out, "_id", "pos", "n") == [("a", 0, 1), ("a", 1, 2)]
    outer = explode_rows(df, "value", keep=["_id"], position="pos", outer=True)
    assert rows(outer, "_id", "pos", "n") == [("a", 0, 1), ("a", 1, 2), ("b", None, None)]
