from pyspark.sql import functions as F

from zonekit.operators.model import (build_pipeline, hash_split, load_model, regression_metrics,
                                     save_model, score, train)
from zonekit.plans.features import feature_table
from zonekit.plans.kpi import kpi_table


def _docs(spark):
    rent = spark.createDataFrame(
        [("A", 1000.0, 41.0, 2.0, 10.0), ("A", 2000.0, 41.2, 2.2, 20.0), ("B", 500.0, 40.0, 1.0, 5.0),
         (None, 1.0, 1.0, 1.0, 1.0)],
        "neighborhood_name string, price double, latitude double, longitude double, priceByArea double")
    income = spark.createDataFrame([("A", [(2017, 10, 100.0), (2018, 12, 200.0)]), ("C", [(2017, 1, 5.0)])],
                                   "neighborhood_name string, info array<struct<year:int,pop:int,RFD:double>>")
    density = spark.createDataFrame(
        [("B", [(2017, 5.0, 50.0, 40.0)]), ("A", None)],
        "neighborhood_name string, info array<struct<year:int,population:double,"
        "`density(inh/ha)`:double,`net_density (inh/ha)`:double>>")
    return rent, income, density


def test_kpi_table_left_joins_and_flags(spark):
    rent, income, density = _docs(spark)
    got = {r.neighborhood_name: r for r in kpi_table(rent, income, density).collect()}
    assert set(got) == {"A", "B"}
    assert got["A"].avg_rent == 1500.0 and got["A"].avg_income == 150.0 and got["A"].avg_density is None
    assert got["A"].avg_density_imputed and not got["A"].avg_income_imputed
    assert got["B"].avg_income is None and got["B"].avg_density == 50.0


def test_kpi_table_invariant_under_row_order(spark):
    rent, income, density = _docs(spark)
    a = sorted(map(tuple, kpi_table(rent, income, density).collect()))
    b = sorted(map(tuple, kpi_table(rent.orderBy(F.desc("price")).repartition(3), income, density).collect()))
    assert a == b


def test_kpi_table_imputes_with_mean(spark):
    rent, income, density = _docs(spark)
    got = {r.neighborhood_name: r for r in kpi_table(rent, income, density, impute_strategy="mean").collect()}
    assert got["B"].avg_income == 150.0 and got["B"].avg_income_imputed


def _listings(spark, n=400):
    df = spark.range(n).select(
        F.col("id").cast("string").alias("_id"), (F.col("id") % 7 + 30.0).alias("size"),
        (F.col("id") % 4).cast("int").alias("rooms"), (F.col("id") % 2).cast("int").alias("bathrooms"),
        (41.0 + F.col("id") / 1000).alias("latitude"), (2.0 + F.col("id") / 1000).alias("longitude"),
        (F.col("id") % 2 == 0).alias("exterior"), (F.col("id") % 5).cast("int").alias("floor"),
        (F.col("id") % 3 == 0).alias("has360"), F.lit(False).alias("has3DTour"),
        (F.col("id") % 4 == 0).alias("hasLift"), F.lit(True).alias("hasPlan"),
        F.lit(False).alias("hasStaging"), (F.col("id") % 6 == 0).alias("hasVideo"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("neighborhood_name"),
        (F.col("id") % 9).cast("int").alias("numPhotos"),
        (F.col("id") % 7 * 100.0 + 500).alias("price"))
    return df


def test_feature_table_inner_joins_and_model_roundtrip(spark, tmp_dir):
    _, _, _ = _docs(spark)
    income = spark.createDataFrame([(1, "A", [(2017, 10, 100.0)]), (2, "B", [(2017, 10, 50.0)])],
                                   "_id int, neighborhood_name string, info array<struct<year:int,pop:int,RFD:double>>")
    density = spark.createDataFrame(
        [("A", [(2017, 5.0, 50.0, 40.0)]), ("B", [(2017, 5.0, 10.0, 9.0)])],
        "neighborhood_name string, info array<struct<year:int,population:double,"
        "`density(inh/ha)`:double,`net_density (inh/ha)`:double>>")
    ft = feature_table(_listings(spark), income, density)
    assert ft.count() == 400
    assert {"income_id", "income_year", "RFD", "density_neighborhood_name", "density"} <= set(ft.columns)
    assert "LeftOuter" not in ft._jdf.queryExecution().executedPlan().toString()

    from zonekit.operators.model import prepare_features
    df = prepare_features(ft)
    tr, te = hash_split(df, ["_id"])
    assert tr.count() + te.count() == 400 and te.count() > 0
    model = train(tr, build_pipeline(maxIter=3))
    assert model.stages[1].getInputCols().__len__() == 15
    m1 = regression_metrics(score(model, te)).first()
    m2 = regression_metrics(score(train(tr, build_pipeline(maxIter=3)), te)).first()
    assert m1 == m2 and m1.n == te.count()
    path = f"{tmp_dir}/model"
    save_model(model, path)
    p1 = sorted(r.prediction for r in score(model, te).collect())
    p2 = sorted(r.prediction for r in score(load_model(path), te).collect())
    assert p1 == p2


def test_regression_metrics_formulas(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0)], "price double, prediction double")
    m = regression_metrics(df).first()
    assert abs(m.mse - 5.0 / 3) < 1e-12 and abs(m.mae - 1.0) < 1e-12
    assert abs(m.rmse - (5.0 / 3) ** 0.5) < 1e-12 and abs(m.r2 - (1 - (5.0 / 3) / (2.0 / 3))) < 1e-12


def test_feature_table_never_multiplies_listings(spark):
    # two income documents reconcile to the same neighbourhood "A"
    income = spark.createDataFrame([(1, "A", [(2017, 10, 100.0)]), (2, "A", [(2018, 10, 300.0)]),
                                    (3, "B", [(2017, 10, 50.0)])],
                                   "_id int, neighborhood_name string, info array<struct<year:int,pop:int,RFD:double>>")
    density = spark.createDataFrame(
        [("A", [(2017, 5.0, 50.0, 40.0)]), ("B", [(2017, 5.0, 10.0, 9.0)])],
        "neighborhood_name string, info array<struct<year:int,population:double,"
        "`density(inh/ha)`:double,`net_density (inh/ha)`:double>>")
    ft = feature_table(_listings(spark), income, density)
    assert ft.count() == 400
    a = ft.where("neighborhood_name = 'A'").first()
    assert a.income_id == 1 and a.income_year == [2017, 2018] and a.RFD == [100.0, 300.0]


def test_predict_prices_for_new_listings(spark, tmp_dir):
    from zonekit.operators.model import load_model, prepare_features
    from zonekit.plans.features import predict_prices

    income = spark.createDataFrame([(1, "A", [(2017, 10, 100.0)]), (2, "B", [(2017, 10, 50.0)])],
                                   "_id int, neighborhood_name string, info array<struct<year:int,pop:int,RFD:double>>")
    density = spark.createDataFrame(
        [("A", [(2017, 5.0, 50.0, 40.0)]), ("B", [(2017, 5.0, 10.0, 9.0)])],
        "neighborhood_name string, info array<struct<year:int,population:double,"
        "`density(inh/ha)`:double,`net_density (inh/ha)`:double>>")
    model = train(prepare_features(feature_table(_listings(spark), income, density)), build_pipeline(maxIter=3))
    save_model(model, f"{tmp_dir}/m")
    new = _listings(spark, 20).drop("price")
    got = predict_prices(load_model(f"{tmp_dir}/m"), new, income, density)
    assert got.count() == 20 and got.where("prediction IS NULL").count() == 0
    # listings that cannot be priced come back with the reason
    odd = new.withColumn("neighborhood_name", F.when(F.col("_id") == "1", "nowhere").when(F.col("_id") != "2", F.col("neighborhood_name")))
    odd = odd.withColumn("hasLift", F.when(F.col("_id") != "3", F.col("hasLift"))).withColumn("size", F.when(F.col("_id") != "4", F.col("size")))
    got = {r._id: (r.not_priced, r.prediction is None) for r in predict_prices(load_model(f"{tmp_dir}/m"), odd, income, density).collect()}
    assert len(got) == 20
    assert {i: w for i, (w, _) in got.items() if w} == {"1": "no documents", "2": "no documents", "3": "incomplete", "4": "incomplete"}
    assert all(none == (why is not None) for why, none in got.values())
