"""Readers, collections, models and streams on small files."""

import json

import pytest
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from larder import schemas
from larder.operators import categorise, embed, filters, regression
from larder.sources import files, tables
from larder.streaming import ingest, monitor


@pytest.fixture
def lines(tmp_path):
    folder = tmp_path / "foods"
    folder.mkdir()
    (folder / "one_processed.json").write_text(
        '{"_id"="a", "fid"= 1, "fdc_id": 1, "description": "Kale \\q", "food_nutrients": {"Protein": {"amount": 13, "unit_name": "g"}}}\n'
        "\n"
        '{"_id": "b", "fid": 2, "fdc_id": 2, "description": "none"}\n'
        '{"_id": "c", "fid": 3,\n'
    )
    (folder / "two.json").write_text(
        '{"_id": "d", "fid": 4, "fdc_id": 4, "description": "x", "food_nutrients": {"Sodium, Na": {"amount": 24, "unit_name": "mg"}}}\n'
    )
    return folder


def test_listing(spark, lines):
    found = {r["file_name"]: r["folder"] for r in files.list_files(spark, str(lines.parent)).collect()}
    assert found == {"one_processed.json": "foods", "two.json": "foods"}


def test_prefer_processed(spark):
    names = spark.createDataFrame([("a_processed.json",), ("a_davinci.json",), ("b_processed.json",), ("c.txt",)], "file_name string")
    got = {r["input"]: r["chosen"] for r in files.prefer_processed(names).collect()}
    assert got == {"a_processed.json": "a_davinci.json", "b_processed.json": "b_processed.json"}


def test_food_reader(spark, lines):
    docs, bad = files.read_documents(spark, str(lines), "nutrients")
    got = {r["id"]: r for r in docs.collect()}
    assert set(got) == {"a", "b", "d"} and got["a"]["nutrients"]["protein"]["amount"] == 13.0
    assert got["a"]["description"] == "Kale \\q" and got["b"]["nutrients"] == {}
    assert [r["line"] for r in bad.collect()] == ['{"_id": "c", "fid": 3,']


def test_repair_only_damaged_lines(spark):
    df = spark.createDataFrame([('{"a": "u=v"}',), ('{"a"= "u=v"}',), ("nothing",)], "value string")
    for only, want in ((False, ["u:v", "u:v"]), (True, ["u:v", "u=v"])):
        docs, bad = files.parse_lines(df, "a string", only_damaged=only)
        assert sorted(r["a"] for r in docs.collect()) == want and [r["line"] for r in bad.collect()] == ["nothing"]


def test_append_new_with_null_and_repeated_keys(spark, tmp_path):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 5), (1, 3), (2, 9)], "k bigint, v bigint")
    path = str(tmp_path / "keyed")
    assert tables.append_new(df, path, "k", "v") == 2 and tables.append_new(df, path, "k", "v") == 0
    assert sorted(map(tuple, tables.scan(spark, path).collect())) == [(1, 3), (2, 9)]
    assert [json.loads(r["line"]) for r in tables.keyless(df, "k").orderBy("line").collect()] == [{"v": 1}, {"v": 2}]


def test_recipe_reader(spark, tmp_path):
    recipe = {
        "_id": "r", "name": "Soup", "description": "Leek soup", "ingredients": {"2 leeks": {"cup": "2.0"}}, "tips": {},
        "nutrients": {"total_fat": {"gram": "2.0"}}, "directions": {"1": "Boil", "2": "Eat"},
    }
    (tmp_path / "r.json").write_text(json.dumps(recipe) + "\n" + json.dumps({"_id": "e"}) + "\n")
    docs, _ = files.read_documents(spark, str(tmp_path))
    got = {r["id"]: r for r in docs.collect()}
    assert got["r"]["ingredients"] == "2 leeks: cup: 2.0/n" and got["r"]["directions"] == "1: Boil/n2: Eat/n"
    assert got["r"]["tips"] == "" and got["e"]["ingredients"] == "" and got["e"]["nutrients"] == {}
    audit = filters.missing_audit(spark.createDataFrame([({},), ({"a": "b"},), (None,)], "m map<string,string>"), ["m"], [])
    assert audit.first()["no_m"] == 2


def test_collection(spark, tmp_path):
    path = str(tmp_path / "docs")
    assert tables.scan(spark, path) is None
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "fdc_id bigint, description string")
    assert tables.append_new(docs, path, "fdc_id") == 2 and tables.append_new(docs, path, "fdc_id") == 0
    assert tables.append(docs, path) == 2 and tables.scan(spark, path).count() == 4
    tables.empty_collection(spark, path, "fdc_id bigint, description string")
    assert tables.scan(spark, path).count() == 0
    raw = docs.withColumn("food_nutrients", F.lit(1))
    assert "food_nutrients" in tables.export(raw, str(tmp_path / "e1")).columns
    assert "food_nutrients" not in tables.export(raw.withColumn("nutrients", F.lit(1)), str(tmp_path / "e2")).columns


def test_metrics_and_models(spark, tmp_path):
    log, registry, path = (str(tmp_path / n) for n in ("metrics", "registry", "linear"))
    tables.log_metrics(spark, log, "run-1", {"mse": 0.5, "r2": None})
    assert [(r["name"], r["value"]) for r in tables.scan(spark, log).collect()] == [("mse", 0.5)]
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, score double")
    tables.save_model(spark, regression.fit_linear(df, ["x"]), path, registry, "run-1", "linear")
    row = tables.scan(spark, registry).first()
    assert (row["name"], row["type"], row["path"]) == ("linear", "model", path)
    model = tables.load_model(LinearRegressionModel, row["path"])
    assert model.coefficients[0] == pytest.approx(2.0)
    scored = regression.predict(model, df.withColumn("fid", F.lit(1).cast("bigint")), features=["x"])
    assert tables.log_predictions(scored, str(tmp_path / "log"), "linear") == 20


def test_encoder(spark):
    df = spark.createDataFrame([(1, "red leaf"), (2, "Leaf RED"), (3, ""), (4, None)], "id bigint, text string")
    got = {r["id"]: r["embedding"] for r in embed.embed(df, "id", "text").collect()}
    assert got[1] == got[2] and len(got[1]) == 64 and sum(got[3]) == sum(got[4]) == 0
    assert sum(x * x for x in got[1]) == pytest.approx(1.0, abs=1e-5)
    lexicon = categorise.default_lexicon(spark)
    assert lexicon.select("category").distinct().count() == 17


def test_ingest_stream_equals_one_batch(spark, tmp_path):
    def line(i):
        return json.dumps({"_id": f"d{i}", "fid": i, "fdc_id": i, "description": "kale", "food_nutrients": {"Protein": {"amount": i, "unit_name": "g"}}})

    source, state, out = tmp_path / "in", tmp_path / "state", str(tmp_path / "out")
    source.mkdir()
    (source / "a.json").write_text("\n".join(line(i) for i in range(5)))
    ingest.ingest_stream(spark, str(source), out, str(state)).awaitTermination()
    (source / "b.json").write_text("\n".join([line(i) for i in range(3, 9)] + [line(8)]))
    ingest.ingest_stream(spark, str(source), out, str(state)).awaitTermination()
    got = sorted((r["fid"], round(r["score"], 6)) for r in tables.scan(spark, out).collect())
    batch = ingest.scored_documents(spark.createDataFrame([(line(i),) for i in range(9)], "value string"))
    assert got == sorted((r["fid"], round(r["score"], 6)) for r in batch.collect())
    facts = spark.createDataFrame([(1, {"protein": (65.0, "g")})], f"fdc_id bigint, label {schemas.BAG}")
    scored = ingest.scored_documents(spark.createDataFrame([(line(1),)], "value string"), facts)
    assert scored.first()["score"] == pytest.approx(0.4)


def test_windows_drop_late_rows(spark, tmp_path):
    source = str(tmp_path / "log")
    first = [("2024-01-01 10:00:00", "m", 1, 1.0, 2.0), ("2024-01-03 10:00:00", "m", 2, 1.0, 4.0)]
    late = [("2024-01-01 11:00:00", "m", 3, 1.0, 9.0), ("2024-01-05 11:00:00", "m", 4, 1.0, 1.0)]
    schema = "t string, model string, fid bigint, target double, prediction double"
    for rows in (first, late):
        df = spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("t")).drop("t")
        df.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        monitor.run_windowed(stream, str(tmp_path / "sink"), str(tmp_path / "state")).awaitTermination()
    got = sorted((r["n"], r["mae"]) for r in tables.scan(spark, str(tmp_path / "sink")).collect())
    assert got == [(1, 1.0), (1, 3.0)]


def test_filters(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "", "c")], "fid bigint, category string, other string")
    assert [r["fid"] for r in filters.without_category(df).collect()] == [2]
    assert filters.any_exists(df, ["other"]).count() == 1 and filters.drop_if_present(df, ["nope"]).columns == df.columns
    docs = spark.createDataFrame(
        [
            (1, {"fat": (1.0, "g")}, {"fat": (2.0, "g"), "iron": (None, "mg")}), (2, {"fat": (1.0, "g")}, {}),
            (3, {}, None), (4, None, None),
        ],
        f"fid bigint, nutrients {schemas.BAG}, labelNutrients {schemas.BAG}",
    )
    got = {r["fid"]: (r["fat"], r["iron"], r["sugars"]) for r in filters.feature_rows(docs).collect()}
    assert got == {1: (2.0, 0.0, 0.0), 2: (1.0, 0.0, 0.0)}
    assert filters.feature_rows(docs).columns == ["fid", *schemas.FEATURES]
    assert filters.before_ingest(docs).where("fid = 4").first()["nutrients"] == {}
