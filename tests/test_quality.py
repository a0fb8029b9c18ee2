import pytest

from vellumark.operators import quality


@pytest.fixture(scope="module")
def flawed(spark):
    rows = [(1, "a", 1.5, None), (2, " ", -0.0, 5), (2, None, 0.0, 5), (3, "a", None, 7), (3, "", 2.5, 7)]
    return spark.createDataFrame(rows, "content_id bigint, name string, score double, size smallint")


@pytest.mark.parametrize("approximate", [False, True])
def test_columns(flawed, approximate):
    rows = {r["column"]: r for r in quality.column_stats(flawed, approximate).collect()}
    assert [rows[c]["null_count"] for c in flawed.columns] == [0, 3, 1, 1]
    assert [rows[c]["null_pct"] for c in flawed.columns] == [0.0, 60.0, 20.0, 20.0]
    # Null is one value of its own; 0.0 and -0.0 are the same.
    assert [rows[c]["distinct_count"] for c in flawed.columns] == [3, 4, 4, 3]
    assert (rows["content_id"]["min"], rows["content_id"]["max"], rows["content_id"]["mean"]) == (1, 3, 2.2)
    assert rows["score"]["mean"] == 1.0
    # Only int, bigint, float and double columns are profiled as numbers.
    assert rows["size"]["mean"] is None and rows["name"]["min"] is None


def test_duplicates(flawed):
    row = quality.key_duplicates(flawed, ["content_id"]).first()
    assert tuple(row) == (["content_id"], 5, 3, 2, 40.0)


def test_report(flawed):
    row = quality.quality_report(flawed).first()
    assert (row["total_rows"], row["column_count"]) == (5, 4)
    assert [c["column"] for c in row["columns"]] == flawed.columns
    assert row["duplicates"]["key_columns"] == ["content_id"]
    assert row["quality_score"] == round(1 - (25 / 100 * 0.5 + 40 / 100 * 0.5), 4)


def test_key_falls_back_on_first_column(flawed):
    row = quality.quality_report(flawed.select("name", "size")).first()
    assert row["duplicates"]["key_columns"] == ["name"]


def test_empty_table(flawed):
    row = quality.quality_report(flawed.filter("false")).first()
    assert (row["total_rows"], row["quality_score"]) == (0, 1.0)
    assert {(c["null_count"], c["null_pct"], c["distinct_count"], c["min"]) for c in row["columns"]} == {(0, 0.0, 0, None)}


@pytest.mark.parametrize("score, band", [(0.9, "good"), (0.89, "fair"), (0.7, "fair"), (0.6999, "poor")])
def test_bands(spark, score, band):
    from pyspark.sql import functions as F

    assert spark.range(1).select(quality.quality_band(F.lit(score))).first()[0] == band


def test_alerts(flawed):
    rows = quality.flagged_columns(quality.column_stats(flawed)).collect()
    assert {r["column"]: r["over_alert"] for r in rows} == {
        "content_id": False, "name": True, "score": True, "size": True,
    }


def test_long_values(spark):
    texts = ["x" * 500, "x" * 499 + "y", "x" * 500, " " * 500, " " * 501 + "z"]
    row = quality.column_stats(spark.createDataFrame([(t,) for t in texts], "text string")).first()
    assert (row["null_count"], row["distinct_count"]) == (1, 4)


def test_large_integers_and_nested_values_stay_exact(spark):
    big = (1 << 53) + 1
    rows = [(big, ["a, b"], (1, None), {"k": 1}), (big, ["a", "b"], (1, "x"), {"k": 1}), (-big, None, None, None)]
    df = spark.createDataFrame(rows, "n bigint, names array<string>, pair struct<a: int, b: string>, m map<string, int>")
    stats = {r["column"]: r for r in quality.exact_column_stats(df).collect()}
    assert (stats["n"]["min_exact"], stats["n"]["max_exact"], stats["names"]["min_exact"]) == (str(-big), str(big), None)
    assert stats["n"]["mean"] == round(big / 3, 4)
    assert [stats[c]["distinct_count"] for c in df.columns] == [2, 3, 3, 2]
    assert [stats[c]["null_count"] for c in df.columns] == [0, 1, 1, 1]


def test_merged_states_are_the_state_of_the_whole(flawed):
    key = ["content_id", "name"]
    parts = [flawed.filter(f"content_id = {i}") for i in (1, 2, 3)] + [flawed.filter("false")]
    state = quality.merged_states(*[quality.profile_state(part, key) for part in parts])
    merged = quality.merged_states(quality.merged_states(state), quality.profile_state(flawed.filter("false"), key))
    assert quality.report_of_state(merged, flawed.columns, key).collect() == quality.quality_report(flawed, key).collect()
    whole = quality.exact_column_stats(flawed).collect()
    assert sorted(map(str, quality.stats_of_state(merged, flawed.columns).collect())) == sorted(map(str, whole))


def test_the_report_reads_its_input_once(spark, flawed, tmp_path):
    flawed.write.parquet(str(tmp_path / "t"))
    report = quality.quality_report(spark.read.parquet(str(tmp_path / "t")))
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert tuple(report.first()["duplicates"]) == tuple(quality.quality_report(flawed).first()["duplicates"])
    assert tuple(report.first()["duplicates"])[1:] == tuple(quality.key_duplicates(flawed, ["content_id"]).first())[1:]
