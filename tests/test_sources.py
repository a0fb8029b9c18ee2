import json
import os

import pytest
from pyspark.sql import functions as F

from vellumark import session
from vellumark.sources import catalogue, sinks


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


HEADER = "show_id,type,title,director,country,date_added,release_year,rating,duration,listed_in,description\n"


def test_csv_is_read_by_name_as_text(spark, tmp_path):
    path = write(tmp_path / "c.csv", HEADER + 's1,Movie,T,Ann,"Peru, Chile","May 1, 2020",2019,PG,9 min,A,"D, e"\n')
    df = catalogue.read_catalogue_csv(spark, path)
    assert df.columns == catalogue.RAW_COLUMNS
    assert {kind for _, kind in df.dtypes} == {"string"}
    row = df.first()
    assert (row["country"], row["release_year"], row["description"]) == ("Peru, Chile", "2019", "D, e")


def test_csv_quoted_line_breaks(spark, tmp_path):
    path = write(tmp_path / "c.csv", HEADER + 's1,Movie,T,,,,2019,PG,9 min,A,"one\ntwo ""three"""\n')
    df = catalogue.read_catalogue_csv(spark, path, multi_line=True, escape='"')
    assert [r["description"] for r in df.collect()] == ['one\ntwo "three"']
    assert catalogue.read_catalogue_csv(spark, path).count() == 2


def test_damaged_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    whole = 's{},Movie,T,Ann,"Peru, Chile","May 1, 2020",2019,PG,9 min,A,"D, e"\n'
    lines = [whole.format(1), "s2,Movie\n", whole.format(3).rstrip() + ",x,y\n", "\n", 's4,Movie,"open\n', 'rest",Ann\n', whole.format(5), "s6,,,,,,,,,,\n"]
    first = write(tmp_path / "in" / "a.csv", HEADER + "".join(lines))
    write(tmp_path / "in" / "b.csv", HEADER.replace("show_id,type", "type,show_id") + whole.format(7))
    write(tmp_path / "in" / "c.csv", HEADER)
    kept, rejected = catalogue.quarantined_csv(spark, str(tmp_path / "in"))
    assert kept.columns == catalogue.RAW_COLUMNS
    assert sorted((r.show_id, r.country) for r in kept.collect()) == [("s1", "Peru, Chile"), ("s5", "Peru, Chile"), ("s6", None)]
    got = sorted((r.line[:7], r.reason, r.file.endswith("a.csv"), r.block) for r in rejected.collect() if r.reason != "header")
    assert got == [('rest",A', "torn", True, 0), ("s2,Movi", "short", True, 0), ("s3,Movi", "long", True, 0), ("s4,Movi", "torn", True, 0)]
    others = rejected.filter("reason = 'header'").collect()
    assert len(others) == 2 and all(r.file.endswith("b.csv") for r in others)
    assert kept.count() + rejected.count() == len(lines) - 1 + 2
    with pytest.raises(catalogue.MissingInput):
        catalogue.quarantined_csv(spark, first + ".none")


def test_missing_inputs(spark, tmp_path):
    with pytest.raises(catalogue.MissingInput):
        catalogue.read_catalogue_csv(spark, str(tmp_path / "none.csv"))
    with pytest.raises(catalogue.MissingInput):
        catalogue.read_table(spark, str(tmp_path / "none"))
    assert catalogue.read_table(spark, str(tmp_path / "none"), catalogue.RAW_SCHEMA).count() == 0
    assert catalogue.read_report(spark, str(tmp_path / "none.json"), catalogue.RAW_SCHEMA).count() == 0


def test_sinks(spark, tmp_path):
    df = spark.range(200).select("id", (F.col("id") * 2).alias("twice"))
    sinks.write_table(df, str(tmp_path / "t"))
    sinks.write_table(df, str(tmp_path / "t"))
    assert catalogue.read_table(spark, str(tmp_path / "t")).count() == 200

    sinks.write_preview_csv(df.orderBy(F.desc("id")), str(tmp_path / "p.csv"))
    parts = [name for name in os.listdir(tmp_path / "p.csv") if name.startswith("part-")]
    lines = (tmp_path / "p.csv" / parts[0]).read_text().splitlines()
    assert len(parts) == 1 and lines[:2] == ["id,twice", "199,398"] and len(lines) == 51

    report = spark.createDataFrame([(1, None)], "a int, b string")
    sinks.write_report(report, str(tmp_path / "r.json"))
    part = next((tmp_path / "r.json").glob("part-*.json"))
    assert json.loads(part.read_text()) == {"a": 1, "b": None}
    assert catalogue.read_report(spark, str(tmp_path / "r.json"), report.schema).first()["a"] == 1


def test_tables_are_built_once(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert session.built_once(spark, "three", "here", build).count() == 3
    assert len(calls) == 1


def test_only_small_inputs_are_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    assert session.spread(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == cores
    many = spark.range(10, numPartitions=cores + 3)
    assert session.spread(many) is many


def test_built_tables_follow_their_files(spark, tmp_path):
    folder = str(tmp_path)

    def build():
        return session.built_once(spark, "counted", folder, lambda: spark.read.parquet(f"{folder}/t.parquet").groupBy().count())

    spark.range(3).write.parquet(f"{folder}/t.parquet")
    assert (build().first()[0], build().first()[0]) == (3, 3)
    spark.range(5).write.mode("overwrite").parquet(f"{folder}/t.parquet")
    assert build().first()[0] == 5
