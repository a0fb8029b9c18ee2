import json

from vellumark.operators.quality import quality_report
from vellumark.plans import quality_job, transform
from vellumark.plans.metrics import METRICS_SCHEMA, RunMeter, headline_counts, run_metrics
from vellumark.sources.catalogue import read_catalogue_csv, read_report, read_table

SUBJECTS = ["sea", "harbour", "mountain", "market", "village", "river", "castle", "garden"]


def catalogue_csv(path):
    lines = ["show_id,type,title,country,release_year,rating,date_added,duration,listed_in,description"]
    for i in range(60):
        a, b = SUBJECTS[i % 8], SUBJECTS[(i * 3 + 1) % 8]
        year = 2012 + i % 11
        lines.append(
            f's{i},{"Movie" if i % 3 else "TV Show"},The {a} story {i},"Peru, Chile",{year},PG,"May {i % 28 + 1}, 2021",'
            f'{i} min,Dramas,"Friends celebrate a {a} near the {b} while danger and love return to the {b}"'
        )
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_whole_run(spark, tmp_path):
    out = str(tmp_path / "out")
    source = catalogue_csv(tmp_path / "in.csv")
    transform.run(spark, source, out, sort=True)
    tables = {name: read_table(spark, f"{out}/{name}") for name in transform.OUTPUTS}
    cleaned = tables["cleaned"].count()
    assert cleaned == sum(2012 + i % 11 >= 2015 for i in range(60))
    assert tables["text_features"].count() == tables["sentiment"].count() == tables["topic_clusters"].count() == cleaned
    assert tables["keywords"].count() == tables["tfidf"].count() > 0
    assert {r[0] for r in tables["text_features"].select("sentiment_score").collect()} <= {
        r[0] for r in tables["sentiment"].select("sentiment_score").collect()
    }
    assert tables["keywords"].filter("keyword = 'celebr'").count() == 2
    assert tables["similarity_pairs"].count() > 0
    per_left = tables["similarity_pairs"].groupBy("left_content_id").count().agg({"count": "max"}).first()[0]
    assert per_left <= 3

    metrics = read_report(spark, f"{out}/metrics.json", METRICS_SCHEMA)
    row = metrics.first().asDict()
    assert row["raw_row_count"] == 60 and row["dropped_row_count"] == 60 - cleaned
    assert row["tokenized_document_count"] == row["stemmed_document_count"] == cleaned
    labels = ("positive", "neutral", "negative")
    assert sum(row[f"{label}_document_count"] for label in labels) == cleaned
    # The writes observed what the stored tables hold.
    asked = run_metrics({"raw": read_catalogue_csv(spark, source), **tables}, source, stamp=False).first().asDict()
    kept = {name: value for name, value in asked.items() if value is not None}
    assert len(kept) == 19 and kept.items() <= row.items()
    part = next((tmp_path / "out" / "metrics.json").glob("part-*.json"))
    assert set(json.loads(part.read_text())) == set(METRICS_SCHEMA.names)
    assert headline_counts(metrics, {"raw": tables["cleaned"]}).first()["raw_row_count"] == 60

    quality_job.run(spark, f"{out}/cleaned", f"{out}/quality.json")
    schema = quality_report(tables["cleaned"]).schema
    report = read_report(spark, f"{out}/quality.json", schema).first()
    assert report["duplicates"]["duplicate_rows"] == 0 and report["quality_score"] == 1.0


def test_run_without_documents(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(
        "show_id,type,title,country,release_year,rating,date_added,duration,listed_in,description\n", encoding="utf-8"
    )
    tables = transform.text_tables(transform.read_catalogue_csv(spark, str(path)))
    assert all(table.count() == 0 for table in tables.values())


def test_meter_of_an_empty_table(spark, tmp_path):
    meter = RunMeter()
    rows = spark.createDataFrame([], "keyword string, content_type string, title_mentions long")
    meter.watch(rows, "keywords").write.parquet(str(tmp_path / "none"))
    row = meter.row(spark, "none").first()
    assert row.keyword_row_count == 0 and row.top_keyword is None and row.bigram_row_count is None
    assert row.generated_at_utc.endswith("+00:00")
