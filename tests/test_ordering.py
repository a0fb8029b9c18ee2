import random

from vellumark.operators import ordering

COLUMNS = "title_mentions long, content_type string, keyword string"


def test_places_over_many_ranges(spark):
    draw = random.Random(3)
    rows = [(draw.randint(1, 9), draw.choice(["b", "a", None]), f"k{i:04d}") for i in range(500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = ordering.ranked(spark.createDataFrame(rows, COLUMNS).repartition(5), "keywords").collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or "", r[2]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.place)] == want
    assert sorted(r.place for r in got) == list(range(1, 501))


def test_places_of_equal_rows_and_none(spark):
    same = spark.createDataFrame([(1, "a", "x")] * 20, COLUMNS)
    assert sorted(r.place for r in ordering.ranked(same, "keywords").collect()) == list(range(1, 21))
    assert ordering.ranked(same.limit(0), "keywords").count() == 0
