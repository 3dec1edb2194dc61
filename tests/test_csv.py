import datetime

from tabml.sources import column_types, read_csv_checked, write_csv
from tabml.sources.staging import stage_path

SCHEMA = "id BIGINT, price DOUBLE, day DATE, name STRING"


def test_awkward_texts_round_trip(spark):
    day = datetime.date(2024, 2, 29)
    texts = ["", None, '"', 'a "quoted" b', "a,b", "a\nb\r\nc", " spaced ", "\\", "NULL", "ä€😀", "'"]
    rows = [(k, None if k % 3 == 0 else k / 7, day if k % 2 else None, t) for k, t in enumerate(texts)]
    path = stage_path(spark, "csv")
    write_csv(spark.createDataFrame(rows, SCHEMA), path)
    good, bad = read_csv_checked(spark, path, SCHEMA)
    assert sorted(map(tuple, good.collect())) == rows and bad.count() == 0


def test_bad_lines_are_set_apart(spark):
    path = stage_path(spark, "csv")
    lines = ["id,price,day,name", "1,2.5,2024-01-01,x", "2,dear,2024-01-01,x", "3,1.0,soon,x", "4,1.0", "5,1,2024-01-01,x,y", ",,,"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    good, bad = read_csv_checked(spark, path, SCHEMA)
    assert sorted((r["id"] for r in good.collect()), key=str) == [1, None]
    assert sorted(r["line"] for r in bad.collect()) == sorted(lines[2:6])
    # Asking for one column judges whole lines.
    assert good.select("name").count() == 2


def test_column_types(spark):
    frame = spark.createDataFrame([], "`a.b` decimal(10,2), c array<int>")
    assert [tuple(r) for r in column_types(frame).collect()] == [(0, "a.b", "decimal(10,2)"), (1, "c", "array<int>")]
