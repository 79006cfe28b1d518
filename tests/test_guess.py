"""Types of a CSV without a schema, and the values that do not fit a declared one."""

from pyspark.sql import functions as F

from creditlens.sources import guess


def test_types_come_from_all_rows(spark, tmp_path):
    n = 3_000  # the last row decides for some columns
    rows = [(("TRUE", "F")[i % 2], str(i), f"{i}.5", "2024-02-28", "2024-02-28 10:00:00", "NA", str(i), str(i), "x,y", "1e3")
            for i in range(n)] + [("NA", "-7", "3", "NA", "2024-03-01", "NA", "1.5", "2024-01-01", "", "+.5")]
    names = ["flag", "int", "num", "day", "time", "none", "late", "mixed", "text", "exp"]
    path = str(tmp_path / "csv")
    spark.createDataFrame(rows, names).repartition(4).write.option("header", True).csv(path)
    text = guess.read_text(spark, path)
    got = {r["column"]: (r["type"], r["n_values"], r["n_missing"]) for r in guess.guess_types(text).collect()}
    assert got == {"flag": ("boolean", n, 1), "int": ("bigint", n + 1, 0), "num": ("double", n + 1, 0),
                   "day": ("date", n, 1), "time": ("timestamp", n + 1, 0), "none": ("void", 0, n + 1),
                   "late": ("double", n + 1, 0), "mixed": ("string", n + 1, 0), "text": ("string", n, 1),
                   "exp": ("double", n + 1, 0)}
    schema = guess.guess_schema(text)
    assert [f.name for f in schema.fields] == names and schema["day"].dataType.simpleString() == "date"


def test_misfits_are_counted(spark):
    text = spark.createDataFrame([("1", "2024-02-30", "a"), ("x", "2024-02-28", None), ("x", None, "7")],
                                 "n string, d string, s string")
    want = spark.createDataFrame([], "n int, d date, s string").schema
    rows = {(r["column"], r["expected"], r["actual"], r["n"]) for r in guess.misfits(text, want).collect()}
    assert rows == {("n", "int", "x", 2), ("d", "date", "2024-02-30", 1)}
    assert guess.misfits(text.select(F.col("s")), want).count() == 0


def test_empty_frame_has_no_types(spark):
    text = spark.createDataFrame([], "a string, b string")
    assert guess.guess_types(text).count() == 0
    assert [f.dataType.simpleString() for f in guess.guess_schema(text).fields] == ["string", "string"]
