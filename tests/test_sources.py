"""Sources and sinks: NA tokens, NaN normalisation, CSV round trip."""

import math
import os
import tempfile

from creditlens.sources import nan_to_null, read_csv_na, write_csv_na
from creditlens.sources.tables import Tables
from conftest import SF001


def test_csv_na_tokens_and_inference(spark):
    d = tempfile.mkdtemp(prefix="creditlens-csv-")
    path = os.path.join(d, "a.csv")
    with open(path, "w") as fh:
        fh.write("id,x,s\n1,NA,a\n2,2.5,\n3,,NA\n")
    df = read_csv_na(spark, path)
    assert dict(df.dtypes)["x"] == "double"  # NA did not turn the column into strings
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [(1, None, "a"), (2, 2.5, None), (3, None, None)]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    got = [r.x for r in nan_to_null(df).collect()]
    assert got[0] is None and got[1] == 1.0 and not any(isinstance(v, float) and math.isnan(v) for v in got)


def test_csv_sink_round_trip_keeps_values(spark):
    from creditlens.sources import fixtures
    app = fixtures.application(Tables(spark, SF001))
    path = os.path.join(tempfile.mkdtemp(prefix="creditlens-sink-"), "app")
    write_csv_na(app, path)
    back = read_csv_na(spark, path, app.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, app.collect()))
