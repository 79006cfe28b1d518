"""The augmented box statistics cover both columns the reference draws."""

import duckdb

from conftest import SF001


def test_augmented_boxes_have_both_reference_columns(spark):
    import __spark_entry__ as entry
    con = duckdb.connect()
    for t in ["customer", "orders", "lineitem", "events", "nation", "region"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    sdf = entry.queries()["box_stats_augmented"](spark, SF001)
    cur = con.execute(entry.oracle_sql()["box_stats_augmented"])
    cols = [d[0] for d in cur.description]
    mine = [tuple(r[c] for c in cols) for r in sdf.collect()]
    assert {"AMT_BALANCE_MEAN", "MONTHS_BUREAU_MEAN"} <= {r[cols.index("variable")] for r in mine}
    assert sorted(mine, key=repr) == sorted(cur.fetchall(), key=repr)
