"""Instants of years beyond four digits, and of years before the first."""

import duckdb

from calipers.functions import identity as I
from calipers.plans.oracles import ORACLES


def values(spark, rows, kind, *cols):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i bigint, x {kind}")
    return [tuple(r)[1:] for r in df.select("i", *cols).orderBy("i").collect()]


def test_instants_of_far_years(spark):
    rows = [253402300799, 253402300800, 253402300800 + 12622780800 * 2000, -62135596801, -62167219201, 2**63 - 1, -(2**63), None]
    assert [r[0] for r in values(spark, rows, "bigint", I.unix_to_instant("x"))] == [
        "9999-12-31T23:59:59Z", "10000-01-01T00:00:00Z", "810000-01-01T00:00:00Z", "0000-12-31T23:59:59Z", "-001-12-31T23:59:59Z",
        "292277026596-12-04T15:30:07Z", "-292277022657-01-27T08:29:52Z", None,
    ]


def test_the_sql_gives_the_same_for_any_key(spark):
    keys = [0, 4999, 5000, 149999, 418600, 13_000_000, 60_000_000]
    con = duckdb.connect()
    sql = ORACLES["unix_to_instant"]
    con.execute(f"CREATE TABLE prof AS SELECT unnest({keys}::BIGINT[]) AS row_key")
    want = con.execute("WITH " + sql[sql.index("sec AS"):]).fetchall()
    got = values(spark, [(k - 5000) * 86413 * 7 for k in keys], "bigint", I.unix_to_instant("x"))
    assert sorted(r[0] for r in got) == sorted(w[1] for w in want)
