"""Version keys against the order they stand for, and tables that are kept up to date by batches."""

import random
import re

from conftest import frame, planted
from pyspark.sql import functions as F

from calipers.functions import versions as V
from calipers.operators import pointers, rules

TOP = 2**64 - 1


def parts(text):
    """Reference reading for the tests."""
    number = lambda p: int(p) if re.fullmatch(r"[+]?[0-9]+", p) and int(p) <= TOP else 0
    return [number(p) for p in text.split(".")]


def test_byte_order_of_keys_is_the_order_of_versions(spark):
    rng = random.Random(3)
    pool = ["0", "1", "2", "9", "10", "00", "+7", "7", "-1", "x", "", str(TOP), str(TOP + 1), "9" * 30, "1b", "2147483648"]
    texts = sorted({".".join(rng.choice(pool) for _ in range(rng.randrange(1, 6))) for _ in range(600)} | {"é.1", " 1", "1 "})
    df = spark.createDataFrame([(t,) for t in texts], "v string").select("v", V.version_key("v").alias("k"), V.parts_key("v").alias("p"), V.version_of_key(V.version_key("v")).alias("back"))
    rows = df.collect()
    assert [r.back for r in rows] == [r.v for r in rows]
    order = lambda r: (parts(r.v), r.v.encode())
    assert sorted(rows, key=order) == sorted(rows, key=lambda r: r.k.encode())
    assert len({r.p for r in rows}) == len({tuple(parts(r.v)) for r in rows})
    ranks = {p: n for n, p in enumerate(sorted({r.p for r in rows}, key=str.encode))}
    assert all((parts(a.v) < parts(b.v)) == (ranks[a.p] < ranks[b.p]) for a in rows[:80] for b in rows)
    assert df.agg(F.max("k")).first()[0] == max(rows, key=order).k
    assert spark.sql("SELECT CAST(NULL AS string) AS v").select(V.version_key("v"), V.parts_key("v")).first() == (None, None)


def test_ties_stay_and_longer_versions_are_newer(spark):
    rows = [planted(id=str(n), **{"browser.version": v}) for n, v in enumerate(["9.0", "10.0", "10.00", "10", "10.0.0.0", "10.0.0.00"])]
    got = pointers.latest_routes(frame(spark, rows), "n")
    assert {r.n for r in got.collect()} == {4, 5}
    assert pointers.pointers_per_channel(frame(spark, rows)).first().version == "10.0.0.00"


def test_merged_pointers_and_index_equal_the_whole(spark):
    rng = random.Random(5)
    rows = [planted(id=str(n), **{"browser.version": f"{rng.randrange(9, 12)}.{rng.randrange(3)}", "browser.channel": rng.choice(["stable", "beta"])}) for n in range(60)]
    df = frame(spark, rows)
    first, second = df.where("n < 40"), df.where("n >= 30")  # ten rows come twice
    for make in (pointers.pointers_per_channel, pointers.pointers_latest):
        merged = pointers.merge_pointers(make(first), make(second))
        assert sorted(merged.collect()) == sorted(make(df).collect())
        assert pointers.derived_vs_stored(make(df), merged, ["key"]).count() == 0
    index = lambda x: pointers.index(x.drop("n"), rules.is_draft())
    merged = pointers.merge_index(index(first), index(second))
    assert sorted(map(str, merged.collect())) == sorted(map(str, index(df).collect()))
    assert pointers.merge_index(merged, index(second)).count() == 60
    assert pointers.merge_index(index(df.limit(0)), index(df)).count() == 60
