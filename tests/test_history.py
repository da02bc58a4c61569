from datetime import datetime, timedelta

from dayloom.operators.history import version_at, versions

SCHEMA = "site string, name string, lat double, at timestamp_ntz"
DAY = datetime(2024, 1, 1)


def test_runs_become_versions(spark):
    h = lambda n: DAY + timedelta(hours=n)
    rows = [
        ("a", "x", 1.0, h(0)), ("a", "x", 1.0, h(5)), ("a", "y", 1.0, h(6)), ("a", "x", 1.0, h(7)), ("a", "x", 1.0, h(40)), ("a", "x", None, h(80)),
        ("a", "x", None, h(81)), ("a", None, None, h(82)), ("a", "w", 0.0, h(82)), ("b", None, None, h(1)), ("b", None, None, h(99)), ("c", "x", 1.0, None), (None, "q", 2.0, h(3)),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(map(tuple, versions(df, ["site"], ["name", "lat"], "at").collect()), key=str)
    want = [
        ("a", "x", 1.0, h(0), h(6), False, 1), ("a", "y", 1.0, h(6), h(7), False, 2), ("a", "x", 1.0, h(7), h(80), False, 3),
        ("a", "x", None, h(80), h(82), False, 4), ("a", "w", 0.0, h(82), None, True, 5), ("b", None, None, h(1), None, True, 1), (None, "q", 2.0, h(3), None, True, 1),
    ]
    assert got == sorted(want, key=str)
    facts = spark.createDataFrame([("a", h(6)), ("a", h(-1)), ("a", h(200)), ("z", h(1)), ("a", None), ("a", h(6))], "site string, t timestamp_ntz")
    at = version_at(facts, versions(df, ["site"], ["name", "lat"], "at"), ["site"], "t", ["name"])
    assert sorted(map(str, map(tuple, at.select("t", "name").collect()))) == sorted(
        map(str, [(h(6), "y"), (h(-1), None), (h(200), "w"), (h(1), None), (None, None), (h(6), "y")])
    )
    assert versions(df.limit(0), ["site"], ["name"], "at").count() == 0
