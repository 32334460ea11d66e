import datetime as dt

from pyspark.sql import functions as F

from heddle.streaming import streams

SCHEMA = "id int, user string, kind string, ts timestamp"


def at(day, hour=0):
    return dt.datetime(2026, 1, 1) + dt.timedelta(days=day, hours=hour)


def stream(spark, folder, *batches):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def collected(spark, df, tmp_path, mode="append"):
    out = []
    streams.run_available(df, lambda b, n: out.extend((n, *r) for r in b.collect()), str(tmp_path / "check"), mode)
    return out


def test_first_seen(spark, tmp_path):
    s = stream(spark, str(tmp_path / "in"), [(1, "a", "x", at(0)), (2, "b", "x", at(0))], [(3, "a", "x", at(10)), (4, "c", "x", at(90))])
    got = collected(spark, streams.first_seen(s, "user", "ts", 5).select("id"), tmp_path)
    assert sorted(r[1] for r in got) == [1, 2, 4] and streams.look_back(5) == 30 and streams.look_back(20) == 40


def test_failure_runs(spark, tmp_path):
    s = stream(spark, str(tmp_path / "in"), [(1, "a", "error", at(0)), (2, "a", "error", at(1)), (3, "b", "ok", at(1))], [(4, "a", "error", at(2)), (5, "b", "error", at(2))], [(6, "a", "ok", at(3)), (7, "a", "error", at(3, 1))])
    got = collected(spark, streams.failure_runs(s, "user", F.col("kind") == "error", "ts", "id"), tmp_path, "update")
    last = {}
    for n, source, runs in sorted(got):
        last[source] = (n, runs)
    assert {k: v[1] for k, v in last.items()} == {"a": 1, "b": 1}
    assert [r[2] for r in sorted(got) if r[1] == "a"] == [2, 3, 1]


def test_failure_runs_in_any_order(spark, tmp_path):
    rows = [(i, f"u{i % 3}", "ok" if i % 7 == 3 else "error", at(i % 23, i % 5)) for i in range(60)]
    s = stream(spark, str(tmp_path / "in"), rows[:20], rows[40:], rows[20:40], [(99, "u9", None, at(24)), (98, None, "error", at(24)), (97, "u0", "error", None)])
    got = collected(spark, streams.failure_runs(s, "user", F.col("kind") == "error", "ts", "id"), tmp_path, "update")
    last = {source: runs for _, source, runs in sorted(got, key=lambda r: r[0])}
    want = {}
    for u in ("u0", "u1", "u2"):
        own = sorted((t, i, k) for i, v, k, t in rows if v == u)
        good = [j for j, x in enumerate(own) if x[2] == "ok"]
        want[u] = len(own) - 1 - max(good, default=-1)
    assert last == {**want, "u9": 0, None: 1}


def test_failures_that_the_watermark_passed_still_count(spark, tmp_path):
    s = stream(spark, str(tmp_path / "in"), [(1, "a", "error", at(0)), (2, "b", "x", at(40))], [(3, "a", "error", at(39))], [(4, "a", "ok", at(1)), (5, "a", "error", at(41))], [(6, "a", "ok", at(40)), (7, "b", "error", at(43))])
    got = collected(spark, streams.failure_runs(s, "user", F.col("kind") == "error", "ts", "id", "5 days"), tmp_path, "update")
    assert [runs for _, source, runs in sorted(got, key=lambda r: r[0]) if source == "a"] == [1, 2, 3, 1]


def test_windows_drop_what_is_too_late(spark, tmp_path):
    s = stream(spark, str(tmp_path / "in"), [(1, "a", "x", at(0)), (2, "a", "x", at(30))], [(3, "a", "x", at(31))], [(4, "a", "x", at(1)), (5, "a", "x", at(90))])
    got = collected(spark, streams.counts_by_window(s, "ts", ["user"]), tmp_path)
    assert sum(r[3] for r in got) == 3
