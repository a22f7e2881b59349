import datetime as dt
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaar.operators import events as E
from bazaar.operators import incremental as I
from bazaar.streaming.hourly import USER_EVENTS_SCHEMA

T0 = dt.datetime(2024, 3, 1)


def rows(days, per=30):
    return [(100 * d + i, i % 7, T0 + dt.timedelta(days=d, minutes=37 * i), ["tv", "desk"][i % 2], "view", float(i)) for d in days for i in range(per)]


def test_only_changed_days_are_written(spark):
    path = tempfile.mkdtemp(prefix="bazaar-inc-")

    def run(data):
        df = spark.createDataFrame(data, USER_EVENTS_SCHEMA)
        s = I.export_changed_days(df, path).first()
        got = {r.hour: tuple(r[c] for c in E.COMPACT_HOURLY) for r in spark.read.parquet(f"{path}/metrics").collect()} if s.days else {}
        want = {r.hour: tuple(r[c] for c in E.COMPACT_HOURLY) for r in E.compact_types(E.hourly_metrics(df.where("ts IS NOT NULL")), E.COMPACT_HOURLY).collect()}
        assert got == want
        return s.days, s.days_written, s.days_kept, s.days_removed

    def stamps():
        root = f"{path}/metrics"
        return {d: max(os.path.getmtime(f"{root}/{d}/{f}") for f in os.listdir(f"{root}/{d}")) for d in os.listdir(root) if "=" in d}

    assert run(rows([0, 1, 2])) == (3, 3, 0, 0)
    first = stamps()
    assert run(list(reversed(rows([0, 1, 2])))) == (3, 0, 3, 0) and stamps() == first     # another order changes nothing
    assert run(rows([0, 1, 2, 3])) == (4, 1, 3, 0)
    after = stamps()
    assert {d: after[d] for d in first} == first and len(after) == 4
    late = rows([0, 1, 2, 3]) + [(999, 50, T0 + dt.timedelta(days=1, hours=2), "tv", "view", 1.0), (998, 1, None, "tv", "view", 1.0)]
    assert run(late) == (4, 1, 3, 0)
    assert run(rows([0, 2, 3])) == (3, 0, 3, 1)
    assert run(rows([0, 2, 3]) + rows([0])) == (3, 1, 2, 0)                              # repeated rows count


def test_merged_profile_against_exact_values(spark):
    rng = np.random.default_rng(1)
    data = [(int(d), float(x) if i % 9 else None, f"k{i % 700}" if i % 5 else None, None)
            for i, (d, x) in enumerate(zip(rng.integers(0, 6, 6000), rng.lognormal(3, 2, 6000) + 1e7))]
    df = spark.createDataFrame(data, "day int, x double, s string, empty double")
    parts = I.profile_sketches(df, ["x", "s", "empty"], by=["day"])
    got = {r.column_name: r for r in I.merge_profiles(parts, [0.1, 0.5, 0.99]).collect()}
    x = np.array([v[1] for v in data if v[1] is not None])
    r = got["x"]
    assert (r.total, r["count"], r.nulls) == (6000, len(x), 6000 - len(x))
    assert r.mean == pytest.approx(x.mean(), rel=1e-12) and r["std"] == pytest.approx(x.std(ddof=1), rel=1e-9)
    assert (r["min"], r["max"]) == (x.min(), x.max())
    for p in (0.1, 0.5, 0.99):
        q = r[f"q{round(p * 100)}"]
        assert (x < q).mean() <= p + I.RANK_ERROR and (x <= q).mean() >= p - I.RANK_ERROR
    assert abs(r["distinct"] - len(set(x))) <= I.DISTINCT_ERROR * len(set(x)) + 1
    s = got["s"]
    assert abs(s["distinct"] - len({v[2] for v in data if v[2]})) <= 20 and s.mean is None and s["q50"] is None
    e = got["empty"]
    assert (e.total, e["count"], e["distinct"], e.mean, e["std"], e["q50"]) == (6000, 0, 0, None, None, None)
    assert I.merge_profiles(I.profile_sketches(df.limit(0), ["x"], by=["day"])).collect() == []
