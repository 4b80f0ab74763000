import random

import pandas as pd

from feedrank.operators.latency import latency_windows
from feedrank.operators.windows import previous_ts, row_number_by_time

HOUR = 3_600_000


def rand_frame(spark, n=400, seed=3):
    rnd = random.Random(seed)
    data = [(rnd.randrange(3), rnd.randrange(0, 50 * HOUR), i) for i in range(n)]
    return data, spark.createDataFrame(data, "k long, ts long, id long")


def test_previous_ts_brute(spark):
    data, df = rand_frame(spark)
    got = {r.id: r.prev_ts for r in previous_ts(df, "ts", ["k"], ["id"], bucket_ms=HOUR).collect()}
    pdf = pd.DataFrame(data, columns=["k", "ts", "id"]).sort_values(["k", "ts", "id"])
    pdf["prev"] = pdf.groupby("k")["ts"].shift(1)
    for r in pdf.itertuples():
        exp = None if pd.isna(r.prev) else int(r.prev)
        assert got[r.id] == exp


def test_row_number_brute(spark):
    data, df = rand_frame(spark, seed=5)
    got = {r.id: r.rn for r in row_number_by_time(df, "ts", ["k"], ["id"], bucket_ms=HOUR).collect()}
    pdf = pd.DataFrame(data, columns=["k", "ts", "id"]).sort_values(["k", "ts", "id"])
    pdf["rn"] = pdf.groupby("k").cumcount() + 1
    assert all(got[r.id] == r.rn for r in pdf.itertuples())


def test_latency_brute(spark):
    rnd = random.Random(11)
    now = 100 * HOUR
    data = []
    for i in range(523):
        click = rnd.randrange(0, 90 * HOUR)
        ingest = None if i % 37 == 0 else click + rnd.randrange(0, 1000)
        data.append((rnd.randrange(2), click, ingest, i))
    df = spark.createDataFrame(data, "source_partition long, click_ts long, ingest_ts long, id long")
    got = sorted((r.source_partition, r.window_index, r.n, round(r.average_latency_ingest, 6),
                  round(r.average_latency_click, 6))
                 for r in latency_windows(df, now, 50, tiebreak=["id"]).collect())
    exp = []
    for p in (0, 1):
        seq = sorted((c, i, g) for sp, c, g, i in data if sp == p and g is not None)
        for w in range(len(seq) // 50):
            chunk = seq[w * 50:(w + 1) * 50]
            exp.append((p, w, 50, round(sum(now - g for _, _, g in chunk) / 50, 6),
                        round(sum(now - c for c, _, _ in chunk) / 50, 6)))
    assert got == sorted(exp)
