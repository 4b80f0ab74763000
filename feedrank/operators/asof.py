"""As-of lookup: for each left time, the latest right row at or before it.

Spark has no as-of join. This one is built from a union and windows, without
a range or cross join and without a global sort of the data:

1. Work is keyed by the *distinct* left times (an aggregate), not by left rows.
2. Level 1, per time bucket: union left times and right rows, order by
   (ts, right-before-left) inside the bucket, take the last non-null right
   value. A window partitioned by bucket, so buckets run in parallel.
3. Level 2, carry-in for left times whose bucket has no earlier right row: the
   last right row of each bucket (``max_by``) and the distinct left buckets are
   ordered by bucket in one small window. Its size is the number of distinct
   buckets (calendar time / bucket width), independent of the data volume.
4. The result (one row per distinct left time) is equi-joined back; AQE turns
   that join into a broadcast at run time when its measured size is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY_MS = 24 * 60 * 60 * 1000


def asof_values(left_times: DataFrame, left_ts: str, right: DataFrame, right_ts: str,
                value_cols: list[str], bucket_ms: int = DAY_MS) -> DataFrame:
    """Return (left_ts, value_cols...) for each distinct left time.

    Values are null when no right row is at or before the left time.
    """
    lt = (left_times.select(F.col(left_ts).alias("_ts")).distinct()
          .withColumn("_b", F.floor(F.col("_ts") / F.lit(bucket_ms))))
    rv = F.struct(*[F.col(c) for c in value_cols]).alias("_v")
    rt = right.select(F.col(right_ts).alias("_ts"), rv) \
              .withColumn("_b", F.floor(F.col("_ts") / F.lit(bucket_ms)))

    # Level 1: within a bucket. kind 0 = right row, 1 = left time (right first on ties).
    u = (rt.select("_b", "_ts", F.lit(0).alias("_k"), "_v")
         .unionByName(lt.select("_b", "_ts", F.lit(1).alias("_k"),
                                F.lit(None).cast(rt.schema["_v"].dataType).alias("_v"))))
    w1 = Window.partitionBy("_b").orderBy("_ts", "_k") \
               .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lvl1 = (u.withColumn("_in", F.last("_v", ignorenulls=True).over(w1))
             .filter(F.col("_k") == 1).select("_b", "_ts", "_in"))

    # Level 2: carry-in from earlier buckets (one row per distinct bucket).
    last_of_bucket = rt.groupBy("_b").agg(F.max_by("_v", "_ts").alias("_v"))
    left_buckets = lt.select("_b").distinct()
    ub = (left_buckets.select("_b", F.lit(0).alias("_k"),
                              F.lit(None).cast(rt.schema["_v"].dataType).alias("_v"))
          .unionByName(last_of_bucket.select("_b", F.lit(1).alias("_k"), "_v")))
    w2 = Window.orderBy("_b", "_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = (ub.withColumn("_carry", F.last("_v", ignorenulls=True).over(w2))
               .filter(F.col("_k") == 0).select("_b", "_carry"))

    res = (lvl1.join(carry, "_b", "left")
               .select(F.col("_ts").alias(left_ts),
                       F.coalesce("_in", "_carry").alias("_v")))
    return res.select(left_ts, *[F.col("_v")[c].alias(c) for c in value_cols])
