"""Small commit logs and bucketed tables in a shared folder.

:class:`HeadLog` - numbered JSON records under ``<path>/_head``; the newest one
says what is complete. A record is written beside its place and renamed, so a
reader never sees a part of one, and only the last ``keep`` records stay: the
cost of a look-up does not grow with the number of commits.

:class:`BucketTable` - rows by bucket (an hour, a day). A merge rewrites only the
buckets that its changes touch, drops whole buckets that have run out, and then
commits a record naming the folder of each bucket. Readers take the newest record
and list only the folders it names. Folders that no kept record names are removed.

One writer per log or table, as with a streaming query's checkpoint. Buckets
number what the kept time span has hours or days; nothing else reaches the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedrank.session import delete_path, list_names, read_text, write_text

# Fixed value: the folder name that Spark gives to a null partition value.
NULL_BUCKET = "__HIVE_DEFAULT_PARTITION__"


class HeadLog:
    """The last few commit records of a folder, newest first."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 4):
        self.spark, self.folder, self.keep = spark, f"{path.rstrip('/')}/_head", max(2, keep)

    def _numbers(self) -> list[int]:
        names = list_names(self.spark, self.folder)
        return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()),
                      reverse=True)

    def _read(self, number: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.folder}/{number}.json"))

    def records(self) -> list[dict]:
        return [self._read(n) for n in self._numbers()]

    def newest(self) -> dict | None:
        numbers = self._numbers()
        return self._read(numbers[0]) if numbers else None

    def append(self, record: dict) -> None:
        """Commit a record. Older ones beyond ``keep`` stay until :meth:`prune`."""
        number = max(self._numbers(), default=-1) + 1
        write_text(self.spark, f"{self.folder}/{number}.json", json.dumps(record),
                   f"{self.folder}/.{uuid.uuid4().hex}")

    def prune(self) -> None:
        for number in self._numbers()[self.keep:]:
            delete_path(self.spark, f"{self.folder}/{number}.json")


class BucketTable:
    """Rows by bucket under ``<path>/<prefix>=<commit>/<bucket>=<value>``.

    ``schema``: the stored columns, the bucket column last.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, prefix: str,
                 keep: int = 4):
        self.spark, self.path, self.schema, self.prefix = spark, path.rstrip("/"), schema, prefix
        self.bucket = schema.names[-1]
        self.head = HeadLog(spark, self.path, keep)

    def newest(self) -> dict | None:
        """The newest record: ``commit``, ``buckets`` (value -> commit) and the writer's extras."""
        return self.head.newest()

    def _leaf(self, bucket: str, commit: int) -> str:
        return f"{self.path}/{self.prefix}={commit}/{self.bucket}={bucket}"

    def scan(self, buckets: dict[str, int]) -> DataFrame:
        """The rows of the named buckets (``buckets`` of a record, or some of them)."""
        if not buckets:
            return self.spark.createDataFrame([], self.schema)
        return (self.spark.read.schema(self.schema).option("basePath", self.path)
                .parquet(*[self._leaf(b, c) for b, c in sorted(buckets.items())])
                .select(*self.schema.names))

    def merge(self, commit: int, changes: DataFrame, bucket: Column,
              fold: Callable[[DataFrame], DataFrame],
              alive: Callable[[str], bool] = lambda value: True, **extra) -> dict:
        """Fold ``changes`` in and commit; returns the new record.

        ``fold`` maps stored and new rows of the touched buckets to the rows kept
        and must not move rows between buckets; buckets that are not ``alive`` go.
        A commit that is already the newest is left as it is (a retried batch);
        an older one is refused.
        """
        last = self.newest()
        if last is not None and commit <= last["commit"]:
            if commit == last["commit"]:
                return last
            raise ValueError(f"commit {commit} after {last['commit']}: numbers restarted, "
                             "use a new folder")
        kept = {b: c for b, c in (last["buckets"] if last else {}).items() if alive(b)}
        rows = changes.withColumn(self.bucket, bucket.cast(self.schema[-1].dataType))
        name = F.coalesce(F.col(self.bucket).cast("string"), F.lit(NULL_BUCKET))
        touched = [r[0] for r in rows.select(name).distinct().collect() if alive(r[0])]
        if touched:
            rows = rows.filter(name.isin(touched)).select(*self.schema.names)
            old = {b: kept[b] for b in touched if b in kept}
            merged = fold(rows.unionByName(self.scan(old)) if old else rows)
            folder = f"{self.path}/{self.prefix}={commit}"
            (merged.select(*self.schema.names).write.mode("overwrite")
             .partitionBy(self.bucket).parquet(folder))
            # a bucket of which the fold keeps no row has no folder
            made = set(list_names(self.spark, folder))
            kept = {b: c for b, c in kept.items() if b not in touched}
            kept.update((b, commit) for b in touched if f"{self.bucket}={b}" in made)
        record = {"commit": commit, "buckets": kept, **extra}
        self.head.append(record)
        self._clean()
        return record

    def _clean(self) -> None:
        """Remove folders that no kept record names, then the records beyond ``keep``.

        Commits from the oldest kept record on are never touched as a whole; an
        older folder that no record names is left over from a failed attempt.
        """
        records = self.head.records()
        live, gone = records[:self.head.keep], records[self.head.keep:]
        used = {(b, c) for r in live for b, c in r["buckets"].items()}
        commits = {c for _, c in used}
        for b, c in {(b, c) for r in gone for b, c in r["buckets"].items()} - used:
            if c in commits:
                delete_path(self.spark, self._leaf(b, c))
        first = live[-1]["commit"]
        for name in list_names(self.spark, self.path):
            key, _, number = name.partition("=")
            if key == self.prefix and int(number) < first and int(number) not in commits:
                delete_path(self.spark, f"{self.path}/{name}")
        self.head.prune()
