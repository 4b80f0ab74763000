"""feedrank: real-time post ranking from feed click streams, on Spark.

Layout
------
sources/    table loading, fixture derivation, raw JSON ingest, changelog scans
functions/  Column-level scalar functions (scoring, CTR, time formats)
operators/  DataFrame -> DataFrame relational operators (join, counts, live
            table, scoring, ranking, monitoring, latency windows)
sinks/      batch writers (score CSV, push log, snapshot JSON, config history)
streaming/  Structured Streaming topology (enriched stream, counts changelog,
            snapshot publisher, heartbeats)
plans/      end-to-end compositions of the operators (batch scoring report)

Every operator is a pure function of DataFrames; "now" / "as of" instants are
always parameters, never read from the wall clock inside an operator.
"""

from feedrank.session import get_session, scratch_dir  # noqa: F401

__all__ = ["get_session", "scratch_dir"]
