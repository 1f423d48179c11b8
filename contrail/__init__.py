"""contrail: flight-telemetry lakehouse analytics on Spark.

Raw API snapshots (bronze) are flattened into a typed flight mart (silver);
gold products are the latest snapshot and per-country hourly analytics.
Everything is expressed with DataFrame / SQL / Structured Streaming built-ins.
"""

from contrail.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
