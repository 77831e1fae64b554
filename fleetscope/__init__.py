"""fleetscope: fleet-telemetry analytics as lazy Spark plans.

Sub-packages
------------
sources    -- readers/writers, the telemetry view over the driver tables, idempotent ingest
functions  -- Column-expression builders (bands, flags, clip, keys, seeded hash fractions)
operators  -- DataFrame -> DataFrame building blocks (keep-first, previous-row lag, rates, ...)
plans      -- the eleven reports, their dataframe-semantics variants, the BI mart, the manifest
streaming  -- the idempotent load expressed as a Structured Streaming query
"""

from fleetscope.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
