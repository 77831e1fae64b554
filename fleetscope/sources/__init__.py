"""Sources and sinks: the telemetry view, file readers/writers, ingest."""

from fleetscope.sources.fixture import read_table, raw_telemetry, train_telemetry  # noqa: F401
