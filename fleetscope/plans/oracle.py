"""DuckDB oracle SQL for every registered query.

Each statement starts with the fixture CTE (the same telemetry views the
Spark side derives from ``events``) and ends with one SELECT whose column
names and types match the Spark result.
"""

from __future__ import annotations

from fleetscope.schema import SPEED_EDGES, SPEED_LABELS

FIXTURE_CTE = """
base AS (
  SELECT event_id, user_id, event_type, value,
         date_trunc('second', ts) AS ts_s,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
         CAST(round(value * 100) AS BIGINT) AS c,
         CASE WHEN event_id % 33 = 0 THEN 0e0 ELSE least(300e0, value * 3) END AS spd
  FROM events),
shaped AS (
  SELECT event_id,
    concat('TRN-', CAST(user_id AS VARCHAR)) AS train_id,
    concat('TWR-', CAST((user_id + k) % 8 AS VARCHAR)) AS cell_tower_id,
    CAST(ts_s AS TIMESTAMP) AS timestamp,
    CASE WHEN event_id % 20 = 7 THEN NULL WHEN event_id % 100 = 3 THEN 999e0 ELSE 40 + k * 3 / 7e0 END AS temp_celsius,
    CASE WHEN event_type = 'error' AND (user_id % 10 = 0 OR event_id % 10 = 0) THEN 'CRITICAL'
         WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 'WARNING' ELSE 'OK' END AS status,
    spd AS speed_kmh,
    45.3e0 + (c % 3000) / 10007e0 AS latitude,
    9e0 + (c % 2999) / 10007e0 AS longitude,
    greatest(-110e0, least(-40e0, -40 - (c % 60) - 3 * (event_id % 4) - spd / 31e0)) AS signal_strength_dbm,
    CASE event_id % 4 WHEN 0 THEN 'SEG-A' WHEN 1 THEN 'SEG-B' WHEN 2 THEN 'SEG-C' ELSE 'SEG-D' END AS line_segment,
    CASE WHEN (k * 7 + user_id) % 100 < 40 THEN '5G' WHEN (k * 7 + user_id) % 100 < 80 THEN '4G'
         WHEN (k * 7 + user_id) % 100 < 90 THEN '3G' WHEN (k * 7 + user_id) % 100 < 95 THEN 'EDGE'
         ELSE 'OFFLINE' END AS network_type,
    5 * (value * 3 + 150 + (k - 50) * 20 / 7e0) AS power_consumption_kw
  FROM base),
raw_telemetry AS (
  SELECT * FROM shaped UNION ALL SELECT * FROM shaped WHERE event_id % 50 = 11),
train_telemetry AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY train_id, timestamp ORDER BY event_id) AS rn FROM raw_telemetry) z
  WHERE rn = 1)
"""


def with_fixture(select: str, extra_ctes: str = "") -> str:
    """Prefix ``select`` with the fixture CTE (and optional further CTEs)."""
    ctes = FIXTURE_CTE.rstrip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return "WITH " + ctes.strip() + "\n" + select.strip()


def band_sql(x: str, null_to_last: bool = True) -> str:
    """The speed bands of ``schema`` as a CASE over ``x``."""
    whens = " ".join(f"WHEN {x} <= {e} THEN '{label}'" for e, label in zip(SPEED_EDGES, SPEED_LABELS))
    null = "" if null_to_last else f"WHEN {x} IS NULL THEN NULL "
    return f"CASE {null}{whens} ELSE '{SPEED_LABELS[-1]}' END"
