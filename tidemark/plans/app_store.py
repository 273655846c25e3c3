"""App-store activity: apps over a threshold and what each store saw first."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import triggers as G
from tidemark.plans.inputs import MINUTE, ORDER, events, with_events
from tidemark.plans.registry import report

INSTALL, UNINSTALL = "purchase", "error"
INSTALLS, UNINSTALLS = 10, 5

_BEFORE = """OVER (PARTITION BY store, user_id ORDER BY ms, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
_FIRED = f"""b AS (
  SELECT *, count(CASE WHEN event_type = '{INSTALL}' THEN 1 END) {_BEFORE} AS installs_before,
    count(CASE WHEN event_type = '{UNINSTALL}' THEN 1 END) {_BEFORE} AS uninstalls_before FROM e),
f AS (SELECT * FROM b WHERE installs_before >= {INSTALLS} OR uninstalls_before >= {UNINSTALLS})"""
_COLUMNS = ["event_id", "store", "user_id", "installs_before", "uninstalls_before"]


def _fired(rows, **options):
    return G.over_threshold(
        rows, "store", "user_id", ORDER, F.col("event_type"),
        INSTALL, UNINSTALL, INSTALLS, UNINSTALLS, **options,
    )


def _rows(spark, folder):
    return events(spark, folder).select("event_id", "ms", "store", "user_id", "event_type")


@report(with_events(f"SELECT {', '.join(_COLUMNS)} FROM f", _FIRED))
def threshold_trigger(spark, folder):
    """Every event of an app that is over a threshold already."""
    return _fired(_rows(spark, folder)).select(*_COLUMNS)


@report(
    with_events(
        f"SELECT {', '.join(_COLUMNS)} FROM f WHERE event_type IN ('{INSTALL}', '{UNINSTALL}')",
        _FIRED,
    )
)
def threshold_trigger_typed(spark, folder):
    """Only installs and uninstalls fire."""
    types = [INSTALL, UNINSTALL]
    return _fired(_rows(spark, folder), fire_types=types).select(*_COLUMNS)


@report(
    with_events(
        f"""SELECT {', '.join(_COLUMNS)} FROM (SELECT *, row_number() OVER (
  PARTITION BY store, user_id ORDER BY ms, event_id) AS r FROM f) t WHERE r = 1""",
        _FIRED,
    )
)
def threshold_crossings(spark, folder):
    """The first firing of each app."""
    return _fired(_rows(spark, folder), edge_only=True).select(*_COLUMNS)


def _first_sql(event_type: str, n: int) -> str:
    return f"""(SELECT string_agg(CAST(r.user_id AS VARCHAR), ', ' ORDER BY r.ms, r.event_id)
    FROM r WHERE r.store = f.store AND r.event_type = '{event_type}'
      AND (r.ms < f.ms OR (r.ms = f.ms AND r.event_id <= f.event_id)))"""


@report(
    with_events(
        f"""SELECT event_id, store, user_id,
  coalesce({_first_sql(INSTALL, 3)}, '') AS first_{INSTALL},
  coalesce({_first_sql(UNINSTALL, 3)}, '') AS first_{UNINSTALL} FROM f""",
        _FIRED,
        """r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store, event_type
    ORDER BY ms, event_id) AS k FROM e) t WHERE k <= 3)""",
    )
)
def app_store_report(spark, folder):
    """On each firing: the first three apps installed and uninstalled so far."""
    rows = _rows(spark, folder)
    fired = _fired(rows)
    return G.first_apps_so_far(
        fired, rows, "store", "user_id", ORDER, "event_type", [INSTALL, UNINSTALL]
    ).select("event_id", "store", "user_id", f"first_{INSTALL}", f"first_{UNINSTALL}")


_ARRIVED = f"""a AS (SELECT *, ms + ((event_id * 7919) % 13) * {5 * MINUTE} AS arrival FROM e)"""
_BEFORE_ARRIVAL = _BEFORE.replace("ORDER BY ms", "ORDER BY arrival")
_FIRED_ON_ARRIVAL = _FIRED.replace(_BEFORE, _BEFORE_ARRIVAL).replace("FROM e)", "FROM a)")


def _first_arrived_sql(event_type: str) -> str:
    return f"""coalesce((SELECT string_agg(CAST(user_id AS VARCHAR), ', ' ORDER BY k) FROM t
    WHERE t.event_id = f.event_id AND t.event_type = '{event_type}'), '')"""


@report(
    with_events(
        f"""SELECT event_id, store, user_id,
  {_first_arrived_sql(INSTALL)} AS first_{INSTALL}, {_first_arrived_sql(UNINSTALL)} AS first_{UNINSTALL} FROM f""",
        _ARRIVED,
        _FIRED_ON_ARRIVAL,
        f"""t AS (SELECT * FROM (SELECT f.event_id, a.event_type, a.user_id, row_number() OVER (
    PARTITION BY f.event_id, a.event_type ORDER BY a.ms, a.arrival, a.event_id) AS k
  FROM f JOIN a ON a.store = f.store AND a.event_type IN ('{INSTALL}', '{UNINSTALL}')
    AND (a.arrival < f.arrival OR (a.arrival = f.arrival AND a.event_id <= f.event_id))) x WHERE k <= 3)""",
    )
)
def app_store_out_of_order(spark, folder):
    """As events arrive in a shuffled order: the first three by event time so far."""
    delay = F.pmod(F.col("event_id") * 7919, F.lit(13)) * (5 * MINUTE)
    rows = _rows(spark, folder).withColumn("arrival", F.col("ms") + delay)
    arrival = ["arrival", "event_id"]
    fired = G.over_threshold(
        rows, "store", "user_id", arrival, F.col("event_type"), INSTALL, UNINSTALL, INSTALLS, UNINSTALLS,
    ).select("event_id", "arrival", "store", "user_id")
    return G.first_apps_so_far(
        fired, rows, "store", "user_id", arrival, "event_type", [INSTALL, UNINSTALL], event_time=["ms"]
    ).select("event_id", "store", "user_id", f"first_{INSTALL}", f"first_{UNINSTALL}")
