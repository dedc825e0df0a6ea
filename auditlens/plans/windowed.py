"""The registered queries over a real time window.

``<key>_window`` runs a tile with its own default arguments (lookback and bin,
now = the newest event), and a detector or metric table over the last seven
days with sessions of the last 24 hours. The oracle is the whole-history SQL
over a log that is cut to the window.
"""

from __future__ import annotations

import inspect
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from auditlens.functions.timefn import seconds
from auditlens.operators import alerts as A
from auditlens.operators import dashboards as Q
from auditlens.operators import detectors as D
from auditlens.operators import metrics as M
from auditlens.operators.sessions import session_info
from auditlens.plans import oracle as O
from auditlens.plans.profile import HUNT
from auditlens.plans.registry import _DASHBOARDS, _DETECTORS, display
from auditlens.sources.events_adapter import load_bronze

TS = "EventProcessedUtcTime"
WEEK, DAY = "7d", "24h"
#: Where the session lookup of the oracle reads the log.
SESSION_LOG = "AS h\n        FROM bronze WHERE"


def default_lookback(fn) -> str:
    return inspect.signature(fn).parameters["lookback"].default


def cut_log(sql: str, lookback: str, session_lookback: str | None = None, align: int | None = None) -> str:
    """The SQL with ``bronze`` cut to the last ``lookback`` (and the session
    lookup's log to the last ``session_lookback``)."""
    start = lambda span: f"(SELECT max({TS}) FROM whole_log) - INTERVAL {seconds(span)} SECOND"
    first = start(lookback)
    if align:
        first = f"time_bucket(INTERVAL {align} SECOND, {first}, TIMESTAMP '1970-01-01')"
    cut = f",\nbronze AS (SELECT * FROM whole_log WHERE {TS} >= {first})"
    if session_lookback:
        sql = sql.replace(SESSION_LOG, SESSION_LOG.replace("bronze", "session_log"))
        cut += f",\nsession_log AS (SELECT * FROM whole_log WHERE {TS} >= {start(session_lookback)})"
    return re.sub(r"\nbronze AS \((.*?\n  FROM ev2\n)\)", lambda m: f"\nwhole_log AS ({m[1]}){cut}", sql, flags=re.S)


def cut_metrics(sql: str, lookback: str) -> str:
    """The SQL with the activity metrics ``am`` cut to the last ``lookback``."""
    head, tail = sql.split("\nam AS (", 1)
    name = "CAST(dayofweek(EventProcessedUtcTime) AS INTEGER))"
    body, rest = tail.rsplit(name, 1)
    return (f'{head}\nevery_am AS ({body}{name},\nam AS (SELECT * FROM every_am WHERE "Timestamp" >= '
            f'(SELECT max("Timestamp") FROM every_am) - INTERVAL {seconds(lookback)} SECOND){rest}')


def _tile(fn) -> Callable:
    return lambda spark, sf_dir: display(fn(load_bronze(spark, sf_dir)))


def _metric_tile(fn) -> Callable:
    return lambda spark, sf_dir: display(fn(M.activity_metrics(load_bronze(spark, sf_dir))))


def _detector(fn, key: str) -> Callable:
    kw = {k: {"lookback": WEEK, "session_lookback": DAY}.get(k, v) for k, v in HUNT[key].items()}
    return lambda spark, sf_dir: display(fn(load_bronze(spark, sf_dir), **kw))


def _anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = {k: {n: {"lookback": WEEK, "session_lookback": DAY}.get(n, v) for n, v in HUNT[k].items()}
              for k in A.UNION_KINDS}
    return A.anomalies_all(load_bronze(spark, sf_dir), params=params)


def _backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    from auditlens.config import shared_dir
    path = shared_dir(spark, "activity_metrics")
    return M.activity_backfill(spark, load_bronze(spark, sf_dir), path, lookback=WEEK).drop("metric_date")


METRIC_TILES = {"metrics_stats": Q.metrics_stats, "history_depth": Q.history_depth,
                "privilege_offhours": D.privilege_offhours}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {f"{k}_window": _tile(fn) for k, (fn, _) in _DASHBOARDS.items()}
    out |= {f"{k}_window": _metric_tile(fn) for k, fn in METRIC_TILES.items()}
    out |= {f"{k}_window": _detector(fn, k) for k, fn in _DETECTORS.items()}
    out["anomalies_all_window"] = _anomalies
    out["session_info_window"] = _tile(session_info)
    out["user_metrics_window"] = lambda spark, sf_dir: M.user_metrics(load_bronze(spark, sf_dir), lookback=WEEK)
    out["activity_backfill_window"] = _backfill
    return out


def oracle_sql(whole: dict[str, str]) -> dict[str, str]:
    """From the whole-history SQL of the same keys."""
    out = {f"{k}_window": cut_log(whole[k], default_lookback(fn)) for k, (fn, _) in _DASHBOARDS.items()}
    out |= {f"{k}_window": cut_metrics(whole[k], default_lookback(fn)) for k, fn in METRIC_TILES.items()}
    for k in [*_DETECTORS, "anomalies_all"]:
        out[f"{k}_window"] = cut_log(whole[k], WEEK, DAY)
    out["session_info_window"] = cut_log(O.session_info_sql(), default_lookback(session_info))
    out["user_metrics_window"] = cut_log(whole["user_metrics"], WEEK, DAY)
    out["activity_backfill_window"] = cut_log(whole["activity_backfill"], WEEK, align=300)
    return out
