"""SQL surface: the log, the metric tables and the anomaly feed as temp views.

The reference exposes its transforms as zero-argument stored functions
that queries call by name. In Spark the same is a temp view over the
DataFrame function: ``spark.sql("SELECT ... FROM activity_metrics")`` plans
through Catalyst exactly like the DataFrame call (views are lazy; nothing is
materialised by registering them). ``register_functions`` adds the parametrised form, SQL
table functions of a lookback in hours: ``SELECT * FROM recent_errors(24)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from auditlens.functions.timefn import TS, resolve_as_of
from auditlens.operators import alerts as A
from auditlens.operators import metrics as M

VIEWS = ("bronze_logs", "activity_metrics", "error_metrics", "user_metrics", "anomalies")


def register_views(spark: SparkSession, bronze: DataFrame, *, as_of=None,
                   anomaly_params: dict | None = None) -> tuple[str, ...]:
    """Register the standard views over ``bronze``; returns their names."""
    bronze.createOrReplaceTempView("bronze_logs")
    M.activity_metrics(bronze).createOrReplaceTempView("activity_metrics")
    M.error_metrics(bronze).createOrReplaceTempView("error_metrics")
    M.user_metrics(bronze, as_of=as_of, session_lookback=None if as_of is None else "24h"
                   ).createOrReplaceTempView("user_metrics")
    A.anomalies_union(bronze, as_of=as_of, params=anomaly_params).createOrReplaceTempView("anomalies")
    return VIEWS


# table function -> (view, its time column, partition column that may be pruned)
FUNCTIONS = {"recent_logs": ("bronze_logs", TS, "event_date"),
             "recent_activity": ("activity_metrics", "Timestamp", None),
             "recent_errors": ("error_metrics", "Timestamp", None),
             "recent_users": ("user_metrics", "Timestamp", None),
             "recent_anomalies": ("anomalies", "TimeGenerated", None)}


def register_functions(spark: SparkSession, bronze: DataFrame, *, as_of=None,
                       anomaly_params: dict | None = None) -> tuple[str, ...]:
    """Register the views and, over them, table functions of a lookback in hours before
    "now" (``as_of``; None: the newest event, found once). An empty log has no rows to return.

    The lookback is an argument, so it is a literal of the plan and reaches the scan as a
    pushed filter, on the partition column as well.
    """
    register_views(spark, bronze, as_of=as_of, anomaly_params=anomaly_params)
    now = resolve_as_of(bronze, as_of)
    now = "NULL" if now is None else f"'{now.replace(tzinfo=None).isoformat(sep=' ')}'"
    for name, (view, ts, part) in FUNCTIONS.items():
        schema = spark.table(view).schema
        from_ = f"CAST({now} AS {schema[ts].dataType.simpleString()}) - make_interval(0, 0, 0, 0, hours)"
        prune = f" AND {part} >= CAST({from_} AS DATE)" if part in schema.fieldNames() else ""
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(hours INT COMMENT 'lookback') RETURNS TABLE "
                  f"RETURN SELECT * FROM {view} WHERE {ts} >= {from_}{prune}")
    return tuple(FUNCTIONS)
