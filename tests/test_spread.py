"""The log is made from events in parallel, however few row groups their file has."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
from log_rows import T0

from auditlens.sources.bronze import BRONZE_COLS
from auditlens.sources.events_adapter import bronze_from_events, load_bronze, load_events, spread


def test_one_row_group_is_spread(spark, tmp_path):
    kinds = ("view", "click", "purchase", "signup", "error", None)
    n = 4000
    rows = {"event_id": [i % 3500 if i % 9 else None for i in range(n)],
            "ts": [T0 + dt.timedelta(seconds=i // 2) for i in range(n)],
            "user_id": [i % 37 for i in range(n)], "event_type": [kinds[i % 6] for i in range(n)],
            "value": [float(i % 400) for i in range(n)],
            "props": ['{"k": %d}' % (i % 90) if i % 7 else (None, "{}")[i % 2] for i in range(n)]}
    types = {"event_id": pa.int64(), "ts": pa.timestamp("us"), "user_id": pa.int64(), "value": pa.float64()}
    table = pa.table({c: pa.array(v, types.get(c, pa.string())) for c, v in rows.items()})
    pq.write_table(table, tmp_path / "events.parquet", row_group_size=n)
    events = load_events(spark, str(tmp_path))
    assert events.rdd.getNumPartitions() == 1
    parts = spread(events).rdd.glom().map(len).collect()
    assert sum(parts) == n and sum(p > 0 for p in parts) > 1
    stored = load_bronze(spark, str(tmp_path))
    want = bronze_from_events(events).select(*BRONZE_COLS)
    assert sorted(map(str, stored.select(*BRONZE_COLS).collect())) == sorted(map(str, want.collect()))
