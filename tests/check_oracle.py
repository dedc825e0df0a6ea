"""Manual driver-style check: python tests/check_oracle.py [sf_dir] [key...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import duck, duck_digest, first_diff, spark_digest  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from auditlens import get_spark  # noqa: E402


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN",
                 "date": "DATE"}


def spark_types(df):
    return {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema.fields}


def duck_types(con, sql):
    rel = con.sql(sql)
    return {n: str(t) for n, t in zip(rel.columns, rel.types)}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for k in (keys or list(qs)):
        t = time.time()
        df = qs[k](spark, sf_dir)
        a = spark_digest(df)
        if k not in sql:
            print(f"{k:28s} rows={a[0]:6d} (no oracle) {time.time()-t:.1f}s")
            continue
        try:
            b = duck_digest(con, sql[k])
        except Exception as ex:  # noqa: BLE001
            print(f"{k:28s} ORACLE ERROR {ex}")
            bad += 1
            continue
        types_ok = spark_types(df) == duck_types(con, sql[k])
        ok = a == b and types_ok
        bad += not ok
        print(f"{k:28s} rows={a[0]:6d}/{b[0]:6d} cols={'ok' if a[1] == b[1] else 'DIFF'} "
              f"types={'ok' if types_ok else 'DIFF'} hash={'ok' if a[2] == b[2] else 'DIFF'} {time.time()-t:.1f}s")
        if a[1] != b[1]:
            print("   spark:", a[1], "\n   duck: ", b[1])
        elif not ok:
            sa, sb = first_diff(df, con, sql[k])
            print("   spark-only:", sa[:2], "\n   duck-only: ", sb[:2])
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
