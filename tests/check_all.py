"""Compare registered queries with their SQL: python tests/check_all.py [folder] [names...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from tallyloom.session import local_session
from tests.harness import difference, duck

if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:]
    queries, statements = entry.queries(), entry.oracle_sql()
    if names:
        queries = {k: v for k, v in queries.items() if any(k.startswith(n) for n in names)}
    if os.environ.get("CHECK_PLAIN"):  # no adaptive execution, no automatic broadcast
        spark = local_session(4, **{
            "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"})
    else:
        spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    bad = 0
    for name, build in queries.items():
        begin = time.time()
        try:
            frame = build(spark, folder).toPandas()
            spent = time.time() - begin
            if name not in statements:
                print(f"ROWS {name} {len(frame)} {spent:.1f}s\n{frame.head(5).to_string()}", flush=True)
                continue
            begin = time.time()
            expected = con.execute(statements[name]).df()
            sql_spent = time.time() - begin
            problem = difference(frame, expected)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem, spent, sql_spent, frame = str(error)[:900], time.time() - begin, 0, []
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} rows={len(frame)} {spent:.1f}s sql={sql_spent:.1f}s"
              + ("" if problem is None else f"\n     {problem}"), flush=True)
    print("bad:", bad, "of", len(queries))
