"""python tests/run_compare.py [sf_dir] [name ...]: every query against its oracle."""

import os
import sys
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from terrahaz.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session(), compare.duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            problem, rows, ts, td = compare.difference(spark, con, sf_dir, fn, oracles.get(name))
        except Exception as e:  # noqa: BLE001
            problem, rows, ts, td = f"{type(e).__name__}: {str(e)[:600]}", -1, 0.0, 0.0
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += problem is not None
        kind = "oracle" if name in oracles else "rows"
        print(f"{'BAD' if problem else 'ok '} {kind:6} {name:28} rows={rows:6} {ts:6.2f}s {td:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} bad of {len(queries)}")


if __name__ == "__main__":
    main()
