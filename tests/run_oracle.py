"""Run registered queries against their DuckDB oracles.

    python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import compare, duck_connect, fmt  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from ledgerlake.session import local_session  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")]
    spark = local_session(8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck_connect(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        t = time.time()
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print(f"{name}: rows-only {df.count()} ({time.time() - t:.1f}s)", flush=True)
            continue
        try:
            res = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name}: ERROR {type(e).__name__}: {str(e)[:800]}", flush=True)
            continue
        bad += 0 if res["ok"] else 1
        print(("OK   " if res["ok"] else "FAIL ") + fmt(res) + f" ({time.time() - t:.1f}s)", flush=True)
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
