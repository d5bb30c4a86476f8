"""Run all or some registered queries against DuckDB: `python -m tests.run_oracles [sf] [prefix…]`."""

from __future__ import annotations

import sys
import traceback

import __spark_entry__ as entry
from tests.harness import compare, duck
from tidemill.session import build_session


def main(argv):
    sf = argv[0] if argv else "0.01"
    wanted = argv[1:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        "oracles", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions=8,
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles = entry.oracle_sql()
    bad = []
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            ok, text = compare(spark, sf_dir, name, fn, oracles.get(name), con)
        except Exception as err:
            ok, text = False, f"{type(err).__name__}: {str(err)[:1500]}"
            if wanted:
                traceback.print_exc(limit=4)
        mark = "ok  " if ok else "FAIL"
        kind = "oracle" if name in oracles else "rows"
        print(f"{mark} {name} [{kind}] {text[:900]}", flush=True)
        if not ok:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
