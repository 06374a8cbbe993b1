"""Run registered queries against their SQL at one scale: python tests/check.py [sf] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricelake.plans.catalog import ORACLES, QUERIES
from pricelake.session import local_session
from tests.oracle import connect, duck_rows, spark_rows, type_mismatches


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    prefixes = tuple(sys.argv[2:])
    names = [n for n in QUERIES if not prefixes or n.startswith(prefixes)]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session("8", 8)
    spark.sparkContext.setLogLevel("ERROR")
    duck = connect(sf_dir)
    bad = []
    for name in names:
        begin = time.time()
        try:
            frame = QUERIES[name](spark, sf_dir)
            columns, rows = spark_rows(frame)
            spent = time.time() - begin
            if name not in ORACLES:
                print(f"rows {name}: {sum(rows.values())} rows {spent:.2f}s")
                continue
            expected_columns, expected = duck_rows(duck, ORACLES[name])
            if columns != expected_columns:
                raise AssertionError(f"columns {columns} != {expected_columns}")
            if rows != expected:
                extra, missing = rows - expected, expected - rows
                raise AssertionError(
                    f"{sum(rows.values())} vs {sum(expected.values())} rows, differ "
                    f"{sum(extra.values())}/{sum(missing.values())}\n  {columns}"
                    f"\n  spark {sorted(extra, key=repr)[:2]}\n  duck  {sorted(missing, key=repr)[:2]}"
                )
            mixed = type_mismatches(frame, duck, ORACLES[name])
            if mixed:
                print(f"  types {name}: {mixed}")
            print(f"ok   {name}: {sum(rows.values())} rows {spent:.2f}s")
        except Exception as error:  # noqa: BLE001
            bad.append(name)
            print(f"BAD  {name}: {type(error).__name__} {str(error)[:1500]}")
        sys.stdout.flush()
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
