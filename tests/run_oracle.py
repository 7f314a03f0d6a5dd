"""Run every registered query against its oracle: python -m tests.run_oracle [sf_dir] [names]."""

import sys
import time

from vigil.session import get_spark

sys.path.insert(0, ".")
import __spark_entry__ as E  # noqa: E402
from tests.oracle import compare, duck  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_spark("oracle", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        if name not in sql:
            try:
                n = fn(spark, sf).count()
                print(f"{name}: rows-only {n} rows ({time.time()-t:.1f}s)")
            except Exception as e:  # noqa: BLE001
                bad += 1
                print(f"{name}: ERROR {type(e).__name__}: {str(e)[:300]}")
            continue
        try:
            ok, msg = compare(spark, sf, name, fn, sql[name], con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{msg} ({time.time()-t:.1f}s)", flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
