"""Run registered queries in Spark and their DuckDB SQL side by side and compare.

usage: python scripts/check_oracle.py [sf_dir] [name-substring ...]

MEEPLE_SCALE_PLANS=1 forces the plans a large cluster would run: no broadcast joins, no
adaptive re-planning, 64 shuffle partitions.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meeple.oracle import ORACLE  # noqa: E402
from meeple.registry import QUERIES  # noqa: E402
from meeple.session import local_session  # noqa: E402
from meeple.testing import compare, duck_connection  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    filters = [a for a in argv if not a.startswith("/")]
    spark = local_session()
    if os.environ.get("MEEPLE_SCALE_PLANS"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "64")
    con = duck_connection(sf_dir)
    failed = 0
    for name, fn in QUERIES.items():
        if filters and not any(f in name for f in filters):
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        if name not in ORACLE:
            n = df.count()
            print(json.dumps({"name": name, "rows": n, "oracle": None, "sec": round(time.time() - t0, 2)}))
            continue
        c = compare(name, df, con, ORACLE[name])
        failed += not c.ok
        print(json.dumps({
            "name": name, "ok": c.ok, "spark_rows": c.spark_rows, "duck_rows": c.duck_rows,
            "types_match": c.types_match, "notes": c.notes, "sec": round(time.time() - t0, 2),
        }, default=str))
    print(f"failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
