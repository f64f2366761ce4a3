"""Print the formatted physical plan of registered queries.

usage: python scripts/explain.py [sf_dir] name [name ...]

MEEPLE_SCALE_PLANS=1 shows the plans of a large cluster (no broadcast joins, no adaptive
re-planning), as in ``check_oracle.py``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meeple.registry import QUERIES  # noqa: E402
from meeple.session import local_session  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")]
    unknown = [n for n in names if n not in QUERIES]
    if not names or unknown:
        print(f"unknown {unknown}; choose from: {', '.join(sorted(QUERIES))}")
        return 2
    spark = local_session()
    if os.environ.get("MEEPLE_SCALE_PLANS"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
    for name in names:
        print(f"== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
