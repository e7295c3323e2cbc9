"""Write the formatted physical plans of the relational queries to
docs/plans.md (model queries are left out: they fit models when built).

    python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from roomrate.plans.catalog import QUERIES  # noqa: E402
from roomrate.plans.oracle import ORACLE  # noqa: E402
from roomrate.session import build_session  # noqa: E402

SKIP = {"stage_roundtrip", "delimited_roundtrip"}   # write files when built


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    out = ["# Physical plans", "",
           f"`explain('formatted')` of every relational query on `{sf_dir}` "
           "(before AQE re-planning at run time). Generated by `tools/dump_plans.py`.", ""]
    for name in sorted(ORACLE):
        if name in SKIP:
            continue
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf_dir).explain("formatted")
        out += [f"## {name}", "", "```", buf.getvalue().strip(), "```", ""]
    os.makedirs(os.path.join(ROOT, "docs"), exist_ok=True)
    with open(os.path.join(ROOT, "docs", "plans.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
