"""Write the formatted physical plan of every registered query to a folder.

Usage: python tools/explain_all.py [sf_dir] [out_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeloom.plans.index import QUERIES  # noqa: E402
from lakeloom.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else "/tmp/lakeloom-plans"
    os.makedirs(out, exist_ok=True)
    spark = build_session()
    for name, (fn, _sql) in sorted(QUERIES.items()):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf_dir).explain("formatted")
        with open(os.path.join(out, f"{name}.txt"), "w") as fh:
            fh.write(buf.getvalue())
        nodes = re.findall(r"^[\s+\-:|]*([A-Za-z]+)(?: [A-Za-z]+)* \(\d+\)\s*$", buf.getvalue(), flags=re.M)
        count = lambda *ns: sum(1 for n in nodes if n in ns)
        print(f"{name}: shuffles={count('Exchange')} broadcasts={count('BroadcastExchange')} "
              f"smj={count('SortMergeJoin')} bhj={count('BroadcastHashJoin')} "
              f"python={count('MapInPandas', 'ArrowEvalPython', 'BatchEvalPython')}")
    spark.stop()


if __name__ == "__main__":
    main()
