"""Write PLANS.md: the physical plan of every registered query, plus the
plans inside the sink queries (whose returned frame is a plain read-back).

    python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tablepipe.operators.sinks import dedup_first, rows_to_append  # noqa: E402
from tablepipe.plans import queries  # noqa: E402
from tablepipe.plans._base import LINEITEM_COLS, table  # noqa: E402
from tablepipe.session import build_session  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue().strip()
    # shorten long file locations, keep everything else
    return "\n".join(ln if len(ln) < 1500 else ln[:1500] + " ..." for ln in text.splitlines())


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    out = ["# Physical plans", "",
           f"Generated by `scripts/show_plans.py` at `{sf}` (local[8], AQE on; plans are the initial",
           "adaptive plans). Read them for: `PushedFilters` / `ReadSchema` at the scans, `partial_`",
           "aggregates and `WindowGroupLimit ... Partial` before each `Exchange`, and no `Join` where",
           "none is needed.", ""]
    li = table(spark, sf, "lineitem")
    internal = {
        "conflict_append (inside): rows_to_append(batch, target keys)": rows_to_append(
            li, li.where(F.col("l_linenumber") <= 3), ["l_orderkey", "l_linenumber"], LINEITEM_COLS),
        "truncate_reload_dedup (inside): dedup_first": dedup_first(li, ["l_orderkey", "l_linenumber"],
                                                                    LINEITEM_COLS),
        "truncate_reload (inside): key check": table(spark, sf, "orders").select("o_orderkey")
        .groupBy("o_orderkey").count().agg(F.max("count")),
    }
    for name, fn in queries().items():
        out += [f"## {name}", "", "```", plan(fn(spark, sf)), "```", ""]
    for name, df in internal.items():
        out += [f"## {name}", "", "```", plan(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    spark.stop()
    print(f"wrote {path}")


if __name__ == "__main__":
    main()
