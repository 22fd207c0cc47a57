"""Write PLANS.md: formatted physical plans of key catalog queries.

Usage: python scripts/plans.py [sf_dir]  (default /root/testdata/sf0.1)
Keeps the operator tree and, per scan, the pushed filters and read schema.
"""

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chronofeat.queries import QUERIES  # noqa: E402
from chronofeat.session import local_session  # noqa: E402

KEYS = ["pit_ttl", "pit_fused_views", "pit_hot_key", "pit_no_ttl", "pit_entityless_no_ttl",
        "pull_latest", "latest_per_key", "snapshot_lookup", "sort_rank", "sort_rank_payload", "pit_key_pruned",
        "pit_bucketed_source", "pit_burst_key", "pull_latest_date_col"]


def main():
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    out = ["# Physical plans of key queries", "",
           f"Generated by `scripts/plans.py` on `{d}` (local[8], AQE on; initial plans before "
           "runtime re-optimization). Scans list pushed filters and read schema.", ""]
    for k in KEYS:
        df = QUERIES[k](spark, d)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0]
        tree = tree.split("+- == Initial Plan ==")[-1] if "Initial Plan" in tree else tree
        scans = re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?ReadSchema: [^\n]+", text)
        out += [f"## {k}", "", "```", tree.strip("\n"), "```", ""]
        for s in scans:
            lines = [ln for ln in s.split("\n") if ln.startswith(("(", "PushedFilters", "ReadSchema",
                                                                     "PartitionFilters"))]
            out += ["```", *lines, "```", ""]
    open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") \
        .write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
