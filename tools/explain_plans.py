"""Print the formatted physical plan of registered queries (no execution beyond planning).

usage: python tools/explain_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.plans.registry import load_all  # noqa: E402
from tidewater.session import build_session  # noqa: E402

DEFAULT = ["risk_severity_matrix", "upsert_by_key", "top_phrases", "cluster_summary", "scan_filtered",
           "unprocessed", "mean_vector"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = build_session()
    reg = load_all()
    for n in names:
        print(f"===== {n}")
        reg[n].run(spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
