"""Write PLANS.md: the physical operators of the headline queries.

Run: python tests/plan_summary.py [sf_dir]. Plans are the static ones (AQE off) so
exchanges, aggregates and exchange reuse are shown as planned.
"""

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sensorstream.session import local_session  # noqa: E402

import __spark_entry__ as E  # noqa: E402

HEADLINE = ["first_alert", "archive_json", "latest_per_sensor", "recent_window", "incident_counts",
            "incident_sessions", "alert_gaps", "control_state"]
KEEP = re.compile(r"(Exchange|Reused|Aggregate|Window|Join|FlatMap|Generate|Scan|Subquery|Sort \[|Filter)")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tests/plan_summary.py` on `{os.path.basename(sf_dir)}` with AQE off (static plans).",
           "Only exchanges, aggregates, windows, joins, generators, Python operators, filters and scans are listed;",
           "long expressions are cut.", ""]
    for name in HEADLINE:
        df = E.queries()[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [re.sub(r"#\d+L?", "", ln.rstrip())[:160] for ln in plan.split("\n") if KEEP.search(ln)]
        out += [f"## {name}", "", "```", *lines, "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w", encoding="utf-8") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
