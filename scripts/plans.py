"""Write PLANS.md: physical plans of the headline queries (explain formatted).

Usage: python scripts/plans.py [sf_dir]
Shows the operator tree and, for each scan, pushed / partition filters and the
read schema - the facts the scale review relies on.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from contrail import get_session, work_dir  # noqa: E402
from contrail.operators import backfill as bf, hourly as hr, latest as lt, serving as sv  # noqa: E402
from contrail.plans import catalog, params as P  # noqa: E402

KEEP = re.compile(r"^\(\d+\) (Scan|BroadcastHashJoin|Exchange|HashAggregate|Generate|Window|Sort)|"
                  r"^(PushedFilters|PartitionFilters|ReadSchema|Keys|Functions|Arguments|Condition)")


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n")
    kept = [ln if len(ln) < 400 else ln[:400] + " ..." for ln in details.splitlines() if KEEP.search(ln)]
    return tree.strip() + "\n\n" + "\n".join(kept)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    root = f"{work_dir(spark, 'plans')}/mart"
    bf.backfill(spark, catalog._bronze(spark, sf), root)
    mart = bf.read_mart(spark, root)
    hourly = hr.hourly(mart)
    items = [
        ("flatten (bronze -> mart)", catalog.flatten_states(spark, sf),
         "JSON parsed once, explode, positional casts: no exchange after the snapshot build."),
        ("hourly_prev on the stored mart", hr.hourly_previous(bf.read_positions(spark, root, *hr.hour_bounds(P.AS_OF)), P.AS_OF),
         "The zone map turns the hour range into upload dates (PartitionFilters); hour range and airborne filter pushed to Parquet; ReadSchema has only the 6 needed columns; "
         "distinct count in two phases."),
        ("hourly_all on the stored mart", hourly, "Same two-phase aggregate, no range."),
        ("latest snapshot (newest day folder)", lt.latest_by_watermark(bf.read_latest_day(spark, root)),
         "PartitionFilters select one upload_date; the max subquery is pushed to the scan."),
        ("latest by rank", lt.latest_by_rank(bf.read_top_load(spark, root)),
         "One folder by its zone. Max subquery + pushed equality filter: no Window, no sort."),
        ("country day with total", catalog.country_day_total(spark, sf),
         "Reads the exported hours: the date is a partition filter."),
        ("lenient casts", catalog.cast_lenient(spark, sf), "Narrow projection; no Python."),
    ]
    out = ["# Physical plans of the headline queries",
           "",
           f"Generated by `scripts/plans.py` on {os.path.basename(sf)} ({datetime.now():%Y-%m-%d}).",
           "Mart = the stored silver table (partitioned by upload_date).", ""]
    for title, df, note in items:
        out += [f"## {title}", "", note, "", "```", formatted(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
