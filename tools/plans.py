"""Write PLANS.md: physical plan tree of the headline queries plus every
scan's pushed filters and read schema (from ``explain("formatted")``).

usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sharelens.operators.staging import stage_metadata  # noqa: E402
from sharelens.plans import QUERIES, linkage_queries  # noqa: E402
from sharelens.session import get_spark  # noqa: E402

SHOWN = ["daily_share", "link_tracks", "e2e_share", "missing_keys", "rolling_signals", "lead_lag", "series_describe",
         "corr_matrix", "classify_rules", "html_table"]


def parts(spark, sf_dir):
    """Frames that a query writes as checkpoints before its last plan, which reads them."""
    charts, meta = linkage_queries.charts(spark, sf_dir), linkage_queries.metadata(spark, sf_dir)
    yield "e2e_share, checkpoint 1: charts by day and title", charts.groupBy("chart_date", "artist_and_title").agg(
        F.sum("streams"), F.count(F.lit(1)))
    yield "e2e_share, checkpoint 2: staged metadata", stage_metadata(meta)


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> str:
    tree = text.split("\n\n\n")[0].strip()
    scans = []
    for block in re.split(r"\n\(\d+\) ", text):
        if block.startswith("Scan parquet"):
            fields = dict(re.findall(r"^(Location|PushedFilters|ReadSchema|PartitionFilters): (.*)$", block, re.M))
            loc = fields.get("Location", "").rsplit("/", 1)[-1].rstrip("]")
            scans.append(f"- `{loc}` pushed: {fields.get('PushedFilters', '[]')}; "
                         f"read: `{fields.get('ReadSchema', '')}`")
    return tree, scans


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("plans", shuffle_partitions=16)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/plans.py` at `{sf_dir}` before execution (AQE may still switch a",
           "sort-merge join to a broadcast join at run time).  Graph queries run one plan per BFS",
           "level and are not shown.  `Scan ExistingRDD` reads a checkpoint.", ""]
    shown = [*parts(spark, sf_dir), *((f"{n} ({QUERIES[n].ids})", QUERIES[n].build(spark, sf_dir)) for n in SHOWN)]
    for title, df in shown:
        tree, scans = summarize(formatted(df))
        out += [f"## {title}", "", "```", tree, "```", "", *scans, ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
