"""Write PLANS.md: physical-plan trees of representative queries (explain)."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from promo_engine.operators import features as FT  # noqa: E402
from promo_engine.plans import catalog as K  # noqa: E402
from promo_engine.plans import materialize as MZ  # noqa: E402
from promo_engine.plans import split as SP  # noqa: E402
from promo_engine.session import local_session  # noqa: E402


def tree(df, details=("PushedFilters", "PartitionFilters", "ReadSchema")) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    head, _, rest = text.partition("\n\n\n")
    keep = [ln for ln in rest.splitlines() if ln.startswith(details) or ln.startswith("(")]
    scans = [ln for ln in keep if "Scan" in ln or ln.startswith(details)]
    return head.strip() + "\n\n" + "\n".join(scans)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8)
    h, lab = K.fields(spark, sf)
    lab = FT.prepare_label_field(lab)
    user_specs = [s for s in FT.MAIN_SPECS if s.keys == ("user_id",)]
    sections = [
        ("Source: coupon rows for the split windows (filters pushed into both scans)",
         K.labelled(spark, sf, MZ.received_range(SP.ADAPTER_SPLITS))),
        ("Per-user feature block: one grouped aggregate over label + history rows, "
         "distinct counts as a separate two-level aggregate",
         FT.aggregate_block(lab, h, ("user_id",), user_specs)),
        ("Assembled dataset after the chain tables are written: 4 joins + de-duplication",
         K.QUERIES["dataset_assembled"](spark, sf)),
        ("Distance to class centroid: written centroid table, broadcast by its real size",
         K.QUERIES["centroid_distance"](spark, sf)),
        ("Report: received vs cheap-label rows per rate (partial aggregation before the exchange)",
         K.QUERIES["received_vs_label_by_rate"](spark, sf)),
    ]
    out = ["# Physical plans of representative queries",
           "",
           f"Generated by `python tools/plans_doc.py` at `{sf}` (local[8]); initial AQE plans "
           "(AQE may still switch a sort-merge join to a broadcast join at run time).",
           ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", tree(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
