"""Print the physical plans of the key registered queries (formatted), for review.

Usage: python tools/plans.py [sf_dir] > plans.txt
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEY = ["b08_build_features_lineitem", "m02_hourly_mean_baseline", "c03_chronological_order",
       "m12_cv_hourly_mean", "e19_box_count_by_weather", "e11_pearson_matrix", "m13_holdout_processed_table"]


def main():
    from cadence.plans.registry import QUERIES, load_all
    from cadence.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]")
    load_all()
    for q in KEY:
        df = QUERIES[q](spark, sf)
        print(f"===== {q}")
        print(df._jdf.queryExecution().executedPlan().toString())


if __name__ == "__main__":
    main()
