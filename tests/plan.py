"""Print the final plan of registered queries: python tests/plan.py sf_dir name..."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import queries
from medvoice.session import build_session


def final_plan(df) -> str:
    """The plan after adaptive execution; runs the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    spark = build_session("plan", "local[8]", 8, {"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:]:
        start = time.time()
        plan = final_plan(queries()[name](spark, sys.argv[1]))
        print(f"== {name} {time.time() - start:.2f}s\n{plan}")


if __name__ == "__main__":
    main()
