"""Print the physical operator tree of registered queries (as planned, before AQE re-planning).

    python tools/plans.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.plans.catalog import QUERIES  # noqa: E402
from kestrel.session import local_session  # noqa: E402


def operator_tree(df) -> str:
    """The tree part of ``explain("formatted")`` (without the per-node details)."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    lines = text.splitlines()
    start = lines.index("== Physical Plan ==") + 1
    end = lines.index("", start)
    return "\n".join(lines[start:end])


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(cores=8)
    for name in names:
        print(f"#### {name}\n\n```\n{operator_tree(QUERIES[name](spark, sf_dir))}\n```\n", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
