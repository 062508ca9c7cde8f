"""Print the formatted physical plan of registered queries (default: the bench headline set).

usage: python scripts/explain_plans.py [sf_dir] [name ...]
"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from homestat.plans.queries import queries  # noqa: E402
from homestat.session import build_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or HEADLINE
    spark = build_session("local[8]", app="homestat-explain", conf={"spark.sql.shuffle.partitions": "16",
                                                                   "spark.sql.maxMetadataStringLength": "400"})
    qs = queries()
    for name in names:
        print(f"===== {name}")
        qs[name](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
