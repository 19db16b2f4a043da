"""``python -m wayfare RAW CURATED OUT [--overall] [--taxi-share S] [--bike-share S]``."""

import argparse

from wayfare.plans import process
from wayfare.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="wayfare")
    parser.add_argument("raw")
    parser.add_argument("curated")
    parser.add_argument("out")
    parser.add_argument("--overall", action="store_true", help="one table per mode instead of the merged one")
    parser.add_argument("--taxi-share", type=float, default=1.0)
    parser.add_argument("--bike-share", type=float, default=1.0)
    given = parser.parse_args()
    spark = build_session()
    lost: dict[str, int] = {}
    print(process.clean_all(spark, given.raw, given.curated, lost=lost))
    print("values that did not parse:", {column: n for column, n in lost.items() if n})
    shares = {"taxi_share": given.taxi_share, "bike_share": given.bike_share}
    print(process.process_all(spark, given.raw, given.curated, given.out, given.overall, **shares))
    spark.stop()


if __name__ == "__main__":
    main()
