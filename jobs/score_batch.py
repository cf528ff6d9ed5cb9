"""Score a batch of listings and replace the published table.

    spark-submit --py-files lotwise.zip jobs/score_batch.py \
        --input s3a://feeds/listings/ --output s3a://tables/market/
    spark-submit ... --format bigquery --option table=project.dataset.table
"""

from __future__ import annotations

import argparse
import uuid

from lotwise.operators.tables import overwrite_table
from lotwise.plans.scoring import clean_batch, published, score_batch
from lotwise.schema import CURRENT_YEAR
from lotwise.session import build_session, new_folder, remove_folder
from lotwise.sources.files import read_listings_csv, read_listings_table


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="path of the listings, sample or full")
    parser.add_argument("--input-format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--one-line-records", action="store_true", help="CSV fields hold no breaks")
    parser.add_argument("--output", help="path of the table, for path-based formats")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--work", help="where the run makes and removes its folder of intermediate tables")
    parser.add_argument("--current-year", type=int, default=CURRENT_YEAR)
    args = parser.parse_args()

    spark = build_session("score-batch")
    columnar = args.input_format == "parquet"
    if columnar:
        listings = read_listings_table(spark, args.input)
    else:
        listings = read_listings_csv(
            spark, args.input, line_breaks_in_fields=not args.one_line_records
        )
    work = f"{args.work.rstrip('/')}/{uuid.uuid4().hex}" if args.work else new_folder(spark, "run")
    try:
        scored = score_batch(
            clean_batch(listings),
            current_year=args.current_year,
            scan_twice=columnar,
            work_path=work,
        )
        options = dict(pair.split("=", 1) for pair in args.option)
        overwrite_table(published(scored), args.output, args.format, **options)
    finally:
        remove_folder(spark, work)
    spark.stop()


if __name__ == "__main__":
    main()
