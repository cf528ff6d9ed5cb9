"""Clean the listings of a CSV feed and send them as messages.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2 \
        --py-files lotwise.zip jobs/publish_messages.py \
        --input s3a://feeds/listings/ --servers broker:9092
"""

from __future__ import annotations

import argparse

from lotwise.operators.prepare import fill_defaults, keep_price_range, require_complete
from lotwise.session import build_session
from lotwise.sources.files import first_rows, read_listings_csv
from lotwise.sources.messages import TOPIC, encode_messages, write_bus


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--rows", type=int, help="only the first rows by id; default: all")
    parser.add_argument("--one-line-records", action="store_true", help="CSV fields hold no breaks")
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topic", default=TOPIC)
    args = parser.parse_args()

    listings = read_listings_csv(
        build_session("publish-messages"),
        args.input,
        line_breaks_in_fields=not args.one_line_records,
    )
    if args.rows:
        listings = first_rows(listings, args.rows)
    cleaned = fill_defaults(keep_price_range(require_complete(listings)))
    write_bus(encode_messages(cleaned), args.servers, args.topic)


if __name__ == "__main__":
    main()
