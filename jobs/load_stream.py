"""Load listing messages into a table until they stop arriving.

Files hold every message once. A warehouse format appends at least once: a batch
that runs again is appended again, under the same run and batch_id.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2 \
        --py-files lotwise.zip jobs/load_stream.py \
        --servers broker:9092 --output s3a://tables/listings/
"""

from __future__ import annotations

import argparse

from lotwise.session import build_session
from lotwise.sources.messages import TOPIC, read_bus
from lotwise.streaming.jobs import EVERY_TEN_SECONDS, await_idle, start_loading
from lotwise.streaming.sinks import append_sink, file_sink


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topic", default=TOPIC)
    parser.add_argument("--starting-offsets", default="latest")
    parser.add_argument("--max-offsets-per-trigger", type=int, default=1_000_000)
    parser.add_argument("--min-partitions", type=int, help="cut large topic partitions")
    parser.add_argument("--output", required=True, help="folder of the tables and the checkpoint")
    parser.add_argument("--checkpoint", help="default: inside the output folder")
    parser.add_argument("--format", default="parquet", help="other formats append to a warehouse")
    parser.add_argument("--table-option", default="table", help="option that names a table")
    parser.add_argument("--table-prefix", default="")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--idle-seconds", type=float, default=60)
    args = parser.parse_args()

    messages = read_bus(
        build_session("load-stream"),
        args.servers,
        args.topic,
        starting_offsets=args.starting_offsets,
        max_offsets_per_trigger=args.max_offsets_per_trigger,
        min_partitions=args.min_partitions,
    )
    options = dict(pair.split("=", 1) for pair in args.option)
    sink = file_sink(args.output, **options)
    if args.format != "parquet":
        sink = append_sink(args.format, args.table_option, args.table_prefix, **options)
    query = start_loading(
        messages, args.output, sink=sink, checkpoint=args.checkpoint, trigger=EVERY_TEN_SECONDS
    )
    await_idle(query, args.idle_seconds)


if __name__ == "__main__":
    main()
