"""Score listing messages as they arrive; write summaries, alerts and counts.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2 \
        --py-files lotwise.zip jobs/score_stream.py \
        --servers broker:9092 --output s3a://tables/live/
"""

from __future__ import annotations

import argparse

from lotwise.schema import CURRENT_YEAR
from lotwise.session import build_session
from lotwise.sources.messages import TOPIC, read_bus
from lotwise.streaming.jobs import await_idle, start_scoring
from lotwise.streaming.sinks import all_of, console_sink, file_sink


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topic", default=TOPIC)
    parser.add_argument("--starting-offsets", default="latest")
    parser.add_argument("--max-offsets-per-trigger", type=int, default=1_000_000)
    parser.add_argument("--min-partitions", type=int, help="cut large topic partitions")
    parser.add_argument("--output", required=True)
    parser.add_argument("--checkpoint", help="default: inside the output folder")
    parser.add_argument("--console", action="store_true", help="print the tables' first rows too")
    parser.add_argument("--every", default="10 seconds")
    parser.add_argument("--idle-seconds", type=float, help="stop once idle; default: never stop")
    parser.add_argument("--current-year", type=int, default=CURRENT_YEAR)
    args = parser.parse_args()

    messages = read_bus(
        build_session("score-stream"),
        args.servers,
        args.topic,
        starting_offsets=args.starting_offsets,
        max_offsets_per_trigger=args.max_offsets_per_trigger,
        min_partitions=args.min_partitions,
    )
    query = start_scoring(
        messages,
        args.output,
        sink=all_of(file_sink(args.output), console_sink()) if args.console else None,
        checkpoint=args.checkpoint,
        trigger={"processingTime": args.every},
        current_year=args.current_year,
    )
    if args.idle_seconds is None:
        query.awaitTermination()
    else:
        await_idle(query, args.idle_seconds)


if __name__ == "__main__":
    main()
