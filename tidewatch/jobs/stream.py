"""The streaming program: events from the bus, or from files, to the landed window table.

    spark-submit -m tidewatch.jobs.stream --brokers host:9092 --topic events --output PATH --checkpoint PATH
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from tidewatch.schema import WATERMARK_DELAY, WINDOW_LENGTH
from tidewatch.session import build_session
from tidewatch.sources.bus import stream_json_lines, stream_messages
from tidewatch.streaming.runner import CATCH_UP, LIVE, run_stream


# A first start reads a whole topic or folder: in batches of this size, whatever has gathered there.
OFFSETS_PER_BATCH = 50_000_000
FILES_PER_BATCH = 1000


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Land the windows of an event stream.")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--brokers", help="bootstrap servers of the bus")
    source.add_argument("--input", help="folder of files with one JSON event per line")
    parser.add_argument("--topic", default="events")
    parser.add_argument("--output", required=True, help="landed window table")
    parser.add_argument("--checkpoint", required=True, help="state of the stream")
    parser.add_argument("--length", default=WINDOW_LENGTH)
    parser.add_argument("--delay", default=WATERMARK_DELAY)
    parser.add_argument("--files-per-batch", type=int, default=FILES_PER_BATCH, help="files of --input in a batch at most")
    parser.add_argument("--offsets-per-batch", type=int, default=OFFSETS_PER_BATCH, help="messages of the bus in a batch at most")
    parser.add_argument("--catch-up", action="store_true", help="stop when everything there is has been read")
    given = parser.parse_args(argv)

    spark = build_session("tidewatch-stream")
    if given.brokers:
        messages = stream_messages(spark, given.brokers, given.topic, max_offsets_per_trigger=given.offsets_per_batch)
    else:
        messages = stream_json_lines(spark, given.input, given.files_per_batch)
    trigger = CATCH_UP if given.catch_up else LIVE
    run_stream(messages, given.output, given.checkpoint, given.length, given.delay, trigger).awaitTermination()


if __name__ == "__main__":
    main()
