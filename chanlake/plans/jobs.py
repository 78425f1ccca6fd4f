"""Command-line jobs for spark-submit: the three flows of the reference.

    spark-submit chanlake/plans/jobs.py clean --input /landed/*.json --output /clean --as-of 2025-01-01
    spark-submit chanlake/plans/jobs.py warehouse --raw-data ... --raw-data-flat ... --messages ... --location ...
    spark-submit chanlake/plans/jobs.py listen --source /landed/messages --sink /albums --checkpoint ...

Inputs and outputs are paths on a shared file system; every job reads and
writes through Spark (nothing passes through the driver). Ship the package to
the executors with the job, e.g. ``zip -r chanlake.zip chanlake`` and
``spark-submit --py-files chanlake.zip chanlake/plans/jobs.py ...``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from chanlake.plans import warehouse
from chanlake.plans.cleaning import clean_frame, standardize_columns
from chanlake.schemas import LIVE_MESSAGE, RAW_GROUP
from chanlake.session import build_session
from chanlake.sources import files


def clean(spark: SparkSession, inputs: str, output: str, as_of: str, fmt: str = "parquet",
          infer: bool = False) -> None:
    """Entry A: landed group records -> cleaned records (T15), written by channel
    when a channel column is present. JSON input is read with the declared
    record schema unless ``infer`` (inference is an extra pass over the input)."""
    declared = {} if infer or not inputs.rstrip("/").endswith(".json") else {"schema": RAW_GROUP}
    raw = standardize_columns(files.load(spark, inputs, **declared))
    if raw.isEmpty():                    # nothing landed: write nothing (one-row probe job)
        print(f"clean: no records in {inputs}; nothing written", file=sys.stderr)
        return
    cols = set(raw.columns)
    out = clean_frame(raw, as_of, message="message", media="media_path",
                      date="message_date" if "message_date" in cols else "date",
                      channel="channel")
    if "channel" in cols:
        files.save_by_channel(out, output, fmt=fmt)
    else:
        out.write.mode("overwrite").format(fmt).save(output)


def build_warehouse(spark: SparkSession, raw_data: str, raw_data_flat: str | None, messages: str | None,
                    location: str) -> None:
    """Entry B: build and store every model, run the data tests, fail on any
    failure; the report is stored next to the models before that."""
    sources = {"raw_data": spark.read.parquet(raw_data)}
    if raw_data_flat:
        sources["raw_data_flat"] = spark.read.parquet(raw_data_flat)
    if messages:
        sources["stg_telegram_messages"] = spark.read.parquet(messages)
    warehouse.run(spark, sources, location)


def listen(spark: SparkSession, source: str, sink: str, checkpoint: str, lateness: str,
           fmt: str = "json", once: bool = False, channels: list[str] | None = None,
           media_dir: str = "media", media_kinds: tuple[str, ...] = ("photo", "document")) -> None:
    """Entry C: fold landed live messages (declared schema ``LIVE_MESSAGE``) of the listed channels (all without
    a list) into album records by inactivity, with the paths of their media. Messages without a readable
    date go to ``<sink>_rejected``. The checkpoint is required: a restart goes on where it stopped."""
    from chanlake.operators.albums import media_file_path
    from chanlake.streaming import sessions
    landed = sessions.read_landed(spark, source, LIVE_MESSAGE, fmt)
    if channels:
        landed = sessions.subscribe(landed, channels)
    stream = sessions.with_event_time(landed, "date", lateness).withColumn(
        "media_path", media_file_path(media_dir, media_kinds))
    base = checkpoint.rstrip("/")
    queries = [sessions.write_append(sessions.fold_live_albums(stream, media_path="media_path"), sink, base,
                                     available_now=once),
               sessions.write_append(sessions.without_time(landed, "date"), sink.rstrip("/") + "_rejected",
                                     base + "_rejected", available_now=once)]
    for q in queries:
        q.awaitTermination()


def main(argv: list[str]) -> int:
    p = argparse.ArgumentParser(prog="chanlake")
    sub = p.add_subparsers(dest="job", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--input", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--as-of", required=True, help="timestamp used for unparsable dates")
    c.add_argument("--format", default="parquet")
    c.add_argument("--infer", action="store_true", help="infer the input schema instead of the declared one")
    w = sub.add_parser("warehouse")
    w.add_argument("--raw-data", required=True)
    w.add_argument("--raw-data-flat")
    w.add_argument("--messages")
    w.add_argument("--location", required=True)
    s = sub.add_parser("listen")
    s.add_argument("--source", required=True)
    s.add_argument("--sink", required=True)
    s.add_argument("--checkpoint", required=True, help="shared folder of the stream's state and progress")
    s.add_argument("--channel", action="append", help="listen to this channel only (repeatable)")
    s.add_argument("--lateness", default="1 minute")
    s.add_argument("--format", default="json")
    s.add_argument("--once", action="store_true", help="process what has landed, then stop")
    a = p.parse_args(argv)
    spark = build_session()
    if a.job == "clean":
        clean(spark, a.input, a.output, a.as_of, a.format, a.infer)
    elif a.job == "warehouse":
        build_warehouse(spark, a.raw_data, a.raw_data_flat, a.messages, a.location)
    else:
        listen(spark, a.source, a.sink, a.checkpoint, a.lateness, a.format, a.once, a.channel)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
