"""Run the two jobs from the command line.

    python -m sensorstream archive   --checkpoint DIR [--config FILE] [--source-format F --source PATH]
                                     [--sink-format F --sink TARGET] [--alerts PATH] [--messages PATH] [--once]
    python -m sensorstream dashboard --root DIR [--config FILE] [--source-format F --source PATH]
                                     [--sink-format F --sink TARGET] [--once] [--max-per-trigger N]
    python -m sensorstream panels    --root DIR [--out DIR] [--as-of data]

Kafka is the default source and sink (connection settings from the
properties file); ``parquet``/``json`` folders of messages work the same way.
``--once`` processes what is available and stops (``availableNow``).
"""

from __future__ import annotations

import argparse

from pyspark import SparkConf
from pyspark.sql import SparkSession

from .session import CLUSTER_CONF
from .sources.config import ARCHIVE_TOPIC, INPUT_TOPIC, PROPERTIES_FILE, kafka_options, read_config
from .sources.readers import read_messages


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m sensorstream")
    p.add_argument("job", choices=("archive", "dashboard", "panels"))
    p.add_argument("--config", default=PROPERTIES_FILE)
    p.add_argument("--source-format", default="kafka")
    p.add_argument("--source", default=None, help="message folder (file formats)")
    p.add_argument("--sink-format", default="kafka")
    p.add_argument("--sink", default=ARCHIVE_TOPIC, help="archive topic or folder")
    p.add_argument("--checkpoint", help="archive job: checkpoint folder (shared storage)")
    p.add_argument("--alerts", help="archive job: also write the alert table rows here (parquet)")
    p.add_argument("--messages", help="archive job: also write one notification per alert here (parquet)")
    p.add_argument("--root", help="dashboard job: folder for tables and checkpoints (shared storage)")
    p.add_argument("--once", action="store_true", help="process what is available, then stop")
    p.add_argument("--out", help="panels job: output folder (default ROOT/panels)")
    p.add_argument("--as-of", choices=("now", "data"), default="now",
                   help="panels job: end the 12 h horizon now, or at the latest known reading")
    p.add_argument("--max-per-trigger", type=int, help="most Kafka offsets (or files) of one micro-batch")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    """Start the chosen job; waits for it unless a session is passed in."""
    from .functions.parse import parse_readings
    from .operators.alerts import alert_messages, alert_table, first_alert
    from .streaming.jobs import archive_stream, start_dashboard_job, stop_all

    args = _parser().parse_args(argv)
    own = spark is None
    spark = spark or _session(f"sensorstream-{args.job}")
    if args.job == "panels":
        _write_panels(spark, args)
        return {}
    conf = read_config(args.config)
    kafka = args.source_format == "kafka"
    source = kafka_options(conf, INPUT_TOPIC) if kafka else {}
    if args.max_per_trigger:
        source["maxOffsetsPerTrigger" if kafka else "maxFilesPerTrigger"] = str(args.max_per_trigger)
    messages = read_messages(spark, None if kafka else args.source, args.source_format, source, stream=True)
    keep = ("partition", "offset") if kafka else ("event_id",)
    sink_opts = kafka_options(conf, None, None) if args.sink_format == "kafka" else None
    trigger = {"availableNow": True} if args.once else None
    if args.job == "archive":
        if not args.checkpoint:
            raise SystemExit("--checkpoint is required")
        queries = {"archive": archive_stream(messages, args.sink_format, args.sink, sink_opts,
                                             f"{args.checkpoint}/archive", trigger, keep)}
        enriched = first_alert(parse_readings(messages, keep=keep))
        for name, path, df in (("alerts", args.alerts, alert_table(enriched)),
                               ("messages", args.messages, alert_messages(enriched, keep=keep))):
            if path:
                w = df.writeStream.format("parquet").option("checkpointLocation", f"{args.checkpoint}/{name}")
                queries[name] = (w.trigger(**trigger) if trigger else w).start(path)
    else:
        if not args.root:
            raise SystemExit("--root is required")
        queries = start_dashboard_job(messages, args.root, args.sink_format, args.sink, sink_opts, trigger,
                                      keep=keep)
    if own:
        try:
            if args.once:  # every query ends by itself; a failure raises here
                for q in queries.values():
                    q.awaitTermination()
            else:  # the first query to stop (or fail) ends the job
                spark.streams.awaitAnyTermination()
                for q in queries.values():
                    if q.exception() is not None:
                        raise q.exception()
        finally:
            stop_all(queries.values())
    return queries


def _session(name: str) -> SparkSession:
    """A session with the suggested cluster settings wherever spark-submit sets none."""
    conf = SparkConf()
    for k, v in CLUSTER_CONF.items():
        conf.setIfMissing(k, str(v))
    return SparkSession.builder.appName(name).config(conf=conf).getOrCreate()


def _write_panels(spark: SparkSession, args) -> None:
    """Batch refresh of the panel and incident tables from the dashboard job's
    tables. Incidents are counted over the history inside the horizon (its last
    days' partitions), so open ones and late rows count too."""
    from .operators import known_sensors, latest_time
    from .plans import dashboard, write_dashboard
    from .streaming.snapshots import refresh_state

    if not args.root:
        raise SystemExit("--root is required")
    state = refresh_state(spark, f"{args.root}/latest", f"{args.root}/latest-snapshots")
    readings = spark.read.parquet(f"{args.root}/history")
    as_of = latest_time(known_sensors(readings)) if args.as_of == "data" else None
    write_dashboard(dashboard(readings, as_of, state=state), args.out or f"{args.root}/panels")


if __name__ == "__main__":
    main()
