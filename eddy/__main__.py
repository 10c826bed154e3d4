"""Run the reference's jobs from the command line.

    python -m eddy windowed-join --nav DIR --user DIR
    python -m eddy portfolio --own DIR --nav DIR
    python -m eddy holdings --own DIR [--poison-user N] [--restarts 1]
    python -m eddy timeout --debit DIR --credit DIR [--ttl-ms 10000]
    python -m eddy route --records DIR --even DIR --odd DIR --dead DIR
    python -m eddy tables --records DIR --tuple DIR --employee DIR --bean DIR

The first four read folders of text files, one record per line, as streams
and print every row; a micro-batch runs every 20 s.  ``route`` and
``tables`` read folders of JSON lines (id, name, age, title; ``tables``
also timestamp, partition and offset) in place of topics and write Parquet.

Checkpoints go to ``--checkpoint``, else under ``spark.checkpoint.dir``
(``streams/<job>``), so running the same job again resumes where it
stopped.  A local run with neither starts afresh each time.  ``--once``
processes what is there and exits.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

from eddy.functions.time import TIMEOUT_MS
from eddy.session import build_session
from eddy.sinks.console import printing, sync_label
from eddy.sources.text import MAX_FILES_PER_TRIGGER, stream_lines
from eddy.streaming import jobs, runtime


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m eddy", description=__doc__.split("\n")[0])
    p.add_argument("--master", default=None, help="Spark master (default: the launcher's)")
    p.add_argument("--partitions", type=int, default=None,
                   help="shuffle/state partitions (default: 2 x cores on local[N], "
                        "else the launcher's); fixed by the checkpoint after the first run")
    p.add_argument("--once", action="store_true", help="process available input and exit")
    p.add_argument("--checkpoint", default=None,
                   help="checkpoint folder (default: <spark.checkpoint.dir>/streams/<job>)")
    sub = p.add_subparsers(dest="job", required=True)
    j = sub.add_parser("windowed-join", help="NAV x USER lines in 2 s / 1 s windows")
    j.add_argument("--nav", required=True)
    j.add_argument("--user", required=True)
    j = sub.add_parser("portfolio", help="NAV prices revalue every holder")
    j.add_argument("--own", required=True)
    j.add_argument("--nav", required=True)
    j = sub.add_parser("holdings", help="running holdings, with a poison record and restart")
    j.add_argument("--own", required=True)
    j.add_argument("--poison-user", type=int, default=None)
    j.add_argument("--restarts", type=int, default=1)
    j.add_argument("--restart-delay-ms", type=int, default=100)
    j = sub.add_parser("timeout", help="debit/credit pairs not matched within the timeout")
    j.add_argument("--debit", required=True)
    j.add_argument("--credit", required=True)
    j.add_argument("--ttl-ms", type=int, default=TIMEOUT_MS)
    j = sub.add_parser("route", help="even records to one output, odd ones keyed to another")
    for a in ("--records", "--even", "--odd", "--dead"):
        j.add_argument(a, required=True)
    j = sub.add_parser("tables", help="one record stream upserted into three tables")
    for a in ("--records", "--tuple", "--employee", "--bean"):
        j.add_argument(a, required=True)
    return p


# The record of the topic-fed jobs, and where a topic has it.
RECORD = "id bigint, name string, age int, title string"
PLACE = "timestamp timestamp, partition int, offset bigint"


def _frame(spark, args):
    if args.job == "windowed-join":
        return jobs.nav_user_join_job(stream_lines(spark, args.nav), stream_lines(spark, args.user))
    if args.job == "portfolio":
        return jobs.portfolio_lines_job(stream_lines(spark, args.own), stream_lines(spark, args.nav))
    if args.job == "holdings":
        return jobs.holdings_lines_job(stream_lines(spark, args.own), args.poison_user)
    return jobs.timeout_lines_job(stream_lines(spark, args.debit), stream_lines(spark, args.credit),
                                  args.ttl_ms)


def _topic_job(spark, args, checkpoint):
    def records(schema):
        return (spark.readStream.schema(schema).option("maxFilesPerTrigger", MAX_FILES_PER_TRIGGER)
                .json(args.records))

    def append(path):
        return lambda d: d.write.mode("append").parquet(path)

    if args.job == "route":
        return jobs.route_job(records(RECORD), append(args.even), append(args.odd), append(args.dead), checkpoint)
    logs = jobs.upsert_logs(args.tuple, args.employee, args.bean)
    return jobs.table_sink_job(records(f"{RECORD}, {PLACE}"), *(x.write_batch for x in logs.values()), checkpoint,
                               compact=list(logs.values()))


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    parts = args.partitions
    if parts is None and args.master and args.master.startswith("local"):
        m = re.match(r"local\[(\d+)\]", args.master)
        parts = 2 * (int(m.group(1)) if m else (os.cpu_count() or 1))
    spark = build_session(args.master, shuffle_partitions=parts, app_name=f"eddy-{args.job}")
    checkpoint = args.checkpoint or runtime.checkpoint_location(spark, args.job)

    def start():
        if args.job in ("route", "tables"):
            return _topic_job(spark, args, checkpoint)
        # the holdings job prints under a "sync_<ms>" label, as the reference does
        label = sync_label() if args.job == "holdings" else None
        return runtime.start(printing(_frame(spark, args), label), spark, args.job.replace("-", "_"),
                             once=args.once, checkpoint=checkpoint)

    attempts = args.restarts if args.job == "holdings" else 0
    delay = args.restart_delay_ms if args.job == "holdings" else 0
    # a topic-fed job ends, if it should, when all input is processed
    until = (lambda q: True) if args.once and args.job in ("route", "tables") else None
    runtime.run_with_restart(start, attempts=attempts, delay_ms=delay, until=until)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
