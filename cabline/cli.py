"""Command-line runner of the four ride jobs: ``python -m cabline <job> [options]``.

    ride-cleansing   --rides PATH [--save DIR]
    hourly-tips      --fares PATH [--save DIR]
    rides-and-fares  --rides PATH --fares PATH [--save DIR]
    expiring-state   --rides PATH --fares PATH [--save DIR]

Inputs are ride / fare line files (gzip or plain; a file, folder or glob).
By default a job reads its complete input as a batch -- the defined answer,
since the sources never emit rows later than their watermark -- and writes
text lines to ``--save`` (or prints them).  ``--stream`` reads the input
folder as a file stream with the job's watermark and runs until stopped
(``--available-now``: until the files present are done); its checkpoint goes
to ``--checkpoint`` or below ``spark.checkpoint.dir``.  expiring-state writes
``matched``, ``unmatched_rides`` and ``unmatched_fares`` below ``--save``.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline import sinks
from cabline.operators import enrich, rides as R, tips
from cabline.session import checkpoint_dir, get_spark
from cabline.sinks import render
from cabline.sources import files
from cabline.streaming import jobs as stream_jobs
from cabline.streaming.sources import fare_stream, ride_stream

JOBS = ["ride-cleansing", "hourly-tips", "rides-and-fares", "expiring-state"]
# Fixed value: START rides with ride_id % 1000 == 0 are dropped in the expiring-state job.
LOSS_MODULUS = 1000
# Folders of the expiring-state outputs below --save (batch and stream alike).
OUTPUT_FOLDERS = {enrich.MATCHED: "matched", enrich.UNMATCHED_RIDE: "unmatched_rides",
                  enrich.UNMATCHED_FARE: "unmatched_fares"}


def _need(args, *names):
    for n in names:
        if not getattr(args, n):
            raise SystemExit(f"{args.job} needs --{n}")


def _batch_output(spark, args) -> DataFrame:
    """The text output (one ``value`` column) of a batch run."""
    if args.job == "ride-cleansing":
        return render.rides(R.cleanse(files.read_rides(spark, args.rides)))
    if args.job == "hourly-tips":
        f = files.read_fares(spark, args.fares)
        return tips.render_tuple(tips.label_with_window_end(tips.hourly_max(tips.hourly_tips(f))))
    r, f = files.read_rides(spark, args.rides), files.read_fares(spark, args.fares)
    return render.ride_fare_pairs(enrich.rides_with_fares(r, f, keep_fare_ids=True))


def _expiring_batch(spark, args) -> DataFrame:
    """(outcome, value): the three outputs of the expiring-state job as one."""
    r, f = files.read_rides(spark, args.rides), files.read_fares(spark, args.fares)
    return render.expiring_lines(enrich.match_with_expiry(
        R.start_events_with_loss(r, LOSS_MODULUS), f, max_wait_seconds=args.max_wait))


def _run_batch(spark, args) -> None:
    # printed by the tasks, like a print sink: no row goes through the driver
    def print_lines(rows):
        for row in rows:
            print(f"{row.outcome}> {row.value}" if "outcome" in row else row.value)

    if args.job == "expiring-state":
        lines = _expiring_batch(spark, args)        # the join runs once for all outputs
        if args.save:
            sinks.write_outcomes(lines, args.save, OUTPUT_FOLDERS)
        else:
            names = F.create_map(*[F.lit(x) for pair in OUTPUT_FOLDERS.items() for x in pair])
            lines.withColumn("outcome", names[F.col("outcome")]).foreachPartition(print_lines)
        return
    lines = _batch_output(spark, args)
    if args.save:
        sinks.write_text(lines, args.save, mode="overwrite")
    else:
        lines.foreachPartition(print_lines)


def _stream(spark, args) -> DataFrame:
    if args.job == "ride-cleansing":
        c = stream_jobs.ride_cleansing(ride_stream(spark, args.rides))
        return render.rides(c)
    if args.job == "hourly-tips":
        return tips.render_tuple(stream_jobs.hourly_max_tips(fare_stream(spark, args.fares)))
    r, f = ride_stream(spark, args.rides), fare_stream(spark, args.fares)
    if args.job == "rides-and-fares":
        return render.ride_fare_pairs(stream_jobs.rides_with_fares(r, f, keep_fare_ids=True))
    out = stream_jobs.expiring_pairs_join(r, f, max_wait_seconds=args.max_wait,
                                          loss_modulus=LOSS_MODULUS)
    return render.expiring_lines(out)


def _run_stream(spark, args) -> None:
    df = _stream(spark, args)
    ckpt = args.checkpoint or checkpoint_dir(spark, f"cabline/{args.job}")
    trigger = {"availableNow": True} if args.available_now else None
    if args.job == "expiring-state" and args.save:
        def write(batch: DataFrame, batch_id: int, outcome: str) -> None:
            # one folder per micro-batch, overwritten on replay: exactly once
            sinks.write_text(batch.select("value"),
                             os.path.join(args.save, outcome, f"batch={batch_id}"),
                             mode="overwrite")
        router = sinks.route_outcomes({o: (lambda b, i, name=name: write(b, i, name))
                                       for o, name in OUTPUT_FOLDERS.items()})
        w = df.writeStream.foreachBatch(router).option("checkpointLocation", ckpt)
        if trigger:
            w = w.trigger(**trigger)
        q = w.start()
    elif args.save:
        q = sinks.text_stream(df.select("value"), args.save, ckpt, trigger)
    else:
        q = sinks.console_stream(df, ckpt)
    q.awaitTermination()


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m cabline", description=__doc__.split("\n")[0])
    ap.add_argument("job", choices=JOBS)
    ap.add_argument("--rides")
    ap.add_argument("--fares")
    ap.add_argument("--save")
    ap.add_argument("--stream", action="store_true")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--checkpoint")
    ap.add_argument("--max-wait", type=int, default=0, help="expiring-state: seconds")
    ap.add_argument("--shuffle-partitions", type=int,
                    help="tasks per shuffle (the session's or AQE's choice when unset)")
    args = ap.parse_args(argv)
    if args.job == "ride-cleansing":
        _need(args, "rides")
    elif args.job == "hourly-tips":
        _need(args, "fares")
    else:
        _need(args, "rides", "fares")
    spark = get_spark(app=f"cabline-{args.job}")
    if args.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
    if args.stream:
        _run_stream(spark, args)
    else:
        _run_batch(spark, args)


if __name__ == "__main__":
    main()
