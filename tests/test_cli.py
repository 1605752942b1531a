"""The command-line jobs over gzip ride / fare files equal the library results."""

import glob
import gzip
import os

import pytest

from cabline import cli
from cabline.operators import enrich, rides as R
from cabline.sinks import render
from cabline.sources import files, fixtures as fx
from tests.conftest import SF_SMALL


def _write_gz(df, path):
    os.makedirs(path, exist_ok=True)
    lines = sorted(r.value for r in df.collect())
    with gzip.open(os.path.join(path, "part-0.gz"), "wt") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("cli")
    ev = fx.load_events(spark, SF_SMALL)
    _write_gz(render.rides(fx.rides(ev)), str(d / "rides"))
    _write_gz(render.fares(fx.fares_for_rides(ev)), str(d / "fares"))
    return str(d / "rides"), str(d / "fares"), d


def _lines(path):
    out = []
    for f in glob.glob(os.path.join(path, "part-*")):
        with open(f) as fh:
            out += fh.read().splitlines()
    return sorted(out)


def test_ride_cleansing(spark, inputs):
    rides, _, d = inputs
    cli.main(["ride-cleansing", "--rides", rides, "--save", str(d / "clean")])
    want = sorted(r.value for r in render.rides(R.cleanse(files.read_rides(spark, rides))).collect())
    assert _lines(str(d / "clean")) == want and want


def test_rides_and_fares(spark, inputs):
    rides, fares, d = inputs
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        cli.main(["rides-and-fares", "--rides", rides, "--fares", fares, "--save", str(d / "pairs"),
                  "--shuffle-partitions", "4"])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = _lines(str(d / "pairs"))
    want = enrich.rides_with_fares(files.read_rides(spark, rides), files.read_fares(spark, fares))
    assert len(got) == want.count() > 0
    assert all(x.startswith("(") and x.endswith(")") and x.count(",") == 18 for x in got)


def test_expiring_state_routes_three_outputs(spark, inputs):
    rides, fares, d = inputs
    cli.main(["expiring-state", "--rides", rides, "--fares", fares, "--save", str(d / "exp")])
    pairs = enrich.match_with_expiry(
        R.start_events_with_loss(files.read_rides(spark, rides), cli.LOSS_MODULUS),
        files.read_fares(spark, fares))
    for name, outcome in [("matched", "matched"), ("unmatched_rides", "unmatched_ride"),
                          ("unmatched_fares", "unmatched_fare")]:
        assert len(_lines(str(d / "exp" / name))) == pairs.where(f"outcome = '{outcome}'").count()


def test_hourly_tips_batch_and_stream(spark, inputs):
    _, fares, d = inputs
    cli.main(["hourly-tips", "--fares", fares, "--save", str(d / "tips")])
    batch = _lines(str(d / "tips"))
    assert batch and all(x.startswith("(") and x.endswith(")") for x in batch)
    cli.main(["hourly-tips", "--fares", fares, "--save", str(d / "tips_stream"), "--stream",
              "--available-now", "--checkpoint", str(d / "ck")])
    stream = _lines(str(d / "tips_stream"))
    # the stream withholds the hours its watermark has not closed yet
    assert stream and set(stream) <= set(batch)


def test_streaming_jobs_write_their_outputs(spark, inputs):
    rides, fares, d = inputs
    cli.main(["expiring-state", "--rides", rides, "--fares", fares, "--save", str(d / "exp_s"),
              "--stream", "--available-now", "--checkpoint", str(d / "ck_exp")])
    assert set(os.listdir(str(d / "exp_s"))) == {"matched", "unmatched_rides", "unmatched_fares"}
    cli.main(["expiring-state", "--rides", rides, "--fares", fares, "--save", str(d / "exp_b")])
    for name in os.listdir(str(d / "exp_s")):          # whole lines, those of the batch job
        files_ = glob.glob(str(d / "exp_s" / name / "batch=*" / "part-*"))
        lines = [x for f in files_ for x in open(f).read().splitlines()]
        assert set(lines) <= set(_lines(str(d / "exp_b" / name)))
        assert lines or name != "matched"
    cli.main(["rides-and-fares", "--rides", rides, "--fares", fares, "--save", str(d / "pairs_s"),
              "--stream", "--available-now", "--checkpoint", str(d / "ck_pairs")])
    cli.main(["rides-and-fares", "--rides", rides, "--fares", fares, "--save", str(d / "pairs_b")])
    got = _lines(str(d / "pairs_s"))
    assert got and set(got) <= set(_lines(str(d / "pairs_b")))   # same lines as the batch job


def test_ride_cleansing_stream_equals_batch(spark, inputs):
    rides, _, d = inputs
    cli.main(["ride-cleansing", "--rides", rides, "--save", str(d / "clean_b")])
    cli.main(["ride-cleansing", "--rides", rides, "--save", str(d / "clean_s"), "--stream",
              "--available-now", "--checkpoint", str(d / "ck_clean")])
    assert _lines(str(d / "clean_s")) == _lines(str(d / "clean_b"))
