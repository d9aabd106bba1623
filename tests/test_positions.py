"""Byte positions of lines, however files are cut."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import batches
from tallyline.sources.positions import locate, read_in_order, read_origin, split_places


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """Files of lines of all sizes, written in another order than their names; what they hold."""
    root, r = tmp_path_factory.mktemp("lines"), random.Random(1)
    expected = []
    for number, name in enumerate(["c.log", "a.log", "d.log", "b.log", "e.log"]):
        lines = [b"x" * r.choice([0, 1, 5, 90, 3_000]) + b"\xff\r%d" % i for i in range(r.randint(1, 400))]
        lines[r.randrange(len(lines))] = b""
        cut = number % 2 == 0
        (root / name).write_bytes(b"\n".join(lines) + (b"" if cut else b"\n"))
        os.utime(root / name, (1_700_000_000 + 50_000 * number, 1_700_000_000 + 50_000 * number))
        expected.append((name, lines, cut and lines[-1] != b""))
    (root / "empty.log").write_bytes(b"")
    return str(root), expected


def _places(expected):
    before = 0
    for name, lines, cut in expected:
        at = 0
        for i, line in enumerate(lines):
            yield name, bytes(line), at, before + at, cut and i == len(lines) - 1
            at += len(line) + 1
        before += at


@pytest.mark.parametrize("by", ["modified", "name"])
@pytest.mark.parametrize("split", ["3k", "20k", "128m"])
def test_positions_do_not_depend_on_splits(spark, files, by, split):
    path, expected = files
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = read_in_order(spark, path, by)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    name = F.substring_index("source_file", "/", -1)
    got = df.select(name, "raw", "offset", "position", "truncated").orderBy("position").collect()
    wanted = _places(sorted(expected) if by == "name" else expected)
    assert [(a, bytes(b), *rest) for a, b, *rest in got] == list(wanted)


@pytest.mark.parametrize("split", ["64k", "65536", "1m", "128MB"])
def test_small_splits_share_tasks(spark, tmp_path, split):
    for name in "ab":
        (tmp_path / name).write_bytes(b"".join(b"%07d" % i + b"x" * 92 + b"\n" for i in range(15_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        lines = read_origin(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism  # of 46 splits of 64k
        df = locate(lines, by="name")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    number = F.substr("raw", F.lit(1), F.lit(7)).cast("string").cast("bigint")
    assert df.where((F.col("offset") == number * 100) & ~F.col("truncated")).count() == df.count() == 30_000
    assert df.agg(F.countDistinct("position"), F.max("position")).first() == (30_000, 2_999_900)


def test_running_sums_need_no_exchange(spark, files):
    path, _ = files
    plan = split_places(read_origin(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEvalPython" in plan


def test_sums_are_joined_by_shuffle_beyond_a_size(spark, files):
    path, expected = files
    df = locate(read_origin(spark, path), max_broadcast_bytes=0)
    assert df.select(F.sum("position"), F.count("*")).first()[1] == sum(len(lines) for _, lines, _ in expected)


def test_compressed_files_are_refused(spark, tmp_path):
    spark.createDataFrame([("a" * 50,)] * 40, "value string").coalesce(1).write.option("compression", "gzip").text(f"{tmp_path}/z")
    with pytest.raises(ValueError, match="compressed"):
        read_in_order(spark, f"{tmp_path}/z")
    with pytest.raises(ValueError, match="ordered by"):
        read_in_order(spark, f"{tmp_path}/z", by="size")


def test_batches_over_byte_positions(spark, files):
    path, expected = files
    df = batches.number_batches(read_in_order(spark, path), "position", 7, bucket_bits=10)
    got = [row.batch_no for row in df.orderBy("position").collect()]
    assert got == [i // 7 for i in range(sum(len(lines) for _, lines, _ in expected))]


def test_no_files_with_lines(spark, tmp_path):
    (tmp_path / "empty.log").write_bytes(b"")
    assert read_in_order(spark, str(tmp_path)).count() == 0
