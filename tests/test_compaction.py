"""Merging of small files in place."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shopflow.operators import layout


def part_files(path):
    return {f.name: (f.stat().st_mtime_ns, f.stat().st_size) for f in Path(path).glob("*.parquet")}


def numbers(spark, low, high):
    return spark.range(low, high).select("id", F.md5(F.col("id").cast("string")).alias("text"))


@pytest.fixture
def folder(spark, tmp_path):
    """One large file in the middle of the keys, small ones on both sides."""
    path = str(tmp_path / "table")
    numbers(spark, 10_000, 30_000).coalesce(1).write.parquet(path)
    large = set(part_files(path))
    for low, high in ((0, 10_000), (30_000, 40_000)):
        numbers(spark, low, high).repartitionByRange(10, "id").write.mode("append").parquet(path)
    return path, large


def same(spark, path, low=0, high=40_000):
    got = spark.read.parquet(path)
    want = numbers(spark, low, high)
    return got.count() == high - low and got.exceptAll(want).isEmpty()


def test_large_files_stay_and_neighbours_are_merged(spark, folder):
    path, large = folder
    before = part_files(path)
    size = before[next(iter(large))][1]
    small = max(b for name, (_, b) in before.items() if name not in large)
    assert layout.compact_small(spark, path, ["id"], target_bytes=4 * small, small_bytes=size) == 20
    after = part_files(path)
    assert {n: after[n] for n in large} == {n: before[n] for n in large}
    assert len(after) <= 1 + 6 and same(spark, path)
    assert max(b for n, (_, b) in after.items() if n not in large) < 6 * small
    ranges = layout.file_ranges(spark.read.parquet(path), "id")
    ranges = sorted((r.lo, r.hi) for r in ranges.collect() if not r.file.endswith(tuple(large)))
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert not (Path(path) / layout.WORK).exists()


def test_nothing_to_merge(spark, folder, tmp_path):
    path, _ = folder
    before = part_files(path)
    assert layout.compact_small(spark, path, ["id"], small_bytes=1) == 0  # no file is small
    assert layout.compact_small(spark, path, ["id"], least_files=100) == 0
    assert layout.compact_small(spark, path, ["id"], target_bytes=1, small_bytes=1 << 30) == 0  # groups of one
    assert part_files(path) == before
    empty = tmp_path / "empty"
    empty.mkdir()
    assert layout.compact_small(spark, str(empty)) == 0


def test_a_merge_that_died_is_completed_or_forgotten(spark, folder, monkeypatch):
    path, large = folder
    finish = layout.finish_compaction
    calls = []

    def dies_before_moving(session, at):
        calls.append(at)
        if len(calls) == 1:
            finish(session, at)
        else:
            raise RuntimeError("lost")

    monkeypatch.setattr(layout, "finish_compaction", dies_before_moving)
    with pytest.raises(RuntimeError):
        layout.compact_small(spark, path, ["id"])
    assert same(spark, path)  # readers do not see the new files
    monkeypatch.setattr(layout, "finish_compaction", finish)
    # some files are moved already when the next run takes over
    names = sorted(r["file"] for r in spark.read.parquet(f"{path}/{layout.WORK}/plan").collect())
    (Path(path) / layout.WORK / "old").mkdir()
    for name in names[:7]:
        (Path(path) / name).rename(Path(path) / layout.WORK / "old" / name)
    new = next((Path(path) / layout.WORK / "new").glob("*.parquet"))
    new.rename(Path(path) / new.name)
    layout.finish_compaction(spark, path)
    assert same(spark, path) and not set(names) & set(part_files(path))

    # files without the list that commits them are forgotten
    before = part_files(path)
    numbers(spark, 0, 10).write.parquet(f"{path}/{layout.WORK}/new")
    layout.finish_compaction(spark, path)
    assert part_files(path) == before and same(spark, path)


def test_nulls_ties_and_added_columns(spark, tmp_path):
    path = str(tmp_path / "odd")
    spark.createDataFrame([(None, "a"), (5, "b")], "id long, text string").repartition(2).write.parquet(path)
    spark.createDataFrame([(5, "b", 1)] * 3 + [(None, None, None)], "id long, text string, more int").write.mode("append").parquet(path)
    files = len(part_files(path))
    assert layout.compact_small(spark, path, ["id"]) == files and len(part_files(path)) == 1
    got = sorted(map(tuple, spark.read.parquet(path).collect()), key=repr)
    assert got == sorted([(None, "a", None), (5, "b", None), *[(5, "b", 1)] * 3, (None, None, None)], key=repr)


def test_other_layouts_are_refused(spark, tmp_path):
    path = str(tmp_path / "parts")
    numbers(spark, 0, 10).withColumn("day", F.col("id") % 2).write.partitionBy("day").parquet(path)
    with pytest.raises(ValueError, match="day="):
        layout.compact_small(spark, path)


def test_groups_follow_the_sizes(spark):
    rows = [(f"f{i:03}", 10, i) for i in range(95)]
    files = spark.createDataFrame(rows, "file string, bytes long, k int").select("file", "bytes", F.struct("k").alias("lo"))
    groups = {r["file"]: r["group"] for r in layout.merge_groups(files, 100, 6).collect()}
    assert groups == {f"f{i:03}": i // 10 for i in range(90)}  # the last group has five files
