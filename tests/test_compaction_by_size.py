"""Small files are packed together; large ones are not touched."""

import glob
import os

from pyspark.sql import functions as F

from meeple.operators import tables


def _write(spark, path, day, files, rows):
    df = spark.range(files * rows).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    df.repartition(files).write.mode("append").parquet(f"{path}/event_date={day}")


def _files(path):
    return {f: os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_only_days_with_small_files_change(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    _write(spark, path, "2024-01-01", 12, 50)  # many small files
    _write(spark, path, "2024-01-02", 1, 5000)  # one large
    _write(spark, path, "2024-01-03", 1, 5000)
    _write(spark, path, "2024-01-03", 1, 50)  # a large and a small one
    _write(spark, path, "2024-01-04", 2, 5000)
    _write(spark, path, "2024-01-04", 5, 50)  # large ones and small ones
    before, rows = _files(path), sorted(map(str, spark.read.parquet(path).collect()))
    small = 40_000
    assert sum(s < small for s in before.values()) == 18
    done = tables.compact_small_files(spark, path, small, "event_date")
    after = _files(path)
    assert sorted(map(str, spark.read.parquet(path).collect())) == rows
    assert set(done) == {"2024-01-01", "2024-01-04"}
    assert sum(done.values()) == len(before) - len(after)
    untouched = {f for f, s in before.items() if s >= small or "2024-01-03" in f}
    assert untouched <= set(after)
    ones = [f for f in after if "2024-01-01" in f]
    total = sum(s for f, s in before.items() if "2024-01-01" in f)
    assert 1 <= len(ones) <= -(-total // small) + 1 and all("compacted-" in f for f in ones)
    again = tables.compact_small_files(spark, path, min(after.values()), "event_date")
    assert again == {} and set(_files(path)) == set(after)
    assert not glob.glob(f"{path}/*/_compacted*")


def test_a_table_without_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/flat"
    spark.range(900).repartition(9).write.parquet(path)
    assert tables.compact_small_files(spark, path, 1 << 20) == {"": 8}
    assert spark.read.parquet(path).count() == 900 and len(_files(path)) == 1


def test_bins_are_packed_by_size(spark, tmp_dir):
    path = f"{tmp_dir}/bins"
    spark.range(4000).repartition(16).write.parquet(path)
    sizes = sorted(_files(path).values())
    bound = 4 * sizes[-1]
    bins = {}
    for r in tables.small_files(spark.read.parquet(path), bound).collect():
        bins.setdefault(r["bin"], []).append(r["size"])
    assert sorted(s for b in bins.values() for s in b) == sizes
    assert all(sum(b) < bound + sizes[-1] for b in bins.values()) and 3 <= len(bins) <= 6
