"""What a task of a whole run sorts is bounded by rows, whatever the table's size."""

import gzip
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bulkloom import queries, session
from bulkloom.operators import windows
from bulkloom.plans import bsa
from bulkloom.sources import sinks, variants

from .conftest import SF


def _most(spark):
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def test_sorts_of_a_run_are_bounded_by_rows(spark, tmp_path, monkeypatch):
    """With ranges of 100 rows there are more than a shuffle's four; the table is whole and in order, and sorted rows are read in small splits."""
    monkeypatch.setattr(session, "SORTED_ROWS", 100, raising=False)
    seen = []
    monkeypatch.setattr(bsa, "statistics_table", lambda stats, own=bsa.statistics_table, **names: seen.append(_most(spark)) or own(stats, **names))
    out = str(tmp_path / "out")
    bsa.run_bsa(variants.read_variants(spark, queries._write_wide(spark, SF)), out, high_parent="HP", low_parent="LP", high_bulk="HB", low_bulk="LB", window=2000, step=500)
    rows = [[line.split("\t")[:2] for line in p.read_text().splitlines()[1:]] for p in sorted(Path(out, "statistics.tsv").glob("part-*"))]
    n = spark.read.parquet(f"{out}/stats").count()
    assert n > 1000 and max(map(len, rows)) < n / 8
    places = [(chrom, int(pos)) for part in rows for chrom, pos in part]
    assert len(places) == n and places == sorted(places)
    assert seen == [4 << 20] and _most(spark) == session.SPLIT


def test_small_splits_end_with_an_error(spark, tmp_path):
    session.tune(spark)
    spark.range(40_000).repartition(4).write.parquet(str(tmp_path / "t"))
    tasks = spark.read.parquet(str(tmp_path / "t")).rdd.getNumPartitions()
    try:
        with session.small_splits(spark, 1000):
            assert spark.read.parquet(str(tmp_path / "t")).rdd.getNumPartitions() > tasks
            raise KeyError
    except KeyError:
        pass
    assert _most(spark) == session.SPLIT


def _lines(folder):
    read = lambda p: gzip.open(p, "rt") if p.suffix == ".gz" else p.open()
    files = [read(p).read().splitlines() for p in sorted(Path(folder).glob("part-*"))]
    assert all(f[0] == files[0][0] for f in files)
    return files[0][0], [line for f in files for line in f[1:]], [len(f) - 1 for f in files]


def test_text_of_a_run_is_packed(spark, tmp_path, monkeypatch):
    """Packed text holds the same lines in the same order as plain text, in files of few rows; what the queries write of it is packed."""
    wide, roles = queries._write_wide(spark, SF), {"high_bulk": "HB", "low_bulk": "LB", "window": 2000, "step": 500}
    assert all(p.suffix == ".gz" for p in Path(wide.removeprefix("file://")).glob("part-*"))
    bsa.run_bsa(variants.read_variants(spark, wide), str(tmp_path / "plain"), **roles)
    monkeypatch.setattr(sinks, "PACKED_ROWS", 300)
    bsa.run_bsa(variants.read_variants(spark, wide), str(tmp_path / "packed"), compression="gzip", **roles)
    plain, packed = (_lines(tmp_path / k / "statistics.tsv") for k in ("plain", "packed"))
    assert plain[0] == packed[0] and sorted(plain[1]) == sorted(packed[1]) and len(plain[1]) > 1000 and max(packed[2]) <= 300
    place = lambda line: (line.split("\t")[0], int(line.split("\t")[1]))
    assert list(map(place, packed[1])) == list(map(place, plain[1])) == sorted(map(place, plain[1]))
    assert all(p.suffix == ".gz" for p in (tmp_path / "packed/statistics.tsv").glob("part-*"))


@pytest.mark.parametrize("given", [{"high_parent": "HP", "low_parent": "LP", "high_bulk": "HB", "low_bulk": "LB"}, {"high_bulk": "HB", "low_bulk": "LB"}, {"high_parent": "HP", "low_parent": "LP", "low_bulk": "LB"}])
def test_order_moves_calls_alone(spark, tmp_path, monkeypatch, given):
    """Statistics and thresholds are not in the shuffle that orders variants, unless thresholds are too many to broadcast; the text is the same."""
    moved, wide = [], variants.read_variants(spark, queries._write_wide(spark, SF))
    monkeypatch.setattr(bsa, "in_order", lambda stored, *keys, own=bsa.in_order, **more: moved.append(stored.columns) or own(stored, *keys, **more))
    got = []
    for most in (windows.MAX_LIMITS, 0):
        monkeypatch.setattr(windows, "MAX_LIMITS", most)
        bsa.run_bsa(wide, str(tmp_path / str(most)), window=2000, step=500, **given)
        got.append(_lines(tmp_path / str(most) / "statistics.tsv"))
    values = set(bsa.TWO_BULK_VALUES) | set(bsa.ONE_BULK_VALUES)
    assert not values & set(moved[0]) and values & set(moved[2])
    assert got[0][0] == got[1][0] and sorted(got[0][1]) == sorted(got[1][1]) and len(got[0][1]) > 1000


def test_ranges_of_an_order_are_not_joined(spark, tmp_path, monkeypatch):
    """Rows of a range are bounded where a shuffle has more partitions than the order has ranges, too; columns added in a range are there."""
    monkeypatch.setattr(session, "SORTED_ROWS", 200)
    spark.range(4000).select((F.col("id") * 37 % 4001).alias("k"), "id").write.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        rows = session.in_order(spark.read.parquet(str(tmp_path / "t")), "k", derive=lambda df: df.withColumn("twice", F.col("k") * 2))
        got = [(r.p, r.k, r.twice) for r in rows.withColumn("p", F.spark_partition_id()).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == sorted(got) and len(got) == 4000 and all(b == 2 * a for _, a, b in got)
    assert max(Counter(p for p, _, _ in got).values()) < 300
