"""Runs that resume, scans that are pruned, streams that are replayed, and files of several kinds side by side."""

import gzip
import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from bulkloom import queries
from bulkloom.operators import callsets, filters, null_model, stages, windows
from bulkloom.plans import calls
from bulkloom.session import SPLIT, tune
from bulkloom.sources import sinks, text, variants, vcf_source
from bulkloom.streaming.stage_status import keep_status, status, upsert_status

from .conftest import SF


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lines_of(folder):
    """Lines of a written folder, its files in order of their names."""
    return [line for p in sorted(Path(folder).glob("part-*")) for line in p.read_text().splitlines()]


# -- thresholds and windows


def quantiles_by_grid(n, m, p, value):
    high, low = null_model.Bulk(n, p), null_model.Bulk(m, p)
    cells = sorted((value(a, b, n, m), high.chance[a] * low.chance[b]) for a in range(n + 1) for b in range(m + 1))
    share, out = np.cumsum([w for _, w in cells]), []
    for _, q in null_model.QUANTILES:
        out.append(cells[int(np.argmax(share >= q - null_model.DUST))][0])
    return out


def g_of(a, b, n, m):
    def cell(o, e):
        return o * np.log(o / e) if o else 0.0

    p = (a + b) / (n + m)
    return round(2 * (cell(a, n * p) + cell(n - a, n * (1 - p)) + cell(b, m * p) + cell(m - b, m * (1 - p))), 6) + 0.0


@pytest.mark.parametrize("p", [0.5, 0.25])
@pytest.mark.parametrize("n, m", [(1, 1), (1, 30), (17, 5), (40, 43), (61, 38), (100, 100)])
def test_sweeps_equal_the_grid(n, m, p):
    shares = np.array([q for _, q in null_model.QUANTILES])
    high, low = null_model.Bulk(n, p), null_model.Bulk(m, p)
    want = quantiles_by_grid(n, m, p, lambda a, b, n, m: int(high.micros[a] - low.micros[b]))
    assert null_model.difference_quantiles(high, low, shares).tolist() == want
    want = quantiles_by_grid(n, m, p, g_of)
    assert np.allclose(null_model.g_quantiles(high, low, shares) / 1e6, want, atol=1.5e-6)
    assert [b.index_quantile(q) for b in (high, low) for q in shares] == [quantiles_by_grid(x, 1, p, lambda a, b, n, m: int(round(a / n * 1e6)))[k] for x in (n, m) for k in range(4)]


def test_deep_pairs_need_no_grid():
    """Twenty thousand by twenty thousand outcomes."""
    high = null_model.Bulk(20_000, 0.5)
    g = null_model.g_quantiles(high, high, np.array([0.995, 0.95]))
    assert abs(g[1] / 1e6 - 3.84) < 0.05 and g[0] > g[1]


def test_counted_windows_equal_windows_of_rows(spark):
    rows = [("c", "SNP", i * 7 % 900, i % 3 + 1, i % 2 + 1, round(i % 11 / 11, 6)) for i in range(400)]
    df = spark.createDataFrame(rows, "chrom string, type string, pos long, d int, e int, v double")
    limits = spark.createDataFrame([(d, e, round(d / e / 7, 6), None if d == 3 else float(d)) for d in (1, 2, 3) for e in (1, 2)], "d int, e int, x double, y double")
    got = windows.means_of_steps(windows.weighted_step_sums(df, ["v"], 50, ["d", "e"], limits, ["x", "y"]), ["v", "x", "y"], 200, 50)
    want = windows.window_means(df.join(limits, ["d", "e"]), ["v", "x", "y"], 200, 50)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 10


def test_long_contigs_are_cut_for_windows(spark, monkeypatch):
    """Windows over segments of a few steps equal those by exploding rows, with gaps longer than a segment; no task holds a whole contig."""
    monkeypatch.setattr(windows, "SEGMENT", 5)
    places = [0, 3, 49, 50, 51, 199, 200, 201, 249, 250, 251, 1300, 1301, 2499, 2500, 4950]
    df = spark.createDataFrame([("c", "SNP", p, round(p % 11 / 11, 6)) for p in places] + [("d", "SNP", 777, 0.5)], "chrom string, type string, pos long, v double")
    for window in (50, 100, 200, 250, 300):
        got = windows.window_means(df, ["v"], window, 50)
        each = df.withColumn("k", F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("pos") - window) / 50) + 1), F.floor(F.col("pos") / 50))))
        want = windows._means(each.groupBy("chrom", "type", "k").agg(F.count("*").alias("n"), *windows._sums(["v"])), ["v"], window, 50)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() >= 10
    assert windows.window_means(df, ["v"], 200, 50)._jdf.queryExecution().optimizedPlan().toString().count("_s#") > 0


def test_rows_of_a_contig_are_not_brought_together(spark):
    """The short-contig rule moves names alone, however large a shuffle Spark would choose, and its join is a broadcast."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([("long", 10 * k) for k in range(50)] + [("short", 7)], "chrom string, pos long")
        kept = filters.drop_short_contigs(df, 100, 50)
        assert "SortMergeJoin" not in plan_of(kept) and {r.chrom for r in kept.collect()} == {"long"} and kept.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_calls_move_once_by_site(spark):
    """Rows are dealt over the cores, then by site, before there is a call for each sample; grouping by site and sample, and by site, moves nothing more."""
    assert plan_of(queries.cohort_combine(spark, SF)).count("Exchange hashpartitioning(") == 2


def test_buckets_follow_the_table(spark, monkeypatch):
    """A stored cohort has as many buckets as its sites ask for, so a task's bucket stays as large as it is."""
    monkeypatch.setattr(queries, "SITES_OF_BUCKET", 400)
    seen, own = [], callsets.store_cohort
    monkeypatch.setattr(callsets, "store_cohort", lambda rows, name, at, buckets: seen.append(buckets) or own(rows, name, at, buckets))
    assert queries.cohort_grown(spark, SF).count() > 0 and seen == [-(-spark.read.parquet(f"{SF}/lineitem.parquet").count() // 400)]


def test_splits_are_small(spark):
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for given, want in (("128MB", SPLIT), ("1MB", 1 << 20)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", given)
            assert tune(spark)._jsparkSession.sessionState().conf().filesMaxPartitionBytes() == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


# -- runs


def raw_calls(spark):
    rows = [(f"c.{k % 6}", 1000 - k, "A", "C" if k % 4 else "CT", "SNP" if k % 4 else "INDEL", 50.0 if k % 7 else 1.0, 9.0, 1.0, 1.0, 60.0, 0.0, 0.0) for k in range(300)]
    rows += [("c.bad", 5, "A", "C", "SNP", 1.0, 9.0, 1.0, 1.0, 60.0, 0.0, 0.0)]  # loses all its calls
    return spark.createDataFrame(rows, "chrom string, pos long, ref string, alt string, type string, qual double, qd double, fs double, sor double, mq double, mq_rank_sum double, read_pos_rank_sum double")


def test_a_run_resumes(spark, tmp_path):
    raw, out, log = (str(tmp_path / x) for x in ("raw", "out", "log"))
    calls.lay_out(raw_calls(spark), raw)
    done = lambda: {r.chromosome for r in stages.completed(text.read_stage_log(spark, log)).where("program = 'PostProcess'").collect()}
    first = calls.resume_calls(spark, raw, out, log, batch=3, rounds=1)
    assert done() == {"c_0", "c_1", "c_2"} and {r.contig for r in first.select("contig").distinct().collect()} == done()
    # a run that broke has left a part of the next contig; it is replaced
    spark.read.parquet(raw).where("contig = 'c_3'").limit(5).write.mode("append").partitionBy("contig").parquet(out)
    before = {p: p.stat().st_mtime_ns for p in Path(out).glob("contig=c_[012]/*.parquet")}
    rows = calls.resume_calls(spark, raw, out, log, batch=2)
    assert done() == {*(f"c_{k}" for k in range(6)), "c_bad"}
    assert {p: p.stat().st_mtime_ns for p in Path(out).glob("contig=c_[012]/*.parquet")} == before  # finished contigs are left alone
    key = lambda df: sorted(map(tuple, df.select("chrom", "pos", "ref", "alt", "type").collect()))
    assert key(rows) == key(callsets.filtered_calls(raw_calls(spark)))
    lines = text.read_stage_log(spark, log).count()
    assert key(calls.resume_calls(spark, raw, out, log)) == key(rows)
    assert text.read_stage_log(spark, log).count() == lines + 1  # nothing but the start of a run without work


def test_run_calls_with_a_log(spark, tmp_path):
    (tmp_path / "a.vcf").write_text("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS\n" + "".join(f"c{i % 3}\t{i}\t.\tA\tC\t{i}\t.\tQD=9;MQ=60\tGT\t0/1\n" for i in range(90)))
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    assert calls.run_calls(spark, str(tmp_path / "a.vcf"), out, log, rounds=1, batch=1).count() == 20
    (tmp_path / "a.vcf").unlink()  # the raw calls are laid out already
    assert calls.run_calls(spark, str(tmp_path / "a.vcf"), out, log).count() == 60


def test_pending_contigs_prune_the_scan(spark, tmp_path):
    calls.lay_out(raw_calls(spark), str(tmp_path / "raw"))
    spark.createDataFrame([("c_1", "PENDING"), ("c_2", "DONE")], "contig string, status string").write.parquet(str(tmp_path / "units"))
    out = stages.chosen_partitions(spark.read.parquet(str(tmp_path / "raw")), "contig", spark.read.parquet(str(tmp_path / "units")).where("status = 'PENDING'"))
    assert {r.chrom for r in out.select("chrom").distinct().collect()} == {"c.1"}
    assert "dynamicpruning" in plan_of(out)


def test_contig_ends_come_from_footers(spark, tmp_path):
    calls.lay_out(raw_calls(spark), str(tmp_path / "raw"))
    ends = filters.stored_contig_ends(spark, str(tmp_path / "raw"))
    assert {r.contig: r.max_pos for r in ends.collect()} == {"c_bad": 5} | {f"c_{k}": 1000 - k for k in range(6)}
    assert "PushedAggregation: [MAX(pos)]" in plan_of(ends) and "FileScan" in plan_of(spark.read.parquet(str(tmp_path / "raw")))
    rows = filters.long_stored_contigs(spark, str(tmp_path / "raw"), 900, 97)
    assert {r.chrom for r in rows.collect()} == {"c.0", "c.1", "c.2"} and "dynamicpruning" in plan_of(rows)


def test_a_cohort_grows_without_moving(spark, tmp_path):
    schema = "chrom string, pos long, ref string, alt string, gt string, ad array<int>, dp int, gq int"
    one = spark.createDataFrame([("c", k, "A", "C", "A/C", [1, k], k, 9) for k in range(50)], schema)
    two = spark.createDataFrame([("c", k, "A", "C", "C/C", [0, k], k, 8) for k in range(40, 60)], schema)
    callsets.store_cohort(callsets.sample_column(one, "s.1"), "cohort_of_test", str(tmp_path / "t"), 4)
    grown = callsets.grow_cohort(spark.table("cohort_of_test"), two, "s2", 4)
    conf = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        stored, new = plan_of(grown).split("Bucketed: true")[0], plan_of(grown)
        assert "Exchange" not in stored and new.count("Exchange") == 1
    finally:
        spark.conf.set(conf, was)
    got = {r.pos: (r["s.1_gt"], r["s.1_dp"], r.s2_gt, r.s2_ad) for r in callsets.flat_cohort(grown).collect()}
    assert got == {k: ("A/C" if k < 50 else "./.", k if k < 50 else 0, "C/C" if k >= 40 else "./.", [0, k] if k >= 40 else None) for k in range(60)}


# -- status as a stream


def test_status_after_each_drop_and_a_replay(spark, tmp_path):
    log_at, table, state = (str(tmp_path / x) for x in ("log", "table", "state"))
    work = spark.createDataFrame([(p, s, "c1") for p in "ab" for s in "xyz"], "program string, sample string, chromosome string")
    line = lambda p, s, st: (p, s, "c1", st)
    drops = [[line("a", "x", "COMPLETED"), line("a", "y", "STARTED")], [line("a", "y", "FAILED")], [line("a", "y", "COMPLETED"), line("b", "z", "COMPLETED"), line("q", "q", "COMPLETED")], [line("a", "x", "COMPLETED")]]
    for drop in drops:
        df = spark.createDataFrame(drop, "program string, sample string, chromosome string, status string")
        sinks.append_stage_log(df.select(F.current_timestamp().alias("time"), F.lit("t").alias("tool"), "*", F.lit("").alias("cmd")), log_at)
        keep_status(work, text.read_stage_log(spark, log_at, stream=True), table, state)
        rows = status(spark, table)
        assert rows.count() == 6
        want = stages.pending(work, text.read_stage_log(spark, log_at))
        assert sorted(map(tuple, rows.where("NOT done").select(*stages.KEYS).collect())) == sorted(map(tuple, want.collect()))
    last = spark.read.parquet(table).agg(F.max("batch")).first()[0]
    before = sorted(map(tuple, status(spark, table).collect()))
    again = spark.createDataFrame(drops[-1], "program string, sample string, chromosome string, status string")
    upsert_status(work, again, last, table)  # a batch that comes again
    assert sorted(map(tuple, status(spark, table).collect())) == before and len(before) == 6


def test_rejected_log_lines(spark, tmp_path):
    good = {"time": "2024-02-03T04:05:06Z", "msg": "m", "PROGRAM": "p", "SAMPLE": "s", "CHROMOSOME": "c", "STATUS": "STARTED"}
    (tmp_path / "log").mkdir()
    (tmp_path / "log/a.json").write_text("\n".join([json.dumps(good), "{broken", "", json.dumps({k: v for k, v in good.items() if k != "SAMPLE"}), json.dumps(good | {"time": "late"})]) + "\n")
    got = {r.reason: r.file for r in text.rejected_log_lines(spark, str(tmp_path / "log")).collect()}
    assert got == {"no JSON": "a.json", "no SAMPLE": "a.json", "no time": "a.json"}
    assert [r.of for r in text.read_stage_log(spark, str(tmp_path / "log"), file_column="of").collect()] == ["a.json"]


# -- VCF files


def vcf(samples, rows, head="##x\n"):
    return head + "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + "\t".join(samples) + "\n" + "".join("\t".join(map(str, r)) + "\n" for r in rows)


def test_ranges_of_a_file_hold_each_line_once(tmp_path, monkeypatch):
    body = vcf(["s"], [("c", k, ".", "A", "C" * (k % 40 + 1), 9, ".", "", "GT", "0/1") for k in range(200)])
    for end in ("\n", ""):
        (tmp_path / "a.vcf").write_text(body.rstrip("\n") + end)
        h = vcf_source.header_of(f"file://{tmp_path}/a.vcf")
        size = (tmp_path / "a.vcf").stat().st_size
        for chunk in (1 << 20, 64, 7):
            monkeypatch.setattr(vcf_source, "CHUNK", chunk)
            for step in (1, 13, 100, 5000, size):
                got = b"".join(x for at in range(0, size, step) for x in vcf_source.whole_lines(vcf_source.Range(h, at, min(at + step, size))))
                assert got.decode().rstrip("\n") == body.rstrip("\n")


def test_files_with_other_samples_are_united(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(vcf(["S1", "S2"], [("c", 1, ".", "A", "C", 9, ".", "QD=3", "GT:DP", "0/1:4", "1|1:5")]))
    (tmp_path / "b.vcf.gz").write_bytes(gzip.compress(vcf(["S3", "S1"], [("c", 2, ".", "A", "C", 9, ".", "DB", "DP:GT", "6:0/0", "7:./.")], head="").encode()))
    (tmp_path / "c.vcf").write_text("")
    spark.sparkContext.setJobGroup("planning", "planning")
    df = variants.read_vcf(spark, str(tmp_path), info=("QD",), file_column="of")
    long_ = variants.read_vcf_long(spark, str(tmp_path))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []  # headers alone were read
    spark.sparkContext.setJobGroup("other", "other")
    a, b = df.orderBy("POS").collect()
    assert variants.samples(df) == ["S1", "S2", "S3"]
    assert (a["S1.GT"], a["S2.GT"], a["S3.GT"], a["S3.DP"], a["QD"], a["of"]) == ("A/C", "C|C", "./.", "", "3", "a.vcf")
    assert (b["S1.GT"], b["S1.DP"], b["S2.GT"], b["S3.GT"], b["S3.DP"], b["QD"], b["of"]) == ("./.", "7", "./.", "A/A", "6", None, "b.vcf.gz")
    assert sorted((r.pos, r["sample"], r.gt, r.dp) for r in long_.collect()) == [(1, "S1", "A/C", 4), (1, "S2", "C/C", 5), (2, "S1", "./.", 7), (2, "S3", "A/A", 6)]
    assert variants.read_vcf_long(spark, str(tmp_path), missing=False).count() == 3


def test_vcf_errors(spark, tmp_path):
    (tmp_path / "none.vcf").write_text("##x\nc\t1\n")
    with pytest.raises(Exception, match="no #CHROM line"):
        variants.read_vcf(spark, str(tmp_path / "none.vcf"))
    (tmp_path / "ragged.vcf").write_text(vcf(["s"], [("c", 1, ".", "A", "C", 9, ".", "", "GT", "0/1"), ("c", 2)]))
    with pytest.raises(Exception, match="Expected 10 columns"):
        variants.read_vcf(spark, str(tmp_path / "ragged.vcf")).collect()


def test_roles_of_many_samples(spark, tmp_path):
    names = [f"s{k}" for k in range(300)]
    (tmp_path / "a.vcf").write_text(vcf(names, [("c", p, ".", "A", "C", 9, ".", "", "GT:AD:DP", *(f"0/1:{k},{p}:{k + p}" for k in range(300))) for p in (5, 5, 6)]))
    long_ = variants.read_vcf_long(spark, str(tmp_path / "a.vcf"))
    assert len(long_.columns) == 12
    out = variants.assign_roles_long(long_, spark.createDataFrame([("HIGH_BULK", "s7"), ("low_bulk", "s200"), ("high_parent", "nobody")], "role string, sample string"))
    assert sorted((r.pos, r.hb_ad, r.lb_dp, r.hp_gt) for r in out.collect()) == [(5, [7, 5], 205, None), (5, [7, 5], 205, None), (6, [7, 6], 206, None)]
    with pytest.raises(ValueError):
        variants.assign_roles_long(long_, spark.createDataFrame([("middle", "s7")], "role string, sample string"))


def test_roles_of_vcf_lines(spark, tmp_path):
    """The same as from long calls, for files of different samples, odd cells and roles without a sample; no row moves."""
    odd = ["0/1:3,4:7:9", "1|2:.:.:.", "./.", ".", "", "0", "0/1/2:1,x,3:+5: 6", "10|0:1,2:99999999999:1.5", "//1", "2/|:,:-3:x", "|:0,1", "é/1:7:7:7"]
    row = lambda p, *cells: ("c", p, ".", "A", "C,GT", "." if p % 2 else 9, ".", "", "GT:AD:DP:GQ" if p % 3 else "AD:DP", *cells)
    (tmp_path / "a.vcf").write_text(vcf(["s1", "s2"], [row(p, cell, odd[-p]) for p, cell in enumerate(odd)]))
    (tmp_path / "b.vcf").write_text(vcf(["s2", "s3"], [row(p, cell, cell) for p, cell in enumerate(odd, 100)]))
    (tmp_path / "c.vcf").write_text(vcf(["s4"], [row(1, "0/0")]))
    for pairs in ([("HIGH_BULK", "s1"), ("low_bulk", "s3"), ("high_parent", "nobody")], [("bulk", "s2"), ("low_parent", "s2")], [("bulk", "nobody")]):
        roles = spark.createDataFrame(pairs, "role string, sample string")
        got, want = variants.read_vcf_roles(spark, str(tmp_path), roles), variants.assign_roles_long(variants.read_vcf_long(spark, str(tmp_path)), roles)
        assert "Exchange" not in got._jdf.queryExecution().toString()
        assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert got.count() == {"HIGH_BULK": 2, "bulk": 2}[pairs[0][0]] * len(odd) * (pairs[0][1] != "nobody")
    called = {r.pos: r for r in variants.read_vcf_roles(spark, str(tmp_path / "a.vcf"), spark.createDataFrame([("bulk", "s1")], "role string, sample string")).collect()}
    assert [called[p].b_gt for p in range(12)] == ["./.", "C/GT", "./.", "./.", ".", "A", "./.", "./A", "././C", "./.", "./.", "./C"]
    assert [called[p].b_ad for p in (1, 4, 7, 10)] == [[None], [None], [1, 2], [0, 1]] and (called[7].b_dp, called[7].b_gq) == (0, 0)
    assert "Exchange" not in queries.roles_long(spark, SF)._jdf.queryExecution().toString().split("Physical Plan")[-1]


# -- other files


def test_libraries_belong_to_their_file(spark, tmp_path):
    for name, library in (("a", "libA"), ("b", "libB")):
        (tmp_path / f"{name}.sam").write_text(f"@HD\tVN:1\n@RG\tID:1\tLB:{library}\n@CO\tnone\nr{name}\t0\tc\t1\t9\t4M\t*\t0\t0\tACGT\tIIII\tRG:Z:1\n")
    (tmp_path / "c.sam").write_text("rc\t0\tc\t1\t9\t4M\t*\t0\t0\tACGT\tIIII\tRG:Z:1\n")
    got = {r.qname: (r.library, r.of) for r in text.read_sam(spark, str(tmp_path), file_column="of").collect()}
    assert got == {"ra": ("libA", "a.sam"), "rb": ("libB", "b.sam"), "rc": ("1", "c.sam")}


def test_headers_of_all_effect_files(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("CHROM\tPOS\tEFF\nc\t1\tX(LOW)\n")
    (tmp_path / "b.tsv").write_text("CHROM\tPOS\tEFF\nc\t2\tY(LOW)\nbad\n")
    rows, rejected = text.read_effects(spark, str(tmp_path), file_column="of")
    assert sorted((r.POS, r.of) for r in rows.collect()) == [("1", "a.tsv"), ("2", "b.tsv")] and [tuple(r) for r in rejected.collect()] == [("bad", "b.tsv")]
    (tmp_path / "c.tsv").write_text("POS\tCHROM\tEFF\n7\tchr9\tX(LOW)\n")
    with pytest.raises(ValueError, match="differ"):
        text.read_effects(spark, str(tmp_path))


@pytest.mark.parametrize("split", [None, "50b"])
def test_fasta_over_files_and_splits(spark, tmp_path, split):
    want, no = [], 0
    for f in range(3):
        parts = ["no contig\n"] if f == 1 else []
        for k in range(4):
            seq = "".join("ACGT"[(i * (k + 2) + f) % 4] for i in range(0 if k == 3 else 37 * (k * 9 + f)))
            parts.append(f">c{f}.{k} more > words\n" + "".join(seq[i : i + 20] + "\r\n" for i in range(0, len(seq), 20)))
            want.append((no, f"c{f}.{k}", seq))
            no += 1
        (tmp_path / f"{f}.fa").write_bytes("".join(parts).encode())
    conf = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "64"} if split else {}
    was = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        contigs, chunks = text.read_fasta_chunks(spark, str(tmp_path), lines=3)
        got = {r.contig_no: "" for r in contigs.collect()}
        for r in chunks.orderBy("contig_no", "offset").collect():
            assert len(got[r.contig_no]) == r.offset and len(r.chunk) <= 60
            got[r.contig_no] += r.chunk
        assert sorted((r.contig_no, r.name, got[r.contig_no], r.length) for r in contigs.collect()) == [(i, n, s, len(s)) for i, n, s in want]
        sinks.write_fasta_chunks(contigs, chunks, str(tmp_path / "again"))
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "".join(x + "\n" for x in lines_of(tmp_path / "again") if x).replace("\n", "") == "".join(f">{n}{s}" for _, n, s in want)
    whole = text.read_fasta(spark, [str(tmp_path / "0.fa"), str(tmp_path / "2.fa")], file_column="of")
    assert [(r.contig_no, r.name, r.seq, r.of) for r in whole.orderBy("contig_no").collect()] == [(i, n, s, f"{2 * (i // 4)}.fa") for i, (_, n, s) in enumerate(want[:4] + want[8:])]


def test_written_fasta_holds_whole_contigs(spark, tmp_path):
    """Contigs of many chunks, more than a task's share: no file begins with the rest of a contig."""
    contigs = spark.createDataFrame([(k, f"c{k}") for k in range(7)], "contig_no long, name string")
    chunks = spark.createDataFrame([(k, 4 * i, f"{'ACGT'[k % 4]}C{'ACGT'[i % 4]}T") for k in range(7) for i in range(31 + k)], "contig_no long, offset long, chunk string").repartition(5)
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_fasta_chunks(contigs, chunks, str(tmp_path / "c"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    files = [f.read_text() for f in sorted((tmp_path / "c").glob("part-*")) if f.stat().st_size]
    assert len(files) > 1 and all(f.startswith(">") for f in files)
    got = {r.contig_no: (r.name, r.length) for r in text.read_fasta_chunks(spark, str(tmp_path / "c"))[0].collect()}
    assert got == {k: (f"c{k}", 4 * (31 + k)) for k in range(7)}


def test_headed_files_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Each file begins with the head, an empty table gives the head alone, and lines keep to their tasks and order."""
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", None)
    lines = spark.range(0, 1000, 1, 7).select(F.concat(F.lit("line"), "id").alias("value"))
    for name, given, want in (("a", lines, 1000), ("b", lines.where("id % 1000 > 990"), 9), ("c", lines.limit(0), 0)):
        at = queries._write_text(given, "#one\n#two", str(tmp_path / name))
        files = [f.read_text() for f in sorted(Path(at).glob("part-*")) if f.stat().st_size]
        assert all(f.startswith("#one\n#two\n") and f.count("#") == 2 for f in files) and sum(f.count("line") for f in files) == want
        for f in files:
            own = [int(x[4:]) for x in f.splitlines()[2:]]
            assert own == sorted(own)


def test_order_of_written_files(spark, tmp_path):
    """Reads by name and statistics by place, as they stand in the files."""
    reads = spark.createDataFrame([(f"r{(k * 37) % 500:03d}", 77 if k % 2 else 141, "ACGT", "IIII") for k in range(1000)], "qname string, flag int, seq string, qual string").repartition(5)
    sinks.write_fastq_pair(reads, str(tmp_path / "1"), str(tmp_path / "2"))
    for mate in "12":
        names = [x for x in lines_of(tmp_path / mate) if x.startswith("@")]
        assert names == sorted(names) and len(names) == 500
    rows = spark.createDataFrame([(f"c{k % 3}", (k * 71) % 997) for k in range(900)], "chrom string, pos long").repartition(4)
    sinks.write_tsv(rows.orderBy("chrom", "pos"), str(tmp_path / "t"))
    places = [(x.split("\t")[0], int(x.split("\t")[1])) for x in lines_of(tmp_path / "t") if x != "chrom\tpos"]
    assert places == sorted(places) and len(places) == 900
