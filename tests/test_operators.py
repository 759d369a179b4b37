import random

import pytest
from pyspark.sql import functions as F

from bulkloom.operators import callsets, contigs, null_model, qtl, reads, stages, windows
from bulkloom.plans.bsa import choose_design


def _points(spark, ys, limit=1.0):
    rows = [("c", "SNP", i * 10, "SNP-index", float(y), limit, limit, -limit, -limit) for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "chrom string, type string, pos long, statistic string, value double, p99 double, p95 double, p99_low double, p95_low double")


def _peak_by_loop(ys, limit):
    above = [i for i, y in enumerate(ys) if y > limit]
    if not above:
        return None
    top = max(above, key=lambda i: (ys[i], -i))
    cross = [i for i in range(1, len(ys)) if (ys[i - 1] - limit) * (ys[i] - limit) < 0]
    left, right = [i for i in cross if i < top], [i for i in cross if i > top]
    return (left[-1] * 10, right[0] * 10, float(ys[top])) if len(cross) >= 2 and left and right else None


CURVES = [[0, 2, 3, 2, 0], [0, 2, 0], [2, 3, 0], [0, 1, 2, 1, 0], [0, 2, 3, 3, 0, 5, 0, 0], [0, 0], [0, 1.5, 2, 2, 1.2, 0, 2, 0]]


@pytest.mark.parametrize("ys", CURVES + [[random.Random(k).choice([0, 1, 1.5, 2, 3]) for _ in range(14)] for k in range(6)])
def test_qtl_rules(spark, ys):
    """Touching the threshold is no crossing, a crossing at the peak counts for neither side, two crossings are needed."""
    got = {r.threshold: (r.qtl_start, r.qtl_end, r.peak) for r in qtl.call_qtl(_points(spark, ys), qtl.ONE_BULK_SERIES).collect()}
    assert got.get("99per (peak)") == _peak_by_loop(ys, 1.0)
    mirrored = qtl.call_qtl(_points(spark, [-y for y in ys]), qtl.ONE_BULK_SERIES).collect()
    assert {r.threshold: (r.qtl_start, r.qtl_end, -r.peak) for r in mirrored}.get("99per (valley)") == _peak_by_loop(ys, 1.0)


def test_window_forms_agree(spark):
    rng = random.Random(4)
    rows = [("c", rng.choice(["SNP", "INDEL"]), rng.choice([0, 5, 1000, rng.randrange(5000)]), round(rng.random(), 6)) for _ in range(300)]
    df = spark.createDataFrame(rows, "chrom string, type string, pos long, v double")
    for win, step in ((500, 100), (250, 100), (100, 100)):
        want = {}
        for kind in ("SNP", "INDEL"):
            own = [(p, v) for _, t, p, v in rows if t == kind]
            for s in range(0, max(p for p, _ in own) + 1, step):
                if inside := [v for p, v in own if s <= p < s + win]:
                    want[kind, s + win / 2] = (len(inside), sum(inside) / len(inside))
        got = {(r.type, r.centre): (r.n, r.v) for r in windows.window_means(df, ["v"], win, step).collect()}
        assert got.keys() == want.keys()
        assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-6 for k in want)


def test_null_model(spark):
    depths = spark.createDataFrame([(0,), (1,), (40,), (150,)], "n int")
    for p in (0.5, 0.25):
        sums = {r.n: r.s for r in null_model.binomial(depths, p).groupBy("n").agg(F.sum("w").alias("s")).collect()}
        assert sums.keys() == {1, 40, 150} and all(abs(s - 1) < 1e-9 for s in sums.values())
        for r in null_model.one_bulk_thresholds(depths, p).collect():
            assert r.m_p99 <= r.m_p95 <= r.p95 <= r.p99
    pairs = spark.createDataFrame([(40, 45), (45, 40), (40, 45)], "high_dp int, low_dp int")
    got = {(r.high_dp, r.low_dp): r for r in null_model.two_bulk_thresholds(pairs, 0.5, 0.5).collect()}
    assert len(got) == 2 and abs(got[40, 45].dsi_p99 + got[45, 40].dsi_m_p99) < 0.03
    with pytest.raises(ValueError):
        null_model.null_frequency("F9")


def test_designs():
    assert choose_design("a", "b", "c", "d") == "two_bulk"
    assert choose_design(high_bulk="c", low_bulk="d") == "two_bulk_only"
    assert choose_design("a", "b", low_bulk="d") == choose_design("a", "b", "c") == "one_bulk"
    with pytest.raises(ValueError):
        choose_design(high_parent="a", high_bulk="c", low_bulk="d")


def test_unmapped_sets(spark):
    flags = [1 + a + b + c + d for a in (64, 128) for b in (0, 4) for c in (0, 8) for d in (0, 256)]
    df = spark.createDataFrame([(f"r{i}", f) for i, f in enumerate(flags)], "qname string, flag int")
    parts = [reads.flag_filter(df, need, no) for need, no in ((4, 264), (8, 260), (12, 256))]
    assert sorted(map(tuple, callsets.merge_calls(*parts).collect())) == sorted(map(tuple, reads.unmapped_pairs(df).collect()))


def test_cohort_and_sites(spark):
    df = spark.createDataFrame([("c", 1, "A", "C", "s1", "A/C", 9), ("c", 1, "A", "C", "s2", "C/C", 4), ("c", 2, "A", "C", "s2", "A/A", 3)], "chrom string, pos long, ref string, alt string, sample string, gt string, dp int")
    got = {r.pos: (r.s1_gt, r.s2_gt, r.s3_gt, r.s3_dp) for r in callsets.cohort(df, ["s1", "s2", "s3"]).collect()}
    assert got == {1: ("A/C", "C/C", "./.", 0), 2: ("./.", "A/A", "./.", 0)}
    assert callsets.known_sites(df, df).count() == 2


def test_cohort_carries_all_fields(spark):
    df = spark.createDataFrame([("c", 1, "A", "C", "s1", "A/C", [4, 5], 9, 30)], "chrom string, pos long, ref string, alt string, sample string, gt string, ad array<int>, dp int, gq int")
    r = callsets.cohort(df, ["s1", "s2"]).first()
    assert (r.s1_gt, r.s1_ad, r.s1_dp, r.s1_gq, r.s2_gt, r.s2_ad, r.s2_dp, r.s2_gq) == ("A/C", [4, 5], 9, 30, "./.", None, 0, 0)


def test_contigs_in_order_of_their_numbers(spark):
    df = spark.createDataFrame([("chr10", 1), ("chr2", 7), ("X", 1), ("chr2", 3), ("chr1", 9)], "chrom string, pos long")
    assert [tuple(r) for r in callsets.coordinate_sort(df).collect()] == [("chr1", 9), ("chr2", 3), ("chr2", 7), ("chr10", 1), ("X", 1)]


def test_duplicates_by_both_ends(spark):
    """Pairs with equal first ends and different mates are no copies; reads beside a pair's end are; secondary ones never."""
    rows = [("p1", 99, 10, 5), ("p1", 147, 90, 5), ("p2", 99, 10, 50), ("p2", 147, 95, 50), ("p3", 99, 10, 6), ("p3", 147, 90, 6), ("f1", 73, 10, 99), ("f2", 73, 40, 1), ("f3", 73, 40, 2), ("s1", 355, 10, 9), ("u1", 77, 10, 9), ("p4", 163, 90, 6), ("p4", 83, 10, 6)]
    df = spark.createDataFrame([(q, f, "L", "c", at, score) for q, f, at, score in rows], "qname string, flag int, library string, rname string, five_prime long, base_quality_sum long")
    got = {(r.qname, r.flag): r.is_dup for r in reads.mark_duplicates(df).collect()}
    assert len(got) == len(rows)
    assert {k for k, dup in got.items() if dup} == {("p1", 99), ("p1", 147), ("f1", 73), ("f2", 73)}


def test_scaffold_numbers_cross_slices(spark):
    df = spark.range(5).select((F.col("id") * 60_000).alias("contig_no"), F.lit("s").alias("sample"), F.lit("x").alias("name"))
    assert [r.name for r in contigs.rename_scaffolds(df).orderBy("contig_no").collect()] == [f"s_scaff_{i}" for i in range(1, 6)]


def test_pending(spark):
    log = spark.createDataFrame([("p", "s", "c1", "STARTED"), ("p", "s", "c2", "COMPLETED"), ("p", "s", "c2", "COMPLETED")], "program string, sample string, chromosome string, status string")
    assert [r.chromosome for r in stages.pending(stages.work_list(log, log, log), log).collect()] == ["c1"]
