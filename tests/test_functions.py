import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bulkloom.functions import genotype, stats

count = st.integers(0, 200)


def _g(a1, b1, a2, b2):
    n1, n2 = a1 + b1, a2 + b2
    if not n1 or not n2:
        return 0.0
    p = (a1 + a2) / (n1 + n2)
    return 2 * sum(o * math.log(o / e) for o, e in ((a1, n1 * p), (b1, n1 * (1 - p)), (a2, n2 * p), (b2, n2 * (1 - p))) if o)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(count, count, count, count), min_size=20, max_size=40))
def test_g_statistic(spark, tables):
    tables = [*tables, (0, 0, 3, 4), (5, 0, 0, 5), (0, 7, 0, 9), (1, 1, 1, 1)]
    df = spark.createDataFrame(tables, "a int, b int, c int, d int")
    got = df.select("*", stats.g_statistic(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("g")).collect()
    for r in got:
        assert abs(r.g - _g(r.a, r.b, r.c, r.d)) < 1e-9
        assert r.g > -1e-9


def test_round6_and_index(spark):
    r = spark.range(1).select(stats.round6(F.lit(0.1234565)).alias("x"), stats.round6(F.lit(-0.0000005)).alias("y"), stats.snp_index(F.lit(1), F.lit(3)).alias("s"), stats.snp_index(F.lit(1), F.lit(0)).alias("z")).first()
    assert (r.x, r.s, r.z) == (0.123457, 0.333333, None)
    assert r.y == -0.000001


def test_genotypes(spark):
    rows = [("A|A", "1,2"), ("A/C", "3"), ("./.", "x,4"), ("A", "1,2,3"), (None, None), ("A/A/A", "")]
    df = spark.createDataFrame(rows, "gt string, ad string").select(genotype.unphased(F.col("gt")).alias("gt"), genotype.lenient_depths(F.col("ad")).alias("ad"))
    got = df.select("gt", "ad", genotype.is_homozygous(F.col("gt")).alias("hom"), genotype.is_called(F.col("gt")).alias("called"), genotype.is_biallelic(F.col("ad")).alias("two")).collect()
    assert [(r.gt, r.ad, r.hom, r.called, r.two) for r in got] == [
        ("A/A", [1, 2], True, True, True), ("A/C", [3], False, True, False), ("./.", [None, 4], True, False, True), ("A", [1, 2, 3], False, True, False), (None, None, None, None, None), ("A/A/A", [None], False, True, False),
    ]


def test_orientation(spark):
    df = spark.createDataFrame([("A", "A/A", [10, 30]), ("A", "C/C", [10, 30])], "ref string, lp string, ad array<int>")
    other, own = genotype.other_allele_depth(F.col("ref"), F.col("lp"), F.col("ad"))
    assert [tuple(r) for r in df.select(other, own).collect()] == [(30, 10), (10, 30)]


def test_effects(spark):
    texts = ["UPSTREAM( HIGH |x)", "plain", "A(LOW|M|c|p|g|b|C|T|E|W|extra),B(HIGH)", "", "()"]
    got = spark.createDataFrame([(t,) for t in texts], "e string").select(genotype.effect_struct(F.col("e")).alias("s")).select("s.*").collect()
    assert [(r.effect, r.impact, r.functional_class, r.warnings) for r in got] == [("UPSTREAM", "HIGH", "x", ""), ("plain", "", "", ""), ("A", "LOW", "M", "W"), ("", "", "", ""), ("", "", "", "")]


def test_variant_type(spark):
    rows = [("A", "C"), ("AC", "GT"), ("A", "AT"), ("AC", "A,GT"), ("A", "C,G")]
    got = spark.createDataFrame(rows, "r string, a string").select(genotype.variant_type(F.col("r"), F.col("a")).alias("t")).collect()
    assert [r.t for r in got] == ["SNP", "MNP", "INDEL", "MIXED", "SNP"]


def test_numbers_are_read_as_by_casts(spark):
    """Texts without a digit are not cast; all else is what the casts give."""
    texts = [None, "", ".", "./.", "7", " 7 ", "+7", "-7", "x7", "7x", "1.5", "99999999999", "3,4", ".,.", "3,.", ",", "٣", "é", "-", ":", "0"]
    t, parts = F.col("t"), F.split("t", ",")
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select("t", genotype.lenient_int(t).alias("n"), F.coalesce(t.try_cast("int"), F.lit(0)).alias("n2"), genotype.lenient_depths(t).alias("a"), parts.try_cast("array<int>").alias("a2"))
    assert all((r.n, r.a) == (r.n2, r.a2) for r in rows.collect()) and rows.schema["a"].dataType == rows.schema["a2"].dataType


def test_types_of_one_alt_and_of_several(spark):
    cases = [("A", "C", "SNP"), ("AC", "GT", "MNP"), ("A", "AC", "INDEL"), ("A", "C,G", "SNP"), ("AC", "GT,TT", "MNP"), ("A", "AC,ACC", "INDEL"), ("A", "C,AC", "MIXED"), ("A", "", "INDEL"), ("A", "C,", "MIXED"), (None, "A", "MIXED"), ("A", None, "MIXED")]
    rows = spark.createDataFrame([c[:2] for c in cases], "r string, a string").select(genotype.variant_type(F.col("r"), F.col("a")).alias("t")).collect()
    assert [r.t for r in rows] == [c[2] for c in cases]
