import gzip
import json

import pytest

from bulkloom.plans.bsa import run_bsa
from bulkloom.plans.pangenome import annotated_table
from bulkloom.sources import sinks, text, variants
from bulkloom.streaming.stage_status import completed_of

from bulkloom.operators.stages import completed

HEADER = "CHROM\tPOS\tREF\tALT\tQUAL\tTYPE\tHP.1.GT\tHP.1.AD\tHP.1.DP\tLP.GT\tLP.AD\tLP.DP\tHB.GT\tHB.AD\tHB.DP\tLB.GT\tLB.AD\tLB.DP\n"


def _wide(path, n=300):
    lines = [f"c1\t{i * 100}\tA\tG\t50\tSNP\tG|G\t0,9\t9\tA/A\t8,0\t8\tA/G\t{50 - k},{k}\t50\tA/G\t{30 + k // 9},{20 - k // 9}\t50" for i in range(n) for k in [25 + (20 if 120 < i < 160 else i % 3)]]
    path.write_text(HEADER + "\n".join(lines) + "\n")


def test_wide_table(spark, tmp_path):
    p = tmp_path / "v.tsv"
    _wide(p, 5)
    df = variants.read_wide(spark, str(p))
    assert variants.samples(df) == ["HP.1", "LP", "HB", "LB"]
    assert [tuple(r) for r in variants.sample_table(df).collect()][:2] == [(0, "None"), (1, "HP.1")]
    r = variants.assign_roles(df, high_parent="HP.1", low_parent="LP", high_bulk="HB", low_bulk="LB").orderBy("pos").first()
    assert (r.hp_gt, r.hp_ad, r.hb_dp, r.pos) == ("G/G", [0, 9], 50, 0)
    with pytest.raises(ValueError):
        variants.assign_roles(df, high_parent="nobody")
    (tmp_path / "twice.tsv").write_text("CHROM\tPOS\tpos\nc\t1\t2\n")
    with pytest.raises(ValueError):
        variants.read_wide(spark, str(tmp_path / "twice.tsv"))
    (tmp_path / "ragged.tsv").write_text(HEADER + "c1\t5\n")
    with pytest.raises(Exception):
        variants.read_wide(spark, str(tmp_path / "ragged.tsv")).collect()


def test_roles_table(spark):
    df = spark.createDataFrame([("HIGH_BULK", "a"), ("LOW_BULK", "b")], "role string, sample string")
    assert variants.resolve_roles(df) == {"high_bulk": "a", "low_bulk": "b"}
    with pytest.raises(ValueError):
        variants.resolve_roles(spark.createDataFrame([("MIDDLE", "a")], "role string, sample string"))


VCF = "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS.1\tS2\nc1\t10\t.\tA\tC,G\t40\t.\tDB;EFF=X(LOW|a)\tGT:AD:DP:GQ\t1|2:1,2,3:6:9\t./.:0,0:0\nc1\t20\t.\tA\tAT\t30\t.\tQD=2\tGT:DP\t0/1:7\t0:3\n"


@pytest.mark.parametrize("packed", [False, True])
def test_vcf(spark, tmp_path, packed):
    p = tmp_path / ("v.vcf.gz" if packed else "v.vcf")
    p.write_bytes(gzip.compress(VCF.encode()) if packed else VCF.encode())
    a, b = variants.read_variants(spark, str(p), info=("EFF", "QD")).orderBy("POS").collect()
    assert (a["S.1.GT"], a["S.1.AD"], a["S2.GT"], a["S2.GQ"], a["TYPE"], a["EFF"], a["QD"]) == ("C|G", "1,2,3", "./.", "", "SNP", "X(LOW|a)", None)
    assert (b["S.1.GT"], b["S.1.AD"], b["S.1.DP"], b["S2.GT"], b["TYPE"], b["QD"]) == ("A/AT", "", "7", "A", "INDEL", "2")


def test_effect_table(spark, tmp_path):
    (tmp_path / "e.txt").write_text("CHROM\tEFF\tPOS\nc1\tX(HIGH|m)\t5\nbad\n")
    rows, rejected = text.read_effects(spark, str(tmp_path / "e.txt"))
    out = annotated_table(rows)
    assert out.columns[:3] == ["CHROM", "POS", "SNPEFF_EFFECT"] and len(out.columns) == 13
    assert (out.first()["SNPEFF_EFFECT"], out.first()["SNPEff_IMPACT"], rejected.count()) == ("X", "HIGH", 1)


def _line(time, program, sample, chromosome, status):
    return json.dumps({"time": time, "level": "INFO", "msg": "night run", "PROGRAM": program, "SAMPLE": sample, "CHROMOSOME": chromosome, "STATUS": status})


LOG = [
    _line("2024-02-03T04:05:06.5Z", "prepare", "all", "all", "STARTED"), _line("2024-02-03T04:06:00Z", "count", "left.bam", "7", "STARTED"), _line("2024-02-03T05:00:00.25+01:00", "count", "left.bam", "7", "COMPLETED"),
    _line("2024-02-03T04:09:00Z", "count", "left.bam", "9", "STARTED"), _line("2024-02-03T04:10:00Z", "count", "left.bam", "7", "COMPLETED"), "", "{broken", json.dumps({"time": "2024-02-03T04:11:00Z", "msg": "no keys"}),
]


def test_stage_log_batch_and_stream(spark, tmp_path):
    at = tmp_path / "log"
    at.mkdir()
    (at / "a.json").write_text("\n".join(LOG) + "\n")
    log = text.read_stage_log(spark, str(at))
    assert log.count() == 5
    want = [("count", "left.bam", "7")]
    assert [tuple(r) for r in completed(log).collect()] == want
    stream = text.read_stage_log(spark, str(at), stream=True)
    assert [tuple(r) for r in completed_of(spark, stream, str(tmp_path / "out"), str(tmp_path / "state")).collect()] == want
    sinks.append_stage_log(log, str(at))
    assert text.read_stage_log(spark, str(at)).count() == 10


def test_fasta_round_trip(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">a first len>5\nACGT\nAC\n>b\r\nTT\r\n>c>d\n\nG\n")
    df = text.read_fasta(spark, str(tmp_path / "x.fa"))
    want = [("a", "ACGTAC", 6), ("b", "TT", 2), ("c>d", "G", 1)]
    assert [(r.name, r.seq, r.length) for r in df.orderBy("contig_no").collect()] == want
    sinks.write_fasta(df, str(tmp_path / "y"))
    assert [(r.name, r.seq, r.length) for r in text.read_fasta(spark, str(tmp_path / "y")).orderBy("contig_no").collect()] == want


def test_sam_and_fastq(spark, tmp_path):
    (tmp_path / "x.sam").write_text("@HD\tx\nr1\t69\t*\t0\t0\t*\t*\t0\t0\tACG\tIJK\nr1\t153\tc\t5\t9\t3M\t*\t0\t0\tAAG\tXYZ\n")
    df = text.read_sam(spark, str(tmp_path / "x.sam"))
    assert [r.value for r in sinks.fastq_lines(df, 1).collect()] == ["@r1/1\nACG\n+\nIJK"]
    assert [r.value for r in sinks.fastq_lines(df, 2).collect()] == ["@r1/2\nCTT\n+\nZYX"]


def test_read_groups_and_places(spark, tmp_path):
    lines = ["@HD\tVN:1.6", "@RG\tID:g1\tSM:s\tLB:one", "@RG\tID:g2\tSM:s", "a\t99\tc\t100\t9\t5S20M2D3M4S\t=\t200\t0\tACGT\t+5?I\tRG:Z:g1", "a\t147\tc\t200\t9\t2H3S10M5S\t=\t100\t0\tACGT\t!!!!\tRG:Z:g2", "@odd\t0\tc\t7\t9\t4M\t*\t0\t0\tACGT\t*"]
    (tmp_path / "x.sam").write_text("\n".join(lines) + "\n")
    got = [(r.qname, r.library, r.five_prime, r.base_quality_sum, r.of) for r in text.read_sam(spark, str(tmp_path / "x.sam"), file_column="of").orderBy("pos").collect()]
    assert got == [("@odd", "unknown", 7, 0, "x.sam"), ("a", "one", 95, 20 + 30 + 40, "x.sam"), ("a", "g2", 214, 0, "x.sam")]


def test_several_files(spark, tmp_path):
    for name, head, row in (("a.tsv", "x\tEFF", "1\tA(LOW)"), ("b.tsv", "x\tEFF", "x\tEFF"), ("c.tsv", "EFF\tx", "B\t2")):
        (tmp_path / name).write_text(f"{head}\n{row}\n")
    rows, rejected = text.read_effects(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")])
    assert sorted(map(tuple, rows.collect())) == [("1", "A(LOW)"), ("x", "EFF")] and rejected.count() == 0
    with pytest.raises(ValueError):
        text.read_effects(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "c.tsv")])
    for name, at in (("a.vcf", 3), ("b.vcf", 4)):
        (tmp_path / name).write_text(f"#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\nc\t{at}\t.\tA\tC\t.\t.\tQD=1.5\n")
    got = [tuple(r) for r in variants.read_calls(spark, [str(tmp_path / n) for n in ("a.vcf", "b.vcf")], file_column="file").orderBy("pos").select("pos", "qual", "qd", "fs", "type", "file").collect()]
    assert got == [(3, None, 1.5, None, "SNP", "a.vcf"), (4, None, 1.5, None, "SNP", "b.vcf")]
    _wide(tmp_path / "one.tsv", 2)
    _wide(tmp_path / "two.tsv", 1)
    names = variants.read_wide(spark, [str(tmp_path / "one.tsv"), str(tmp_path / "two.tsv")], file_column="file").groupBy("file").count().collect()
    assert {r["file"]: r["count"] for r in names} == {"one.tsv": 2, "two.tsv": 1}


def test_whole_run(spark, tmp_path):
    _wide(tmp_path / "v.tsv")
    df = variants.read_variants(spark, str(tmp_path / "v.tsv"))
    out = str(tmp_path / "out")
    assert run_bsa(df, out, high_parent="HP.1", low_parent="LP", high_bulk="HB", low_bulk="LB", window=2000, step=500) == "two_bulk"
    table = spark.read.csv(f"{out}/statistics.tsv", sep="\t", header=True)
    assert len(table.columns) == 35 and [int(r.POS) for r in table.collect()] == list(range(0, 30_000, 100))
    centres = [r.centre for r in spark.read.parquet(f"{out}/windows").collect()]
    assert centres == sorted(centres) and len(centres) > 10
    qtl = spark.read.csv(f"{out}/qtl_SNP.tsv", sep="\t", header=True)
    assert qtl.columns == ["CHROM", "QTLstart", "QTLend", "PEAK", "STATISTIC", "THRESHOLD"]
    peak = [r for r in qtl.collect() if r.STATISTIC == "High-SNP-index" and r.THRESHOLD == "95per (peak)"]
    assert len(peak) == 1 and 10_000 < int(peak[0].QTLstart) < 14_000 < int(peak[0].QTLend) < 18_000
    assert run_bsa(df, str(tmp_path / "b"), high_bulk="HB", low_bulk="LB", window=2000, step=500) == "two_bulk_only"
    assert len(spark.read.csv(str(tmp_path / "b/statistics.tsv"), sep="\t", header=True).columns) == 29
    assert run_bsa(df, str(tmp_path / "c"), high_parent="HP.1", low_parent="LP", low_bulk="LB", window=2000, step=500) == "one_bulk"
    assert len(spark.read.csv(str(tmp_path / "c/statistics.tsv"), sep="\t", header=True).columns) == 19
