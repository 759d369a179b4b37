"""Genetics tables derived from the star schema: one SQL text for each, valid in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.genotype import lenient_depths, unphased
from .session import tune

VARIANTS = """
SELECT chrom, pos, ref, alt, qual, type, qd, fs, sor, mq, mq_rank_sum, read_pos_rank_sum,
  CASE WHEN l_returnflag = 'R' THEN concat(alt, '|', alt) WHEN l_partkey % 13 = 0 THEN './.' ELSE concat(ref, '/', ref) END AS hp_gt,
  CASE WHEN l_returnflag = 'R' THEN concat(ref, '/', ref) WHEN l_partkey % 17 = 0 THEN concat(ref, '/', alt) ELSE concat(alt, '/', alt) END AS lp_gt,
  CASE WHEN l_partkey % 31 = 0 THEN './.' ELSE concat(ref, '/', alt) END AS hb_gt,
  concat(ref, '|', alt) AS lb_gt,
  hp_dp, lp_dp, hb_dp, lb_dp,
  CASE WHEN l_returnflag = 'R' THEN concat('0,', hp_dp) ELSE concat(hp_dp, ',0') END AS hp_ad,
  CASE WHEN l_returnflag = 'R' THEN concat(lp_dp, ',0') ELSE concat('0,', lp_dp) END AS lp_ad,
  CASE WHEN l_partkey % 29 = 0 THEN concat(hb_dp - 2, ',1,1')
       WHEN l_returnflag = 'R' THEN concat(hb_dp - h, ',', h) ELSE concat(h, ',', hb_dp - h) END AS hb_ad,
  CASE WHEN l_returnflag = 'R' THEN concat(lb_dp - l, ',', l) ELSE concat(l, ',', lb_dp - l) END AS lb_ad
FROM (
  SELECT *,
    least(hb_dp, greatest(0, CAST(floor(hb_dp * (0.5 + sig)) AS INT) + CAST((l_partkey * 7) % 9 AS INT) - 4)) AS h,
    least(lb_dp, greatest(0, CAST(floor(lb_dp * (0.5 - sig)) AS INT) + CAST((l_partkey * 5) % 9 AS INT) - 4)) AS l
  FROM (
    SELECT concat('chr', l_suppkey % 5 + 1) AS chrom, l_orderkey * 100 + l_linenumber AS pos,
      substr('ACGT', CAST(l_partkey % 4 AS INT) + 1, 1) AS ref,
      substr('ACGT', CAST((l_partkey + 1 + l_suppkey % 3) % 4 AS INT) + 1, 1) AS alt,
      CASE WHEN l_linenumber % 4 = 0 THEN 'INDEL' ELSE 'SNP' END AS type,
      l_extendedprice / 100.0 AS qual, l_discount * 100.0 AS qd, l_quantity * 5.0 AS fs, l_tax * 60.0 AS sor,
      35.0 + l_linenumber * 3.0 AS mq,
      CASE WHEN l_linenumber = 7 THEN NULL ELSE l_partkey % 30 - 20.0 END AS mq_rank_sum,
      CASE WHEN l_linenumber = 5 THEN NULL ELSE l_partkey % 40 - 28.0 END AS read_pos_rank_sum,
      CAST(l_partkey % 10 AS INT) + 3 AS hp_dp, CAST(l_partkey % 7 AS INT) + 4 AS lp_dp,
      35 + CAST(floor(l_quantity) AS INT) AS hb_dp, 38 + CAST(l_partkey % 11 AS INT) AS lb_dp,
      CASE WHEN l_suppkey % 5 = 0 THEN 0.35 * greatest(0.0, 1 - abs(l_orderkey * 100.0 - 750000) / 300000) ELSE 0.0 END AS sig,
      l_returnflag, l_partkey
    FROM lineitem) a) b
"""
STAGE_LOG = """
SELECT ts AS time, 'VARIANT CALLING' AS tool,
  CASE event_type WHEN 'view' THEN 'HaplotypeCaller' WHEN 'click' THEN 'GenomicsDBImport' WHEN 'purchase' THEN 'GenotypeGVCFs'
                  WHEN 'signup' THEN 'SelectSNPs' ELSE 'MergeVcfs' END AS program,
  concat('S', user_id % 10, '.bam') AS sample, concat('chr', event_id % 5 + 1) AS chromosome,
  CASE WHEN event_id % 83 < 2 AND value > 10 THEN 'COMPLETED' WHEN value > 50 THEN 'FAILED' ELSE 'STARTED' END AS status
FROM events
"""
EFFECTS = """
SELECT p_partkey, concat('chr', p_partkey % 5 + 1) AS chrom, p_partkey * 10 AS pos,
  CASE WHEN p_size % 7 = 0 THEN p_type
       WHEN p_size % 5 = 0 THEN concat(p_type, '( HIGH |', p_brand, ')')
       ELSE concat(p_type, '(LOW|MISSENSE|c.', p_size, '|p.', p_size, '|', p_name, '|protein|CODING|T', p_partkey, '|E|W|extra),OTHER(HIGH|NONSENSE)') END AS eff
FROM part
"""
CONTIGS = "SELECT doc_id AS contig_no, concat('ctg.', doc_id) AS name, source AS sample, n_chars AS length, doc_id % 4 AS version FROM documents"
READS = """
SELECT qname, flag, library, rname, pos, mapq, tlen, cigar, repeat('ACGTA', n) AS seq, repeat(substr('+5?I', q + 1, 1), 5 * n) AS qual,
  CAST(CASE WHEN flag & 16 = 0 THEN pos - lead ELSE pos + 5 * n - lead - tail - 1 + tail END AS BIGINT) AS five_prime, CAST(5 * n * CASE q WHEN 0 THEN 0 WHEN 1 THEN 20 WHEN 2 THEN 30 ELSE 40 END AS BIGINT) AS base_quality_sum
FROM (
  SELECT *, concat(CASE WHEN lead > 0 THEN concat(lead, 'S') ELSE '' END, 5 * n - lead - tail, 'M', CASE WHEN tail > 0 THEN concat(tail, 'S') ELSE '' END) AS cigar
  FROM (
    SELECT concat('r', CAST(floor(o_orderkey / 2.0) AS INT)) AS qname,
      1 + CASE WHEN o_orderkey % 2 = 0 THEN 64 ELSE 128 END + CASE WHEN o_custkey % 5 = 0 THEN 4 ELSE 0 END
        + CASE WHEN o_custkey % 7 = 0 THEN 8 ELSE 0 END + CASE WHEN o_custkey % 3 = 0 THEN 16 ELSE 0 END
        + CASE WHEN o_custkey % 11 = 0 THEN 256 ELSE 0 END AS flag,
      concat('lib', CAST(floor(o_orderkey / 2.0) AS INT) % 3) AS library, concat('chr', o_custkey % 12 + 1) AS rname, o_orderkey % 40 AS pos,
      CAST(o_orderkey % 61 AS INT) AS mapq, CAST(o_custkey % 700 AS INT) - 100 AS tlen, CAST(20 + o_orderkey % 3 AS INT) AS n, CAST(o_custkey % 4 AS INT) AS q,
      CASE WHEN o_custkey % 13 = 0 THEN 5 ELSE 0 END AS lead, CASE WHEN o_orderkey % 17 = 0 THEN 4 ELSE 0 END AS tail
    FROM orders) a) b
"""
ALLELES = """
SELECT p_partkey, substr('ACGTAC', CAST(p_partkey % 4 AS INT) + 1, CAST(1 + p_size % 2 AS INT)) AS ref,
  concat(substr(p_name, 1, CAST(p_size % 3 + 1 AS INT)), CASE WHEN p_partkey % 3 = 0 THEN concat(',', substr(p_name, 2, CAST(p_partkey % 2 + 1 AS INT))) ELSE '' END) AS alt FROM part
"""
VIEWS = {"variants": (VARIANTS, "lineitem"), "stage_log": (STAGE_LOG, "events"), "effects": (EFFECTS, "part"), "contigs": (CONTIGS, "documents"), "reads": (READS, "orders"), "alleles": (ALLELES, "part")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of sf_dir. lineitem, whose rows become wide, is dealt out over the cores first where it comes in fewer splits.

    Spark would move filters below that exchange, into the few tasks of the scan; a key that is formally not
    deterministic (its added bit is always 0) keeps what is derived from it above.
    """
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    if name != "lineitem" or df.rdd.getNumPartitions() >= cores:
        return df
    dealt = df.repartition(cores, "l_orderkey", "l_linenumber")
    return dealt.withColumn("l_orderkey", F.col("l_orderkey") + F.shiftright(F.monotonically_increasing_id(), 63))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of VIEWS over the tables in sf_dir."""
    text, of = VIEWS[name]
    return tune(spark).sql(text.replace(f"FROM {of}", f"FROM {{{of}}}"), **{of: table(spark, sf_dir, of)})


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical variants, and the high bulk a second time as the one bulk of that design."""
    rows = view(spark, sf_dir, "variants")
    for p in ("hp", "lp", "hb", "lb"):
        rows = rows.withColumns({f"{p}_gt": unphased(F.col(f"{p}_gt")), f"{p}_ad": lenient_depths(F.col(f"{p}_ad"))})
    return rows.withColumns({f"b_{k}": F.col(f"hb_{k}") for k in ("gt", "ad", "dp")})
