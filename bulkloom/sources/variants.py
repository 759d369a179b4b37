"""Wide variant tables and VCF text as one canonical table: chrom, pos, ref, alt, qual, type, and gt, ad, dp, gq of each role."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.genotype import MISSING, lenient_depths, lenient_int, unphased, variant_type, whole
from ..session import with_code
from .vcf_source import VcfSource

SITE = ("CHROM", "POS", "REF", "ALT", "TYPE")
#: Column prefixes of the roles a sample can have.
ROLES = {"high_parent": "hp", "low_parent": "lp", "high_bulk": "hb", "low_bulk": "lb", "bulk": "b"}
#: INFO keys of the annotations that hard filters read, and their column names in a call table.
ANNOTATIONS = {"QD": "qd", "FS": "fs", "SOR": "sor", "MQ": "mq", "MQRankSum": "mq_rank_sum", "ReadPosRankSum": "read_pos_rank_sum"}


def _paths(path) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def read_wide(spark: SparkSession, path, file_column: str | None = None) -> DataFrame:
    """The table as text columns. Ragged rows and repeated column names are errors; paths may be several.

    file_column: the name of a column with the name of each row's file.
    """
    df = spark.read.csv(_paths(path), sep="\t", header=True, mode="FAILFAST", ignoreLeadingWhiteSpace=True, enforceSchema=False)
    head = spark.read.text(_paths(path)[0]).limit(1).collect()
    seen = [c.strip().lower() for c in head[0]["value"].split("\t")] if head else []
    if len(set(seen)) < len(seen):
        raise ValueError("a column name occurs twice")
    return df.withColumn(file_column, F.col("_metadata.file_name")) if file_column else df


def samples(df: DataFrame) -> list[str]:
    """Samples of a wide table: every column that ends in .GT."""
    return [c[:-3] for c in df.columns if c.endswith(".GT")]


def sample_table(df: DataFrame) -> DataFrame:
    """(id, name) of the samples, in order; id 0 stands for none."""
    return df.sparkSession.createDataFrame(list(enumerate(["None", *samples(df)])), "id int, name string")


def assign_roles(df: DataFrame, **roles: str) -> DataFrame:
    """Canonical columns of a wide table, for the samples named by role (high_parent, low_parent, high_bulk, low_bulk, bulk)."""
    unknown = [r for r in roles if r not in ROLES]
    missing = [c for c in [*SITE, *(f"{s}.{k}" for s in roles.values() for k in ("GT", "AD", "DP"))] if c not in df.columns]
    if unknown or missing:
        raise ValueError(f"unknown roles {unknown}, missing columns {missing}")
    qual = F.col("QUAL").try_cast("double") if "QUAL" in df.columns else F.lit(None).cast("double")
    out = [F.col("CHROM").alias("chrom"), F.coalesce(F.col("POS").try_cast("double").cast("long"), F.lit(0)).alias("pos"), F.col("REF").alias("ref"), F.col("ALT").alias("alt"), qual.alias("qual"), F.col("TYPE").alias("type")]
    for role, name in roles.items():
        p, at = ROLES[role], lambda k, name=name: F.col(f"`{name}.{k}`")
        out += [unphased(at("GT")).alias(f"{p}_gt"), lenient_depths(at("AD")).alias(f"{p}_ad"), lenient_int(at("DP")).alias(f"{p}_dp")]
        if f"{name}.GQ" in df.columns:
            out.append(lenient_int(at("GQ")).alias(f"{p}_gq"))
    return df.select(*out)


def resolve_roles(pairs: DataFrame) -> dict[str, str]:
    """Role names to samples from a table (role, sample) with one row per role; labels such as HIGH_BULK in any case."""
    found = {r["role"].lower(): r["sample"] for r in pairs.limit(len(ROLES) + 1).collect()}
    if bad := [r for r in found if r not in ROLES]:
        raise ValueError(f"unknown roles {bad}")
    return found


def vcf_rows(spark: SparkSession, path, split: int | None = None) -> tuple[DataFrame, list[str]]:
    """(rows of VCF files as format("vcf") gives them, the samples of all files). Only headers are read here."""
    with_code(spark).dataSource.register(VcfSource)
    reader = spark.read.format("vcf").option("paths", json.dumps(_paths(path)))
    rows = (reader.option("split", split) if split else reader).load()
    return rows, rows.schema["cells"].metadata["samples"]


def _vcf_columns(rows: DataFrame, path) -> DataFrame:
    """Alleles and INFO as collections. A packed file is one task, so its rows are dealt out, by contig and position."""
    if any(p.endswith(".gz") for p in _paths(path)):
        rows = rows.repartition("CHROM", "POS")
    return rows.withColumns({"_alleles": F.concat(F.array("REF"), F.split("ALT", ",")), "_info": F.str_to_map("INFO", F.lit(";"), F.lit("=")), "_keys": F.split("FORMAT", ":")})


def _field(cell: Column, key: str) -> Column:
    got = F.get(F.split(cell, ":"), F.array_position("_keys", key).cast("int") - 1)
    return _letters(got) if key == "GT" else F.coalesce(got, F.lit(""))


def _vcf_site() -> list[Column]:
    number = lambda c, kind: F.col(c).try_cast(kind).alias(c.lower())
    return [F.col("CHROM").alias("chrom"), number("POS", "long"), F.col("REF").alias("ref"), F.col("ALT").alias("alt"), number("QUAL", "double"), variant_type(F.col("REF"), F.col("ALT")).alias("type")]


def _with_calls(rows: DataFrame, cells: dict[str, Column]) -> DataFrame:
    """rows with gt, ad, dp and gq of each prefix's cell, nulls where there is none.

    Cells are split and keys are looked up in a projection of their own, as within conditions each use would do it again.
    """
    keys = ("GT", "AD", "DP", "GQ")
    rows = rows.withColumns({f"_cell_{p}": F.split(c, ":") for p, c in cells.items()} | {f"_at_{k}": F.array_position("_keys", k).cast("int") - 1 for k in keys})
    at = lambda p, k: F.get(f"_cell_{p}", f"_at_{k}")
    rows, out = rows.withColumns({f"_gt_{p}": _letters(at(p, "GT")) for p in cells}), {}
    for p in cells:
        gt = F.when(F.contains(f"_gt_{p}", F.lit("|")), unphased(F.col(f"_gt_{p}"))).otherwise(F.col(f"_gt_{p}"))
        call = {"gt": gt, "ad": lenient_depths(F.coalesce(at(p, "AD"), F.lit(""))), "dp": lenient_int(at(p, "DP")), "gq": lenient_int(at(p, "GQ"))}
        out |= {f"{p}{k}": F.when(F.col(f"_cell_{p}").isNotNull(), c) for k, c in call.items()}
    return rows.withColumns(out)


def read_vcf(spark: SparkSession, path, info: tuple[str, ...] = (), fields: tuple[str, ...] = ("GT", "AD", "DP", "GQ"), file_column: str | None = None) -> DataFrame:
    """VCF text, plain or gzip, flattened to a wide table, with chosen INFO keys as columns.

    Genotype numbers become allele letters. Files may have different samples: the table has those of all, and a row of a
    file without a sample has missing calls for it. file_column: the name of a column with the name of each row's file.
    For thousands of samples read_vcf_long keeps the table narrow.
    """
    rows, names = vcf_rows(spark, path)
    rows = _vcf_columns(rows, path)
    out = [F.col(c) for c in ("CHROM", "POS", "REF", "ALT", "QUAL", "FILTER")] + [variant_type(F.col("REF"), F.col("ALT")).alias("TYPE")]
    out += [F.try_element_at("_info", F.lit(k)).alias(k) for k in info]
    out += [_field(F.get("cells", i), k).alias(f"{name}.{k}") for i, name in enumerate(names) for k in fields]
    return rows.select(*out, *([F.col("file").alias(file_column)] if file_column else []))


def read_vcf_long(spark: SparkSession, path, missing: bool = True) -> DataFrame:
    """(row_no, chrom, pos, ref, alt, qual, type, sample, gt, ad, dp, gq): a row for each call and sample that the call's file has.

    However many samples there are, there is one column for each field. row_no parts calls at one site; missing=False leaves
    missing genotypes out.
    """
    rows, names = vcf_rows(spark, path)
    rows = _vcf_columns(rows, path).withColumn("row_no", F.monotonically_increasing_id())
    each = rows.select("*", F.posexplode("cells").alias("_i", "_cell")).where(F.col("_cell").isNotNull())
    named = spark.createDataFrame(list(enumerate(names)), "_n int, sample string")
    each = each.join(F.broadcast(named) if len(names) <= 100_000 else named, F.col("_i") == F.col("_n"))
    out = _with_calls(each, {"": F.col("_cell")}).select("row_no", *_vcf_site(), "sample", "gt", "ad", "dp", "gq")
    return out if missing else out.where(F.col("gt") != MISSING)


def assign_roles_long(calls: DataFrame, roles: DataFrame) -> DataFrame:
    """Canonical columns from long calls (row_no, chrom, pos, ref, alt, qual, type, sample, gt, ad, dp, gq) and roles(role, sample).

    Only the samples that have a role are kept, before anything moves; their calls come side by side by a pivot over the
    few role names. A role's sample without a call in a row leaves nulls.
    """
    named = roles.select(F.lower("role").alias("role"), "sample")
    found = resolve_roles(named)
    prefix = F.create_map(*(F.lit(x) for r, p in ROLES.items() for x in (r, p)))
    mine = calls.join(F.broadcast(named.select("sample", F.element_at(prefix, F.col("role")).alias("_p"))), "sample")  # a row per role
    fields = ("gt", "ad", "dp", "gq")
    prefixes = [ROLES[r] for r in ROLES if r in found]
    site = ["chrom", "pos", "ref", "alt", "qual", "type"]
    wide = mine.groupBy("row_no", *site).pivot("_p", prefixes).agg(F.first(F.struct(*fields)))
    return wide.select(*site, *(F.col(f"{p}.{f}").alias(f"{p}_{f}") for p in prefixes for f in fields))


def read_vcf_roles(spark: SparkSession, path, roles: DataFrame) -> DataFrame:
    """What assign_roles_long gives for the long calls of VCF text, straight from its lines.

    However many samples there are, a line's cells stay one array, from which the cell of each role's sample is taken by its
    place: only cells of roles are parsed, no call becomes a row of its own and no row moves. Lines of files that have no
    sample with a role are left out.
    """
    found = resolve_roles(roles.select(F.lower("role").alias("role"), "sample"))
    rows, names = vcf_rows(spark, path)
    mine = {f"{p}_": F.get("cells", names.index(found[r])) if found[r] in names else F.lit(None).cast("string") for r, p in ROLES.items() if r in found}
    calls = _with_calls(_vcf_columns(rows.where(F.coalesce(*mine.values()).isNotNull()), path), mine)
    return calls.select(*_vcf_site(), *(f"{p}{k}" for p in mine for k in ("gt", "ad", "dp", "gq")))


def _letters(gt: Column) -> Column:
    """Allele letters of a genotype's numbers. The common form of two digits or dots does without a function over elements."""
    letter = lambda n: F.coalesce(F.get(F.col("_alleles"), n), F.lit("."))
    parts = F.transform(F.split(gt, r"[/|]"), lambda x: letter(whole(x)))
    a, between, b = (F.substring(gt, i, 1) for i in (1, 2, 3))
    digit = lambda x: F.when(x.between("0", "9"), x.try_cast("int"))
    pair = (F.length(gt) == 3) & between.isin("/", "|") & ~a.isin("/", "|") & ~b.isin("/", "|")
    several = F.when(F.contains(gt, F.lit("|")), F.array_join(parts, "|")).otherwise(F.array_join(parts, "/"))
    return F.coalesce(F.when(pair, F.concat(letter(digit(a)), between, letter(digit(b)))).otherwise(several), F.lit("./."))


def read_calls(spark: SparkSession, path, file_column: str | None = None) -> DataFrame:
    """A call table as the call-set operators take it, from VCF: typed site columns and annotations, and the samples' columns as they are.

    chrom, pos, ref, alt, qual, filter and type, then the annotations of ANNOTATIONS as numbers, null where a call has none.
    """
    wide = read_vcf(spark, path, info=tuple(ANNOTATIONS), file_column=file_column)
    number = lambda c: F.col(c).try_cast("double")
    site = [F.col("CHROM").alias("chrom"), F.col("POS").try_cast("long").alias("pos"), F.col("REF").alias("ref"), F.col("ALT").alias("alt"), number("QUAL").alias("qual"), F.col("FILTER").alias("filter"), F.col("TYPE").alias("type")]
    rest = [F.col(f"`{c}`") for c in wide.columns if "." in c or c == file_column]
    return wide.select(*site, *(number(k).alias(v) for k, v in ANNOTATIONS.items()), *rest)


def sample_calls(calls: DataFrame) -> DataFrame:
    """(chrom, pos, ref, alt, sample, gt, ad, dp, gq): a row for each call of each sample of a table with <sample>.GT columns; missing calls stay out."""
    each = []
    for s in samples(calls):
        at = lambda k, s=s: F.col(f"`{s}.{k}`") if f"{s}.{k}" in calls.columns else F.lit(None).cast("string")
        each.append(F.struct(F.lit(s).alias("sample"), unphased(at("GT")).alias("gt"), lenient_depths(at("AD")).alias("ad"), lenient_int(at("DP")).alias("dp"), lenient_int(at("GQ")).alias("gq")))
    site = {c.lower(): c for c in calls.columns}
    rows = calls.select(*(F.col(site[c]).alias(c) for c in ("chrom", "pos", "ref", "alt")), F.explode(F.array(*each)).alias("s"))
    return rows.select("chrom", F.col("pos").cast("long").alias("pos"), "ref", "alt", "s.*").where(F.col("gt") != MISSING)


def read_variants(spark: SparkSession, path, **options) -> DataFrame:
    """A wide table from VCF (.vcf, .gz) or from tab-separated text (anything else)."""
    return read_vcf(spark, path, **options) if all(p.endswith((".vcf", ".gz")) for p in _paths(path)) else read_wide(spark, path)
