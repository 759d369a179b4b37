"""Readers of effect tables, stage logs, FASTA contigs and SAM reads, all over Spark's text and JSON sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .heads import heads

LOG_SCHEMA = "time timestamp, msg string, PROGRAM string, SAMPLE string, CHROMOSOME string, STATUS string, CMD string"
LOG_KEYS = ["time", "msg", "PROGRAM", "SAMPLE", "CHROMOSOME", "STATUS"]


def _paths(path) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def read_effects(spark: SparkSession, path, file_column: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected lines) of tab-separated files with an EFF column; lines of another width than the header are rejected.

    Each file's first line is its header, of a folder's files too; all must be the same, files without a line aside. Lines are read by
    the CSV source as one column, which leaves out first lines by their place, so a data line that equals the header stays.
    file_column: the name of a column with the name of each row's file.
    """
    first = {head[0] for _, head in heads(spark, path) if head}
    if len(first) > 1:
        raise ValueError("the files' headers differ")
    names = next(iter(first), "").split("\t")
    if "EFF" not in names:
        raise ValueError("no EFF column in the header")
    lines = spark.read.schema("value string").csv(_paths(path), sep="\x01", quote="", escape="", header=True, enforceSchema=True)
    of = [F.col("_metadata.file_name").alias(file_column)] if file_column else []
    cells = lines.select("value", *of).where(F.col("value").isNotNull()).withColumn("c", F.split("value", "\t"))
    fits, of = F.size("c") == len(names), [file_column] if file_column else []
    return cells.where(fits).select(*(F.get("c", i).alias(n) for i, n in enumerate(names)), *of), cells.where(~fits).select("value", *of)


def _log_columns() -> list[Column]:
    return [F.col("time"), F.col("msg").alias("tool"), *(F.col(k.upper()).alias(k) for k in ("program", "sample", "chromosome", "status", "cmd"))]


def read_stage_log(spark: SparkSession, path, stream: bool = False, file_column: str | None = None) -> DataFrame:
    """stage_log(time, tool, program, sample, chromosome, status, cmd) from JSON lines; lines without all keys are left out.

    file_column: the name of a column with the name of each row's file.
    """
    reader = spark.readStream if stream else spark.read
    of = [F.col("_metadata.file_name").alias(file_column)] if file_column else []
    rows = reader.schema(LOG_SCHEMA).option("mode", "PERMISSIVE").json(path)
    return rows.select("*", *of).dropna(subset=LOG_KEYS).select(*_log_columns(), *([file_column] if file_column else []))


def rejected_log_lines(spark: SparkSession, path) -> DataFrame:
    """(line, reason, file) of the lines that read_stage_log leaves out: not JSON, or the first key that is missing or unreadable."""
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0).select("value", F.col("_metadata.file_name").alias("file"))
    parsed = lines.withColumn("p", F.from_json("value", LOG_SCHEMA + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    missing = F.coalesce(*(F.when(F.col(f"p.{k}").isNull(), F.lit(f"no {k}")) for k in LOG_KEYS))
    reason = F.when(F.get_json_object("value", "$").isNull(), F.lit("no JSON")).otherwise(missing)
    return parsed.select(F.col("value").alias("line"), reason.alias("reason"), "file").where(F.col("reason").isNotNull())


def _before_splits(splits: DataFrame, *counts: str) -> DataFrame:
    """splits(file, block, ...) with `base`: the sum of counts over all splits before, by file name and place. A task sees the splits of one file, or a row per file."""
    n = sum((F.col(c) for c in counts), F.lit(0))
    files = splits.groupBy("file").agg(F.sum(n).alias("_n"))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    files = files.select(F.col("file").alias("_of"), before(W.partitionBy(F.lit(0)).orderBy("file")).alias("_files"))
    inside = splits.withColumn("_n", n).withColumn("_in", before(W.partitionBy("file").orderBy("block")))
    return inside.join(files, F.col("file") == F.col("_of")).withColumn("base", F.col("_files") + F.col("_in")).drop("_n", "_in", "_of", "_files")


def _numbered_lines(spark: SparkSession, path, separator: str | None = None) -> DataFrame:
    """(value, file, block, at): lines with their file, their split of it, and a number that rises within the split."""
    reader = spark.read.option("lineSep", separator) if separator else spark.read
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).where(F.length(F.trim("value")) > 0).withColumn("at", F.monotonically_increasing_id())


def read_fasta(spark: SparkSession, path, file_column: str | None = None) -> DataFrame:
    """contigs(contig_no, name, seq, length); the name ends at the first blank. Numbers 0, 1, ... by file name and order in it.

    Records end where a line begins with >, so a > inside a header is part of it. A contig is one row, as long as it is; read_fasta_chunks
    spreads long ones. Records are counted by split first; sequences are not moved.
    """
    parts = _numbered_lines(spark, path, "\n>")
    splits = _before_splits(parts.groupBy("file", "block").agg(F.min("at").alias("_first"), F.count("*").alias("n")), "n")
    parts = parts.join(splits.select(F.col("file").alias("_f"), F.col("block").alias("_b"), "_first", "base"), (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")))
    record = F.regexp_replace("value", r"^\s*>", "")
    head, seq = F.regexp_extract(record, r"^([^\r\n]*)", 1), F.regexp_replace(F.regexp_replace(record, r"^[^\r\n]*", ""), r"\s", "")
    of = [F.element_at(F.split("file", "/"), -1).alias(file_column)] if file_column else []
    out = parts.select((F.col("base") + F.col("at") - F.col("_first")).alias("contig_no"), F.regexp_extract(head, r"^(\S*)", 1).alias("name"), seq.alias("seq"), *of)
    return out.withColumn("length", F.length("seq").cast("long")).select("contig_no", "name", "seq", "length", *([file_column] if file_column else []))


#: Lines of a FASTA file in one chunk.
CHUNK_LINES = 1000


def read_fasta_chunks(spark: SparkSession, path, lines: int = CHUNK_LINES) -> tuple[DataFrame, DataFrame]:
    """(contigs(contig_no, name, length), chunks(contig_no, offset, chunk)): a chromosome as chunks of its lines over many tasks.

    Contigs are numbered 0, 1, ... by file name and order in it, offset counts bases from 0. The first pass goes through each split
    of a file by itself: which contig of the split a line belongs to, and how many bases stand before it. Prefix sums over
    the splits then tell how many contigs, and how many bases of a contig that goes on, stand before each split. Lines before
    a file's first header belong to no contig and are left out.
    """
    rows = _numbered_lines(spark, path)
    head = F.ltrim("value").startswith(">")
    rows = rows.select("file", "block", "at", head.alias("head"), F.when(head, F.regexp_extract("value", r"^\s*>(\S*)", 1)).alias("name"), F.when(head, "").otherwise(F.regexp_replace("value", r"\s", "")).alias("seq"))
    up_to = W.partitionBy("file", "block").orderBy("at")
    rows = rows.withColumn("nth", F.sum(F.col("head").cast("long")).over(up_to.rowsBetween(W.unboundedPreceding, 0)))
    own = W.partitionBy("file", "block", "nth").orderBy("at")
    rows = rows.withColumns({"before": F.coalesce(F.sum(F.length("seq").cast("long")).over(own.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)), "line": F.row_number().over(own)})
    rows = materialise(rows, "fasta-lines")
    splits = rows.groupBy("file", "block").agg(F.max("nth").alias("n"), F.max(F.struct("nth", (F.col("before") + F.length("seq")).alias("bases")))["bases"].alias("tail"))
    by_block = W.partitionBy("file").orderBy("block")
    splits = splits.withColumn("_since", F.count_if(F.col("n") > 0).over(by_block.rowsBetween(W.unboundedPreceding, 0)))
    splits = splits.withColumn("_run", F.sum("tail").over(W.partitionBy("file", "_since").orderBy("block").rowsBetween(W.unboundedPreceding, 0)))
    splits = splits.withColumns({"carried": F.coalesce(F.lag("_run").over(by_block), F.lit(0)), "open": F.coalesce(F.lag("_since").over(by_block), F.lit(0)) > 0})
    splits = _before_splits(splits, "n").select(F.col("file").alias("_f"), F.col("block").alias("_b"), "base", "carried", "open")
    rows = rows.join(splits, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b"))).where((F.col("nth") > 0) | F.col("open"))
    first = F.col("nth") == 0  # these lines go on with the contig of the split before
    rows = rows.select((F.col("base") + F.col("nth") - 1).alias("contig_no"), "name", F.col("seq"), "file", "block", "at", (F.floor((F.col("line") - 1) / lines)).alias("piece"), (F.col("before") + F.when(first, F.col("carried")).otherwise(0)).alias("offset"))
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "seq"))), lambda x: x["seq"]), "")
    chunks = rows.groupBy("contig_no", "file", "block", "piece").agg(F.min("offset").alias("offset"), ordered.alias("chunk")).where(F.length("chunk") > 0).select("contig_no", "offset", "chunk")
    contigs = rows.groupBy("contig_no").agg(F.max("name").alias("name"), F.sum(F.length("seq")).cast("long").alias("length"))
    return contigs, chunks


_SAM = (("qname", "string"), ("flag", "int"), ("rname", "string"), ("pos", "long"), ("mapq", "int"), ("cigar", "string"), ("rnext", "string"), ("pnext", "long"), ("tlen", "int"), ("seq", "string"), ("qual", "string"))
#: Base qualities below it don't count in a read's score.
LEAST_QUALITY = 15


def _sum(texts: Column) -> Column:
    return F.aggregate(texts.cast("array<long>"), F.lit(0).cast("long"), lambda a, x: a + x)


def five_prime(flag: Column, pos: Column, cigar: Column) -> Column:
    """The place of a read's first base on its own strand, clipped bases counted in."""
    before, after = F.regexp_extract(cigar, r"^((?:\d+[SH])*)", 1), F.regexp_extract(cigar, r"((?:\d+[SH])*)$", 1)
    clipped = lambda part: _sum(F.regexp_extract_all(part, F.lit(r"(\d+)"), F.lit(1)))
    spanned = _sum(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1)))
    return F.when(flag.bitwiseAND(F.lit(16)) != 0, pos + spanned - 1 + clipped(after)).otherwise(pos - clipped(before))


def read_sam(spark: SparkSession, path, file_column: str | None = None) -> DataFrame:
    """Aligned reads from SAM text: its eleven columns, and library, five_prime and base_quality_sum.

    A read's library is that of its read group in the header of its own file (LB, else the group's id; reads without a group:
    unknown), so files may use one id for different libraries. Headers are read on planning, as far as they go; base_quality_sum
    adds the base qualities of LEAST_QUALITY or more.
    """
    is_header = F.col("value").rlike("^@[A-Z][A-Z]\t")
    groups = []
    for file, head in heads(spark, path, lambda line: not line or (line[:1] == "@" and line[1:3].isalpha() and line[1:3].isupper() and line[3:4] == "\t")):
        for line in head:
            if line.startswith("@RG\t"):
                tags = dict(x.split(":", 1) for x in line.split("\t")[1:] if ":" in x)
                groups.append((file, tags.get("ID"), tags.get("LB") or tags.get("ID")))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("_file"), F.input_file_name().alias("_uri")).where(F.length("value") > 0)
    tag = lambda k: F.nullif(F.regexp_extract("value", rf"\t{k}:([^\t]*)", 1), F.lit(""))
    c = F.split("value", "\t")
    rows = lines.where(~is_header).select(*(F.get(c, i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(_SAM)), tag("RG:Z").alias("_rg"), "_file", "_uri")
    named = spark.createDataFrame(groups, "_of string, _id string, _lb string").dropDuplicates(["_of", "_id"])
    rows = rows.join(named, (F.col("_uri") == F.col("_of")) & (F.col("_rg") == F.col("_id")), "left")
    score = _sum(F.filter(F.transform(F.filter(F.split("qual", ""), lambda x: x != ""), lambda x: F.ascii(x) - 33), lambda x: x >= LEAST_QUALITY))
    more = [F.coalesce("_lb", "_rg", F.lit("unknown")).alias("library"), five_prime(F.col("flag"), F.col("pos"), F.col("cigar")).alias("five_prime"), F.when(F.col("qual") == "*", F.lit(0).cast("long")).otherwise(score).alias("base_quality_sum")]
    return rows.select(*(name for name, _ in _SAM), *more, *([F.col("_file").alias(file_column)] if file_column else []))
