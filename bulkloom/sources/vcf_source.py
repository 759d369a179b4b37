"""VCF text as a data source of Spark: headers are read on planning, plain files are cut into ranges of bytes, samples of all files are united."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from io import BytesIO

import numpy as np
import pyarrow as pa
from pyarrow import csv, fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .heads import head_of, open_file

SITE = ("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")
#: Bytes of a plain file that a task reads, and bytes that it holds at once.
SPLIT, CHUNK = 64 << 20, 4 << 20


def files_of(paths: list[str]) -> list[str]:
    """URIs of the files below paths, in order; names that begin with . or _ are left out, as Spark does."""
    out = []
    for path in paths:
        system, at = fs.FileSystem.from_uri(path)
        scheme = path[: len(path) - len(at)] if path.endswith(at) else ""
        info = system.get_file_info(at)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(at, recursive=True))
        found = [f for f in found if f.type == fs.FileType.File and not any(p[:1] in "._" for p in f.path[len(at) :].split("/") if p)]
        out += [scheme + f.path if scheme else f"file://{f.path}" for f in found]
    return sorted(out)


@dataclass(frozen=True)
class Header:
    uri: str
    samples: tuple[str, ...]
    columns: int


def header_of(uri: str) -> Header | None:
    """The #CHROM line of a file; None where the file is empty."""
    head = head_of(uri, lambda line: line.startswith("##"))
    if not head:
        return None
    if not head[-1].startswith("#CHROM\t"):
        raise ValueError(f"no #CHROM line in {uri}")
    cells = head[-1].split("\t")
    return Header(uri, tuple(cells[9:]), len(cells))


@dataclass
class Range(InputPartition):
    """A file, or a part of one: the lines that begin in [start, end); end -1 is the whole of a packed file."""

    header: Header
    start: int
    end: int


class VcfSource(DataSource):
    """format("vcf"): CHROM to FORMAT as text, cells (a text for each sample, null where a file doesn't have it) and file.

    The samples stand in the metadata of `cells`, in order of the files' names and their own. Option paths: a JSON list.
    """

    @classmethod
    def name(cls) -> str:
        return "vcf"

    def headers(self) -> list[Header]:
        return [h for h in map(header_of, files_of(json.loads(self.options["paths"]))) if h]

    def schema(self) -> StructType:
        headers = self.headers()
        if not headers:
            raise ValueError("no #CHROM line")
        samples = list(dict.fromkeys(s for h in headers for s in h.samples))
        site = [StructField(c, StringType()) for c in SITE]
        return StructType([*site, StructField("cells", ArrayType(StringType()), True, {"samples": samples}), StructField("file", StringType())])

    def reader(self, schema: StructType) -> VcfReader:
        return VcfReader(self.headers(), int(self.options.get("split", SPLIT)))


class VcfReader(DataSourceReader):
    def __init__(self, headers: list[Header], split: int):
        self.headers, self.split = headers, split
        self.samples = list(dict.fromkeys(s for h in headers for s in h.samples))

    def partitions(self) -> list[InputPartition]:
        out = []
        for h in self.headers:
            system, path = fs.FileSystem.from_uri(h.uri)
            size = system.get_file_info(path).size
            out += [Range(h, 0, -1)] if h.uri.endswith(".gz") else [Range(h, at, min(at + self.split, size)) for at in range(0, size, self.split)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        for lines in whole_lines(partition):
            if batch := self.parse(lines, partition.header):
                yield batch

    def parse(self, lines: bytes, header: Header) -> pa.RecordBatch | None:
        """A row of each data line; one with another number of cells than the header is an error."""
        if b"#" in lines:
            lines = b"\n".join(x for x in lines.split(b"\n") if not x.startswith(b"#"))
        if not lines.strip():
            return None
        names = [str(i) for i in range(header.columns)]
        table = csv.read_csv(
            BytesIO(lines), csv.ReadOptions(column_names=names, use_threads=False, block_size=max(len(lines) + 1, 1 << 20)),
            csv.ParseOptions(delimiter="\t", quote_char=False, double_quote=False), csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=False),
        )
        columns = [c.combine_chunks() for c in table.columns]
        columns = [c if isinstance(c, pa.Array) else pa.concat_arrays(c.chunks) for c in columns]
        rows = table.num_rows
        site = [columns[i] if i < len(columns) else pa.nulls(rows, pa.string()) for i in range(len(SITE))]
        own = {s: i for i, s in enumerate(header.samples)}
        # the cells of a row side by side: row r of sample s is at own[s] * rows + r of all columns one after another
        at = np.array([own.get(s, -1) for s in self.samples], np.int64)
        index = np.where(at < 0, -1, at * rows + np.arange(rows)[:, None]).reshape(-1)
        flat = pa.concat_arrays(columns[9:]) if own else pa.nulls(1, pa.string())
        cells = flat.take(pa.array(np.maximum(index, 0), mask=index < 0))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * len(self.samples)), cells)
        return pa.RecordBatch.from_arrays([*site, lists, pa.array([header.uri.rsplit("/", 1)[-1]] * rows)], names=[*SITE, "cells", "file"])


def whole_lines(part: Range) -> Iterator[bytes]:
    """The lines that begin in the range, in chunks that end with a line; a line that crosses the range's end is read to its end."""
    packed = part.end < 0
    with open_file(part.header.uri, "detect" if packed else None) as stream:
        rest, at = b"", part.start
        if part.start:  # the line that holds the byte before belongs to the range before
            stream.seek(part.start - 1)
            at = part.start - 1
            while True:
                data = stream.read(CHUNK)
                cut = data.find(b"\n")
                if cut >= 0 or not data:
                    at, rest = at + cut + 1 if data else part.end, data[cut + 1 :]
                    break
                at += len(data)
        # `at` is where `rest` begins in the file
        while packed or at < part.end:
            data = stream.read(CHUNK)
            block = rest + data
            if packed:
                cut = block.rfind(b"\n") + 1 if data else len(block)
            else:  # lines that begin before the end
                last = block.find(b"\n", max(part.end - at - 1, 0))
                cut = last + 1 if last >= 0 else (len(block) if not data else 0 if at + len(block) >= part.end else block.rfind(b"\n") + 1)
            if cut:
                yield block[:cut].replace(b"\r\n", b"\n")
            at, rest = at + cut, block[cut:]
            if not data:
                return
