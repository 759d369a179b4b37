"""The first lines of files, read on planning without a job over the data."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession

#: Bytes that are read at once while a head goes on, and files at once.
CHUNK, THREADS = 1 << 16, 32


def open_file(uri: str, compression: str | None = "detect"):
    """A stream over a file by its URI; packed files by their ending unless compression is None."""
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_stream(path, compression=compression) if compression else system.open_input_file(path)


def head_of(uri: str, goes_on: Callable[[str], bool]) -> list[str]:
    """A file's lines up to the first that doesn't go on, that one included. No more of the file is read than chunks that hold them."""
    with open_file(uri) as stream:
        data, lines = b"", []
        while True:
            more = stream.read(CHUNK)
            *whole, data = (data + more).split(b"\n")
            for line in whole if more else [*whole, *([data] if data else [])]:
                lines.append(line.decode().rstrip("\r"))
                if not goes_on(lines[-1]):
                    return lines
            if not more:
                return lines


def heads(spark: SparkSession, path: str | list[str], goes_on: Callable[[str], bool] = lambda line: False) -> list[tuple[str, list[str]]]:
    """(file, head) of each file below path, in order of the files' names. Stores that only Spark can open are read by Spark, some lines of each file."""
    files = sorted(spark.read.text(path).inputFiles())

    def by_spark(uri: str) -> list[str]:
        n = 1000
        while True:
            got = [r["value"] for r in spark.read.text(uri).take(n)]
            end = next((i for i, line in enumerate(got) if not goes_on(line)), None)
            if end is not None or len(got) < n:
                return got[: len(got) if end is None else end + 1]
            n *= 10

    def head(uri: str) -> list[str]:
        try:
            return head_of(uri, goes_on)
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError):
            return by_spark(uri)

    with ThreadPoolExecutor(THREADS) as pool:
        return list(zip(files, pool.map(head, files), strict=True))
