"""Resampling towards a target: n-gram features in hashed buckets, importance weights, and a draw by the Gumbel trick."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, prepare, shield
from .terms import texts_of, word_lists

BUCKETS, ORDER = 10_000, 3
#: Primes of XXH64, fixed values of the hash.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
#: Bytes of text in one table, so that it stays in a core's cache.
TABLE_BYTES = 1 << 18
#: Longer n-grams are hashed one by one.
LONG = 1024


def _crc_tables() -> np.ndarray:
    """(8, 256): what a byte adds to a CRC-32 that so many bytes follow in its step."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1)
    out = [one]
    for _ in range(7):
        out.append(one[out[-1] & 255] ^ (out[-1] >> np.uint32(8)))
    return np.array(out)


CRC = _crc_tables()


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(acc, lane):
    return _rotate(acc + lane * P2, 31) * P1


class Bytes:
    """A buffer of bytes whose places can be read as little-endian words of one, four or eight bytes."""

    def __init__(self, data: bytes):
        padded = data + bytes(8)
        self.data, self.size = data, len(data)
        at = lambda kind: np.ndarray((len(data) + 1,), kind, padded, strides=(1,))
        self.one, self.four, self.eight = at("u1"), at("<u4"), at("<u8")

    def xxhash64(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """XXH64 of each stretch with seed 0, all at once: a step of the hash is a step over the whole array."""
        acc = P5 + length.astype(np.uint64)
        at, left = start.copy(), length.copy()
        wide = np.flatnonzero((length >= 32) & (length <= LONG))
        if wide.size:
            v = [np.full(wide.size, s, np.uint64) for s in ((int(P1) + int(P2)) % 2**64, P2, 0, 2**64 - int(P1))]
            on = np.arange(wide.size)
            while on.size:
                for k in range(4):
                    v[k][on] = _round(v[k][on], self.eight[at[wide[on]] + 8 * k])
                at[wide[on]] += 32
                left[wide[on]] -= 32
                on = on[left[wide[on]] >= 32]
            mixed = _rotate(v[0], 1) + _rotate(v[1], 7) + _rotate(v[2], 12) + _rotate(v[3], 18)
            for k in range(4):
                mixed = (mixed ^ _round(np.uint64(0), v[k])) * P1 + P4
            acc[wide] = mixed + length[wide].astype(np.uint64)
        left[length > LONG] = 0
        while (on := np.flatnonzero(left >= 8)).size:
            acc[on] = _rotate(acc[on] ^ _round(np.uint64(0), self.eight[at[on]]), 27) * P1 + P4
            at[on] += 8
            left[on] -= 8
        on = np.flatnonzero(left >= 4)
        acc[on] = _rotate(acc[on] ^ (self.four[at[on]].astype(np.uint64) * P1), 23) * P2 + P3
        at[on] += 4
        left[on] -= 4
        while (on := np.flatnonzero(left > 0)).size:
            acc[on] = _rotate(acc[on] ^ (self.one[at[on]].astype(np.uint64) * P5), 11) * P1
            at[on] += 1
            left[on] -= 1
        acc = (acc ^ (acc >> np.uint64(33))) * P2
        acc = (acc ^ (acc >> np.uint64(29))) * P3
        acc ^= acc >> np.uint64(32)
        for i in np.flatnonzero(length > LONG):
            acc[i] = xxhash.xxh64_intdigest(self.data[start[i] : start[i] + length[i]])
        return acc

    def crc32(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """CRC-32 of each stretch, eight bytes a step by a table for each place."""
        crc, at, left = np.full(start.size, 0xFFFFFFFF, np.uint32), start.copy(), length.copy()
        left[length > LONG] = 0
        while (on := np.flatnonzero(left >= 8)).size:
            lane = self.eight[at[on]] ^ crc[on]
            new = CRC[7][lane & 255]
            for k in range(1, 8):
                new ^= CRC[7 - k][(lane >> np.uint64(8 * k)) & 255]
            crc[on] = new
            at[on] += 8
            left[on] -= 8
        on = np.flatnonzero(left >= 4)
        lane = self.four[at[on]] ^ crc[on]
        crc[on] = CRC[3][lane & 255] ^ CRC[2][(lane >> 8) & 255] ^ CRC[1][(lane >> 16) & 255] ^ CRC[0][lane >> 24]
        at[on] += 4
        left[on] -= 4
        while (on := np.flatnonzero(left > 0)).size:
            crc[on] = CRC[0][(crc[on] ^ self.one[at[on]]) & 255] ^ (crc[on] >> np.uint32(8))
            at[on] += 1
            left[on] -= 1
        crc ^= np.uint32(0xFFFFFFFF)
        for i in np.flatnonzero(length > LONG):
            crc[i] = zlib.crc32(self.data[start[i] : start[i] + length[i]])
        return crc

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches of one length at a and at b hold the same bytes."""
        same = np.ones(a.size, bool)
        on, k = np.arange(a.size), 0
        while on.size:
            left = length[on] - k
            differs = (self.eight[a[on] + k] ^ self.eight[b[on] + k]) << (np.uint64(8) * np.maximum(8 - left, 0).astype(np.uint64))
            same[on[differs != 0]] = False
            on = on[(differs == 0) & (left > 8)]
            k += 8
        return same


class Interned:
    """An open-addressed table of the n-grams of one batch.

    Keys are XXH64 hashes. All occurrences probe together, one place further each round; a free place is taken by one of
    those that meet in it, and an occurrence has found its place when hash, length and bytes agree with the taker's.
    Places hold bucket and count; `slot` has the place of each occurrence.
    """

    def __init__(self, data: Bytes, start: np.ndarray, length: np.ndarray):
        bits = max(4, int(1.5 * start.size).bit_length())
        owner, mask = np.full(1 << bits, -1, np.int32), (1 << bits) - 1
        keys = data.xxhash64(start, length)
        self.slot = (keys & np.uint64(mask)).astype(np.int32)
        todo = np.arange(start.size, dtype=np.int32)
        while todo.size:
            place = self.slot[todo]
            free = owner[place] < 0
            owner[place[free]] = todo[free]
            by = owner[place]
            found = by == todo
            near = np.flatnonzero(~found)
            a, b = by[near], todo[near]
            same = (keys[a] == keys[b]) & (length[a] == length[b])
            near, a, b = near[same], a[same], b[same]
            found[near] = data.equal(start[a], start[b], length[b])
            todo = todo[~found]
            self.slot[todo] = (self.slot[todo] + 1) & mask
        self.used = np.flatnonzero(owner >= 0)
        first = owner[self.used]
        self.count = np.bincount(self.slot, minlength=owner.size)
        self.bucket = np.zeros(owner.size, np.int32)
        self.bucket[self.used] = data.crc32(start[first], length[first]) % BUCKETS


def batches_of(texts: list[bytes | None], limit: int = TABLE_BYTES) -> Iterator[tuple[list[list[bytes]], np.ndarray, np.ndarray]]:
    """(lists of words, row of each list, words carried over) of about limit bytes at once.

    A long text comes in several lists; each begins with the last words of the one before, so that the n-grams across a
    cut are whole, and these carried words end no n-gram of their own.
    """
    lists, rows, carried, size = [], [], [], 0
    for row, text in enumerate(texts):
        before: list[bytes] = []
        for words in word_lists(text, limit):
            lists.append(before + words)
            rows.append(row)
            carried.append(len(before))
            before = lists[-1][1 - ORDER :]
            size += min(limit, len(text))
            if size >= limit:
                yield lists, np.array(rows), np.array(carried)
                lists, rows, carried, size = [], [], [], 0
    if lists:
        yield lists, np.array(rows), np.array(carried)


def ngrams(lists, rows, carried) -> tuple[Bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, length, row of each n-gram of 1 to ORDER words, row of each word that isn't carried)."""
    data = Bytes(b" ".join([b" ".join(x) for x in lists if x]) + b" ")
    n = np.array([len(x) for x in lists])
    total = int(n.sum())
    ends = np.flatnonzero(data.one[: data.size] == 32)[:total]
    starts = np.concatenate([[0], ends[:-1] + 1])[:total]
    piece = np.repeat(np.arange(len(lists)), n)
    own = np.arange(total) - np.repeat(np.cumsum(n) - n, n) >= carried[piece]
    parts = []
    for k in range(1, ORDER + 1):
        last = np.flatnonzero(own[k - 1 :]) + k - 1
        last = last[piece[last - k + 1] == piece[last]]
        parts.append((starts[last - k + 1], ends[last] - starts[last - k + 1], rows[piece[last]]))
    start, length, row = (np.concatenate(x) for x in zip(*parts, strict=True))
    return data, start, length, row, rows[piece[own]]


def bucket_counts(docs: DataFrame) -> DataFrame:
    """(bucket, n): features of docs(text) in each bucket; a task sends a row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for piece in batches_of(texts_of(batch)):
                data, start, length, *_ = ngrams(*piece)
                table = Interned(data, start, length)
                np.add.at(n, table.bucket[table.used], table.count[table.used])
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["bucket", "n"])

    return docs.select("text").where(F.length("text") > 0).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _counts(docs: DataFrame) -> np.ndarray:
    out = np.zeros(BUCKETS, np.int64)
    for r in bucket_counts(docs).collect():  # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of the shares that target and corpus have in each bucket, both smoothed by one."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log(((t + 1) * (s.sum() + BUCKETS)) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weigh(docs: DataFrame, target: DataFrame, keep_text: bool = True) -> DataFrame:
    """docs with n_words, n_features and weight: the sum of the gains of a document's features.

    Corpus and target are counted first, by a row per bucket and task. Then texts are read again: n-grams of a batch are
    interned, and each occurrence takes the gain of its place. Memory is bounded by TABLE_BYTES of text, or the words of an Arrow batch.
    """
    prepare(docs.sparkSession)
    gain = gains(_counts(docs), _counts(target))
    rows = docs.drop("n_words", "n_features", "weight")
    fields = [f for f in rows.schema.fields if keep_text or f.name != "text"]
    added = ["n_words", "n_features", "weight"]
    schema = T.StructType([*fields, *(T.StructField(k, T.LongType()) for k in added)])
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in added)
            for piece in batches_of(texts_of(batch)):
                data, start, length, row, of_word = ngrams(*piece)
                table = Interned(data, start, length)
                words += np.bincount(of_word, minlength=batch.num_rows)
                features += np.bincount(row, minlength=batch.num_rows)
                np.add.at(weight, row, gain[table.bucket][table.slot])
            kept = [batch.column(batch.schema.get_field_index(k)) for k in names]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x) for x in (words, features, weight))], names=[*names, *added])

    return rows.mapInArrow(run, schema)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Whole thousandths of a Gumbel variate that seed and id decide; a null id counts as empty text."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def add_rank(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """rows with their place 1, 2, 3 ... in the order: sorted by ranges, counted by range, so that no task sees them all.

    The number of ranges is that of the shuffle's partitions; their counts alone go to the driver.
    """
    spark = rows.sparkSession
    placed = materialise(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    before, offsets = 0, []
    for r in placed.groupBy(part.alias("p")).count().orderBy("p").collect():
        offsets.append((r["p"], before))
        before += r["count"]
    offsets = F.broadcast(spark.createDataFrame(offsets, "_p long, _before long"))
    return placed.join(offsets, part == F.col("_p")).withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_at", "_p", "_before")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, keep_text: bool = True) -> DataFrame:
    """docs with n_features, weight, score and rank; the drawn ones have a rank, the others none.

    Of the documents with at least least_words words, percent of a hundred are drawn, those with the highest scores: weight
    plus a seeded Gumbel variate, which is a draw without replacement by importance. Of equal scores the smaller doc_id
    ranks first.

    Null and empty texts have no feature and weight 0; texts of any length count whole. A null doc_id counts as empty text
    in the variate and ranks last of equal scores; rows that repeat are documents of their own. Without target texts all
    weights favour rare buckets; an empty table gives an empty one. Columns of docs with the added names are replaced.
    """
    inner, restore = shield(docs, ["doc_id", "text"])
    rows = weigh(inner, target, keep_text).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    rows = materialise(rows, "weights")
    can = F.col("n_words") >= least_words
    drawn = rows.where(can).count() * percent // 100
    ranked = add_rank(rows.where(can), [F.col("score").desc(), F.col("doc_id").asc_nulls_last()])
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    out = ranked.unionByName(rows.where(~can).withColumn("rank", F.lit(None).cast("long")))
    added = ["n_features", "weight", "score", "rank"]
    return restore(out, added) if keep_text else out.select("doc_id", *added)


def op11(docs: DataFrame, target: DataFrame) -> DataFrame:
    return resample(docs.select("doc_id", "text"), target, keep_text=False)
