"""Substring dedup with prefix-partitioned suffix trees over words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, broadcast_if_small, materialise, prepare, row_ordinal, shield, stored, shuffle_parts

#: Words of a window, and the most words of a prefix before it is the whole window.
WINDOW, PREFIX = 20, 6
#: Suffixes at anchors that a subtree may have; the prefix of a larger one grows.
SUBTREE = 2_000
#: Words of which a suffix carries 16 bits each; prefixes of 1 to LEAD words are told by them.
LEAD = 4
#: Code of an anchor whose windows go by themselves.
WHOLE = 7
#: Pieces that a task remembers, to send equal ones once.
REMEMBERED = 60_000
#: Rows of whole copies are broadcast up to so many.
MAX_BROADCAST = 1_000_000
_B = np.uint64(0x9E3779B97F4A7C15)
_PLACE_BITS = np.uint64(24)


class _Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _Hashes()


def _sliding_least(run: np.ndarray, width: int) -> np.ndarray:
    """Places of the least value in each slice of `width`, the leftmost of equals.

    Place numbers ride in the low bits, and slices double: the least of 2d values is the lesser of two of d. Texts of
    more than 2^24 words, whose places don't fit, take the direct way.
    """
    n = len(run) - width + 1
    if len(run) >> int(_PLACE_BITS):
        return np.lib.stride_tricks.sliding_window_view(run >> _PLACE_BITS, width).argmin(axis=1) + np.arange(n)
    least, depth = (run >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(run), dtype=np.uint64), 1
    while depth * 2 <= width:
        least = np.minimum(least[:-depth], least[depth:])
        depth *= 2
    least = np.minimum(least[:n], least[width - depth : width - depth + n])
    return (least & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64)


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def anchors(h: np.ndarray, window: int = WINDOW, prefix: int = PREFIX) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, first window, last window) of each anchor of words with hashes h.

    The anchor of a window is that one of its runs of `prefix` words with the least hash, the leftmost of equals. It depends on
    the window's words alone, so equal windows have equal anchors at equal offsets: to find all repeats it is enough
    to sort out the suffixes at anchors, about one word in eight, and each window belongs to one anchor.
    """
    n = len(h)
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none
    runs = n - prefix + 1
    run = np.zeros(runs, np.uint64)
    for k in range(prefix):
        run = run * _B + h[k : k + runs]
    run ^= run >> np.uint64(31)
    run *= np.uint64(0xBF58476D1CE4E5B9)
    run ^= run >> np.uint64(29)
    least = _sliding_least(run, window - prefix + 1)
    first = np.nonzero(np.concatenate([[True], least[1:] != least[:-1]]))[0]
    last = np.concatenate([first[1:], [len(least)]]) - 1
    return least[first], run[least[first]], first, last


def leads(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """16 bits of each of the first LEAD words of the suffixes at `at`, the first word's highest: a prefix of words is a prefix of bits."""
    out = np.zeros(len(at), np.uint64)
    for k in range(LEAD):
        out = out << np.uint64(16) | h[at + k] & np.uint64(0xFFFF)
    return out


def prefix_keys(lead: np.ndarray, run: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Keys of prefixes of the given numbers of words: bits of lead up to LEAD words, the hash of all PREFIX words beyond."""
    short = lead >> np.uint64(16) * np.maximum(LEAD - length, 0).astype(np.uint64)
    mixed = (short + np.uint64(1)) * _B ^ length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return np.where(length <= LEAD, mixed, run)


def prefix_lengths(counts: DataFrame) -> DataFrame:
    """(_lead, words) of counts(lead, n): the fewest words, 1 to LEAD, whose prefix at most SUBTREE suffixes have, else PREFIX.

    Suffixes are counted over all documents, level by level, each level from the counts of whole leads; so subtrees are
    bounded at any size, and the prefixes chosen are free of one another: all suffixes below a prefix have the same counts.
    """
    words, out = F.lit(PREFIX), counts
    for k in range(LEAD, 0, -1):
        prefix = F.shiftrightunsigned("lead", 16 * (LEAD - k))
        level = counts.groupBy(prefix.alias(f"_p{k}")).agg(F.sum("n").alias(f"_c{k}"))
        out = out.join(level, prefix == F.col(f"_p{k}"))
        words = F.when(F.col(f"_c{k}") <= SUBTREE, F.lit(k)).otherwise(words)
    return out.select(F.col("lead").alias("_lead"), words.alias("words"))


class SuffixTree:
    """The suffix tree of some pieces, as sorted suffixes and what each shares with the next.

    words are numbers, equal exactly for equal words, of all pieces one after another; ends[i] is the end of the piece
    of place i. Suffixes that start at `starts` are sorted: all places are ranked by 1, 2, 4, ... words, each rank from two
    shorter ones, up to the longest piece. The ranks give the longest common prefix of neighbours too, and with it the
    internal nodes: a node of depth d is a run of sorted suffixes whose neighbours share d words or more.
    """

    def __init__(self, words: np.ndarray, ends: np.ndarray, starts: np.ndarray):
        places = np.arange(len(words))
        longest, depth = int((ends - places).max(initial=0)), 1
        ranks = [np.unique(words, return_inverse=True)[1].astype(np.int64) + 1]
        while depth < longest:
            rank = ranks[-1]
            after = np.minimum(places + depth, len(words) - 1)
            pair = rank * (len(words) + 2) + np.where(places + depth < ends, rank[after], 0)
            ranks.append(np.unique(pair, return_inverse=True)[1].astype(np.int64) + 1)
            depth *= 2
        self.order = np.argsort(ranks[-1][starts], kind="stable")
        sorted_ = starts[self.order]
        a, b = sorted_[:-1].copy(), sorted_[1:].copy()
        end_a, end_b = ends[a], ends[b]
        shared = np.zeros(len(a), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            rank, inside = ranks[level], (a < end_a) & (b < end_b)
            same = inside & (rank[np.minimum(a, len(words) - 1)] == rank[np.minimum(b, len(words) - 1)])
            step = same * (1 << level)
            a, b, shared = a + step, b + step, shared + step
        self.shared = np.minimum(shared, np.minimum(end_a - sorted_[:-1], end_b - sorted_[1:]))

    def deep_nodes(self, least: int) -> np.ndarray:
        """For each of `starts`: the uppermost internal node of depth `least` or more above it, as a number; -1 where there is none.

        What lies below such a node repeats its first `least` words; nodes further down repeat more.
        """
        deep = self.shared >= least
        node = np.cumsum(np.concatenate([[True], ~deep])) - 1
        alone = ~(np.concatenate([[False], deep]) | np.concatenate([deep, [False]]))
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.where(alone, -1, node)
        return out

    def internal_nodes(self, least: int) -> list[tuple[int, np.ndarray]]:
        """(depth, places in `starts` below it) of every internal node of depth `least` or more, upper ones after those below them."""
        out, open_ = [], []  # open nodes as (depth, first place in order)
        for i, depth in enumerate([*self.shared.tolist(), 0]):
            first = i
            while open_ and open_[-1][0] > depth:
                d, first = open_.pop()
                if d >= least:
                    out.append((d, np.sort(self.order[first : i + 1])))
            if depth and (not open_ or open_[-1][0] < depth):
                open_.append((depth, first))
        return out


def _anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    """(key, lead, rid, at) of every anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, first, rids, places = [], [], [], []
            for rid, text in zip(batch.column(0).to_numpy(), batch.column(1).to_pylist(), strict=True):
                h = hashes_of((text or "").encode().split())
                at, key, _, _ = anchors(h, window)
                keys.append(key.view(np.int64))
                first.append(leads(h, at).view(np.int64))
                rids.append(np.full(len(at), rid))
                places.append(at.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, first, rids, places)], names=["key", "lead", "rid", "at"])

    return docs.select("rid", "text").mapInArrow(run, "key long, lead long, rid long, at int")


_PIECE = {"key": pa.int64(), "no_id": pa.bool_(), "id": pa.int64(), "rid": pa.int64(), "at": pa.int32(), "n": pa.int32(), "words": pa.binary()}


class _Pieces:
    """Pieces of one task on their way out; of equal ones only the earliest is sent with its words, the windows of the others are known to be later."""

    def __init__(self, collapse: bool):
        self.rows: list[list] = [[] for _ in _PIECE]
        self.seen: dict[tuple[int, bytes], tuple] = {}
        self.collapse = collapse

    def _put(self, key, place, words) -> None:
        for column, value in zip(self.rows, (key, *place, words), strict=True):
            column.append(value)

    def add(self, key: int, place: tuple, words: bytes) -> None:
        """place: (no_id, id, rid, at, n) of a piece with n windows."""
        if not self.collapse:
            self._put(key, place, words)
            return
        old = self.seen.setdefault((key, words), place)
        if old is place:
            if len(self.seen) > REMEMBERED:
                self.flush()
            return
        early, late = min(old, place), max(old, place)
        self.seen[key, words] = early
        self._put(late[2], late, None)

    def flush(self) -> None:
        for (key, words), place in self.seen.items():
            self._put(key, place, words)
        self.seen = {}

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, [[] for _ in _PIECE]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, _PIECE.values(), strict=True)], names=list(_PIECE))


def _pieces(docs: DataFrame, window: int, collapse: bool) -> DataFrame:
    """(key, no_id, id, rid, at, n, words): of docs(rid, no_id, id, text, some), for each anchor among `some`, the words that its n windows cover.

    key is that of the anchor suffix's prefix. some holds 8 x place plus the number of words of the prefix, or WHOLE where even PREFIX
    words are too frequent: there each window goes by itself, with all its words for a prefix. Rows without words are windows that a piece of the same task has shown to be later.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Pieces(collapse)
        for batch in batches:
            for rid, no_id, doc, text, some in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                words = text.encode().split()
                h = hashes_of(words)
                at, run, first, last = anchors(h, window)
                some = np.sort(np.array(some, np.int64))
                where = np.searchsorted(at, some >> 3)
                key = prefix_keys(leads(h, at[where]), run[where], some & 7)
                for k, s, e, hot in zip(key.view(np.int64).tolist(), first[where].tolist(), last[where].tolist(), ((some & 7) == WHOLE).tolist(), strict=True):
                    if hot:
                        for w in range(s, e + 1):
                            piece = b" ".join(words[w : w + window])
                            out.add(xxhash.xxh64_intdigest(piece) - (1 << 63), (no_id, doc, rid, w, 1), piece)
                    else:
                        out.add(k, (no_id, doc, rid, s, e - s + 1), b" ".join(words[s : e + window]))
            yield out.take()
        out.flush()
        yield out.take()

    return docs.select("rid", "no_id", "id", "text", "some").mapInArrow(cut, "key long, no_id boolean, id long, rid long, at int, n int, words binary")


_LATER = "rid long, at int, n int, of_rid long, of_at int"


def _later_in_subtrees(table: pa.Table, window: int) -> pa.RecordBatch:
    """(rid, at, n, of_rid, of_at) of windows that also start earlier, for whole subtrees; rows come by key, no_id, id, rid, at.

    of_rid and of_at say where a window starts first, null for those that are only known to be later. A piece equal to
    one before it in its subtree is later as a whole. A subtree of one piece has no node to look for.
    """
    key, rid, at, n = (table[k].to_numpy() for k in ("key", "rid", "at", "n"))
    texts = table["words"].to_pylist()
    known = np.fromiter((t is None for t in texts), bool, len(texts))
    seen: dict[tuple[int, bytes], int] = {}
    new: list[int] = []
    equal: list[tuple[int, int]] = []
    for i in np.nonzero(~known)[0].tolist():
        old = seen.setdefault((int(key[i]), texts[i]), i)
        if old == i:
            new.append(i)
        else:
            equal.append((i, old))
    none = np.full(int(known.sum()), -1)
    out = [(rid[known], at[known], n[known], none, none)]
    rows, twins = np.array(new, np.int64), np.array(equal, np.int64).reshape(-1, 2)
    source_rid, source_at = np.zeros(0, np.int64), np.zeros(0, np.int64)  # of each window of rows, where it starts first
    own = n[rows].astype(np.int64)
    if len(rows):
        row = np.repeat(np.arange(len(rows)), own)
        step = np.arange(len(row)) - np.repeat(np.cumsum(own) - own, own)
        source_rid, source_at = rid[rows][row], at[rows][row] + step
        edge = np.concatenate([[True], key[rows][1:] != key[rows][:-1], [True]])
        shared = ~(edge[:-1] & edge[1:])  # windows of one piece have different offsets from its anchor, so they differ
        split = [texts[i].split() for i in rows[shared].tolist()]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        names: dict[bytes, int] = {}
        number = np.fromiter((names.setdefault(w, len(names)) for words in split for w in words), np.int64, int(sizes.sum()))
        begin = np.cumsum(sizes) - sizes
        inside = np.nonzero(shared[row])[0]
        if len(inside):
            place = np.cumsum(shared) - 1
            node = SuffixTree(number, np.repeat(begin + sizes, sizes), begin[place[row[inside]]] + step[inside]).deep_nodes(window)
            below = inside[node >= 0]
            node = node[node >= 0]
            _, first, of = np.unique(node, return_index=True, return_inverse=True)  # rows are in document order, so the first place below a node is the earliest
            source = below[first][of]
            source_rid[below], source_at[below] = source_rid[source], source_at[source]
        later = (source_rid != rid[rows][row]) | (source_at != at[rows][row] + step)
        out.append((rid[rows][row][later], (at[rows][row] + step)[later], np.ones(int(later.sum()), np.int64), source_rid[later], source_at[later]))
    if len(twins):
        begin = np.zeros(len(texts), np.int64)
        begin[rows] = np.cumsum(own) - own
        late, early = twins[:, 0], twins[:, 1]
        count = n[late].astype(np.int64)
        row = np.repeat(np.arange(len(twins)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        window_of = begin[early][row] + step
        out.append((rid[late][row], at[late][row] + step, np.ones(len(row), np.int64), source_rid[window_of], source_at[window_of]))
    made = [np.concatenate(c) for c in zip(*out, strict=True)]
    unknown = made[3] < 0
    arrays = [pa.array(made[0], pa.int64()), pa.array(made[1].astype(np.int32)), pa.array(made[2].astype(np.int32)), pa.array(made[3].astype(np.int64), pa.int64(), mask=unknown), pa.array(made[4].astype(np.int32), pa.int32(), mask=unknown)]
    return pa.RecordBatch.from_arrays(arrays, names=["rid", "at", "n", "of_rid", "of_at"])


def _subtrees(pieces: DataFrame, window: int) -> DataFrame:
    """(rid, at, n, of_rid, of_at): n windows from `at` on that also start earlier, subtree by subtree; a batch's last subtree waits for the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            changed = cut or (waiting and waiting[-1].column(0)[-1].as_py() != keys[-1])
            if changed and held + cut >= 20_000:  # a few batches at once: fewer, larger numpy calls
                yield _later_in_subtrees(pa.Table.from_batches([*waiting, batch.slice(0, cut)]), window)
                waiting, held = [], 0
                batch = batch.slice(cut)
            waiting.append(batch)
            held += batch.num_rows
        if waiting:
            yield _later_in_subtrees(pa.Table.from_batches(waiting), window)

    parts = shuffle_parts(pieces.sparkSession)
    return pieces.repartition(parts, "key").sortWithinPartitions("key", "no_id", "id", "rid", "at").mapInArrow(run, _LATER)


def whole_copies(texts: DataFrame) -> DataFrame:
    """(_copy, of): rows of texts(rid, no_id, id, text) whose text, byte for byte, is that of the earlier row `of`.

    Rows group by 128-bit hash; the texts of hashes that occur again are compared by grouping on them. A hash that two different texts
    share is left to the windows.
    """
    hashed = materialise(texts.where("text IS NOT NULL").select("rid", "no_id", "id", F.unhex(F.md5("text")).alias("h")), "hashes")
    again = broadcast_if_small(materialise(hashed.groupBy("h").count().where("count > 1").select(F.col("h").alias("_h")), "hashes-again"), MAX_BROADCAST)
    same = texts.where("text IS NOT NULL").withColumn("h", F.unhex(F.md5("text"))).join(again, F.col("h") == F.col("_h"), "left_semi")
    same = same.groupBy("h", "text").agg(F.min(F.struct("no_id", "id", "rid")).alias("first"))
    first = same.groupBy("h").agg(F.min("first").alias("first"), F.count("*").alias("c")).where("c = 1")
    first = first.select(F.unhex(F.hex("h")).alias("_h"), F.col("first.rid").alias("of"))  # computed, for the reason given below
    return hashed.join(first, F.col("h") == F.col("_h")).where("rid <> of").select(F.col("rid").alias("_copy"), "of")


def _found(texts: DataFrame, window: int, collapse: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(windows that also start earlier, whole copies, texts dealt by rid) of texts(rid, no_id, id, text)."""
    copies = materialise(whole_copies(texts), "copies")
    single = texts.join(broadcast_if_small(copies, MAX_BROADCAST), F.col("rid") == F.col("_copy"), "left_anti")
    found = materialise(_anchor_rows(single, window), "anchors")
    # a computed key on one side has both sides shuffled for the join, so that the rows of a frequent key can be split
    often = found.groupBy("key").count().where("count > 1").select(F.bitwise_not(F.bitwise_not("key")).alias("_key"), (F.col("count") > SUBTREE).cast("int").alias("hot"))
    part = materialise(found.join(often, F.col("key") == F.col("_key")).select("lead", "rid", "at", "hot"), "repeated-anchors")
    counts = materialise(part.where("hot = 0").groupBy("lead").agg(F.count("*").alias("n")), "leads")
    lengths = broadcast_if_small(materialise(prefix_lengths(counts), "prefixes"), MAX_BROADCAST)
    part = part.join(lengths, (F.col("lead") == F.col("_lead")) & (F.col("hot") == 0), "left")
    code = F.when(F.col("hot") == 1, F.lit(WHOLE)).otherwise(F.col("words"))
    some = part.groupBy("rid").agg(F.collect_list(F.col("at").cast("long") * 8 + code).alias("some")).select(F.col("rid").alias("_rid"), "some")
    dealt = texts.repartition(shuffle_parts(texts.sparkSession), "rid")
    pieces = _pieces(dealt.join(some, F.col("rid") == F.col("_rid")), window, collapse)
    return _subtrees(pieces, window), copies, dealt


def _texts(rows: DataFrame) -> DataFrame:
    return rows.select("rid", F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text")


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, at, n_words, of_doc_id, of_at): the maximal repeats of docs, each with the place where its words stand first.

    A window below a deep node repeats the earliest window below it. Windows that follow one another and repeat
    windows that follow one another are one repeat, as long as they go on, so it can be grown at neither end. A row
    that is a whole copy is one repeat of the first such row, from its first word to its last.
    """
    prepare(docs.sparkSession)
    inner, _ = shield(stored(docs), ["doc_id", "text"])
    rows = inner.withColumn("rid", row_ordinal())
    later, copies, _ = _found(_texts(rows), window, collapse=False)
    by_place = W.partitionBy("rid", "of_rid", F.col("of_at") - F.col("at")).orderBy("at")
    runs = later.withColumn("_run", F.col("at") - F.row_number().over(by_place)).groupBy("rid", "of_rid", (F.col("of_at") - F.col("at")).alias("_off"), "_run")
    found = runs.agg(F.min("at").alias("at"), (F.count("*") + window - 1).alias("n_words")).select("rid", "at", "n_words", "of_rid", (F.col("at") + F.col("_off")).alias("of_at"))
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    whole = copies.join(rows, F.col("_copy") == F.col("rid")).select("rid", F.lit(0).alias("at"), words.alias("n_words"), F.col("of").alias("of_rid"), F.lit(0).alias("of_at")).where("n_words > 0")
    named = rows.select(F.col("rid").alias("_rid"), "doc_id")
    out = found.union(whole).join(named, F.col("rid") == F.col("_rid")).drop("_rid")
    return out.join(named.withColumnRenamed("doc_id", "of_doc_id"), F.col("of_rid") == F.col("_rid")).select("doc_id", "at", "n_words", "of_doc_id", "of_at")


def remove_repeats(docs: DataFrame, window: int = WINDOW, keep_text: bool = True) -> DataFrame:
    """docs with n_words, n_removed, kept (the words left, joined by one space) and kept_sha256; one row for each row.

    0. Rows whose whole text equals that of an earlier row, byte for byte, are later from start to end.
    1. The suffixes at anchors of all other rows are counted; those whose first words occur once can't lie in a repeat.
    2. The others are split by prefixes of variable length: a prefix grows word by word, then to PREFIX words, while more than
       SUBTREE suffixes have it, counted exactly; where even then more do, the whole window is the prefix. With a suffix go the
       words that its anchor's windows cover. Of equal pieces a task sends one, so that a passage in a third of all
       rows costs a few rows per task.
    3. Each subtree is built in memory from the words themselves: sorted suffixes with what neighbours share. Below
       its internal nodes of depth `window` or more lie the windows that repeat; repeats() gives them as passages.

    A word goes if a window of `window` words over it also starts earlier: in a row with a smaller doc_id, or sooner in the
    same row. Windows are judged on the input. Rows with equal doc_ids are in the order of the scan; null doc_ids come
    after all others. Null and empty texts have no words; a text of any length is one row of one batch, nothing of it
    is cut. An empty table gives an empty one. Columns of docs with the added names are replaced.
    """
    spark = prepare(docs.sparkSession)
    added = ["n_words", "n_removed", "kept", "kept_sha256"]
    inner, restore = shield(stored(docs), ["doc_id", "text"])
    names = inner.columns
    rows = inner.withColumn("rid", row_ordinal())
    parts = shuffle_parts(spark)
    later, copies, dealt = _found(_texts(rows), window, collapse=True)
    later = later.select("rid", "at", "n").union(copies.select(F.col("_copy").alias("rid"), F.lit(0), F.lit(1 << 30)))
    marks = later.groupBy("rid").agg(F.collect_list(F.struct("at", "n")).alias("later")).select(F.col("rid").alias("_rid"), "later")
    out = (dealt if names == ["doc_id", "text"] else rows.repartition(parts, "rid")).join(marks, F.col("rid") == F.col("_rid"), "left")
    if names == ["doc_id", "text"]:
        out = out.withColumn("doc_id", F.when(~F.col("no_id"), F.col("id")))
    out = out.select(*names, "later")
    fields = [f for f in inner.schema.fields if keep_text or f.name != "text"]
    kept_names = [f.name for f in fields]
    more = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), *([T.StructField("kept", T.StringType())] if keep_text else []), T.StructField("kept_sha256", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list] = [[], [], [], []]
            runs = batch.column(batch.schema.get_field_index("later"))
            flat, offsets = runs.values, runs.offsets.to_numpy()
            ats, ns = (flat.field(k).to_numpy().astype(np.int64) for k in ("at", "n"))
            for i, text in enumerate(batch.column(batch.schema.get_field_index("text")).to_pylist()):
                words = (text or "").encode().split()
                n, gone = len(words), 0
                if offsets[i + 1] > offsets[i] and n >= window:
                    edge = np.zeros(n + 1, np.int64)
                    s, last = ats[offsets[i] : offsets[i + 1]], ats[offsets[i] : offsets[i + 1]] + ns[offsets[i] : offsets[i + 1]] - 1
                    np.add.at(edge, s, 1)
                    np.add.at(edge, np.minimum(last + window, n), -1)
                    keep = np.cumsum(edge[:n]) == 0
                    gone = int(n - keep.sum())
                    words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                kept = b" ".join(words)
                for column, value in zip(made, (n, gone, kept.decode() if keep_text else None, hashlib.sha256(kept).hexdigest()), strict=True):
                    column.append(value)
            arrays = [pa.array(made[0], pa.int64()), pa.array(made[1], pa.int64()), *([pa.array(made[2], pa.string())] if keep_text else []), pa.array(made[3], pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(k)) for k in kept_names), *arrays], names=[*kept_names, *(f.name for f in more)])

    out = out.mapInArrow(run, T.StructType([*fields, *more]))
    return restore(out, added) if keep_text else out


def op4(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs.select("doc_id", "text"), keep_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
