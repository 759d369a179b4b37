"""SimHash near-dedup: generalised pigeonhole with unequal thresholds, chosen by dynamic programming, then probe and verify."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import broadcast_if_small, materialise, prepare, row_ordinal, shield, stored, shuffle_parts
from .components import Forest, connected_components

BITS = 64
#: Fingerprints that one bucket may hold before it is split by further bits.
BUCKET = 20_000
#: Times that buckets are split by further bits; what is larger then is dealt out in pairs of blocks of BUCKET fingerprints.
SPLITS = 3
#: Keys of such buckets are broadcast up to so many rows.
MAX_BROADCAST = 1_000_000
#: Cost of a key against that of a candidate pair.
KEY_COST = 4.0
_PLACES = (np.arange(8, dtype=np.int64) * 256)[None, :]
_TABLE = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)


def fingerprint(text: str | None, words: int = 3, repeats: bool = True) -> int:
    """SimHash of the text's word shingles, with their repeats or once each; A-Z in lower case; no words: 0."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w)] if len(w) < words else map(b" ".join, zip(*(w[k:] for k in range(words)), strict=False))
    h = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64)
    return of_hashes(h if repeats else np.unique(h))


def of_hashes(h: np.ndarray) -> int:
    """SimHash of shingles given by their hashes: a bit is set if it is in over half of them."""
    if not len(h):
        return 0
    seen = np.bincount((h.view(np.uint8).reshape(-1, 8) + _PLACES).ravel(), minlength=2048).reshape(8, 256)
    ones = (seen @ _TABLE).ravel() * 2 > len(h)
    return int(np.packbits(ones, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, words: int = 3, check_words: int = 0) -> DataFrame:
    """(doc_id, _ord, fp, check) from docs(doc_id, text, _ord), as signed longs.

    check is a second fingerprint, over distinct shingles of check_words words, or 0 if check_words is.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            made = [np.array([fingerprint(t, words) for t in texts], np.uint64), np.array([fingerprint(t, check_words, False) if check_words else 0 for t in texts], np.uint64)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(x.view(np.int64)) for x in made)], names=["doc_id", "_ord", "fp", "check"])

    kind = docs.schema["doc_id"]
    return docs.select("doc_id", "text", "_ord").mapInArrow(run, T.StructType([kind, *(T.StructField(k, T.LongType()) for k in ("_ord", "fp", "check"))]))


# -- the partition of the bits and its thresholds


def bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many two bits are set together (64 x 64)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS), np.int64)
        for batch in batches:
            x = np.unpackbits(batch.column(0).to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total[:BITS] += (x.T @ x).astype(np.int64)
            total[BITS, 0] += len(x)
        at = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], names=["at", "n"])

    rows = prints.select("fp").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    total = np.zeros((BITS + 1) * BITS, np.int64)
    for r in rows:
        total[r["at"]] = r["n"]
    total = total.reshape(BITS + 1, BITS)
    return int(total[BITS, 0]), total[:BITS]


def group_bits(n: int, together: np.ndarray, parts: int, bits: list[int] | None = None) -> list[list[int]]:
    """`bits` in `parts` groups of near equal size; each takes in turn the free bit that correlates most with its own."""
    bits = list(range(BITS)) if bits is None else bits
    share = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.clip(share * (1 - share), 1e-12, None))
    related = np.abs(together / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    free, groups = set(bits), []
    for _ in range(parts):  # seeds: the bits that split the fingerprints most evenly
        groups.append([max(sorted(free), key=lambda b: spread[b])])
        free.discard(groups[-1][0])
    while free:
        for g in groups:
            if free:
                best = max(sorted(free), key=lambda b: related[b, g].sum())
                g.append(best)
                free.discard(best)
    return [sorted(g) for g in groups]


def allocate(n: int, together: np.ndarray, distance: int, max_parts: int = 4) -> tuple[list[list[int]], list[int]]:
    """The groups of bits and a threshold for each (-1: not probed, 0: equal, 1: one bit may differ).

    Thresholds that sum to distance - groups + 1 miss no pair within the distance. Candidates of a group at a
    threshold are estimated from the groups' chances that 0 or 1 bits differ; for each number of groups a dynamic
    programme over the sum finds the thresholds of least cost, and the cheapest number is taken.
    """
    share = np.diag(together) / max(n, 1)
    differ = 2 * share * (1 - share)
    best: tuple[float, list[list[int]], list[int]] | None = None
    for parts in range(2, max_parts + 1):
        groups = group_bits(n, together, parts)
        costs = []
        for g in groups:
            none, one = 1.0, 0.0
            for b in g:
                none, one = none * (1 - differ[b]), one * (1 - differ[b]) + none * differ[b]
            pairs = n * n / 2
            costs.append({-1: 0.0, 0: pairs * none + KEY_COST * n, 1: pairs * (none * len(g) + one) + KEY_COST * n * len(g)})
        reach: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            step: dict[int, tuple[float, list[int]]] = {}
            for total, (spent, chosen) in reach.items():
                for t, c in cost.items():
                    if total + t not in step or spent + c < step[total + t][0]:
                        step[total + t] = (spent + c, [*chosen, t])
            reach = step
        found = reach.get(distance - parts + 1)
        if found and (best is None or found[0] < best[0]):
            best = (found[0], groups, found[1])
    if best is None:
        raise ValueError(f"no thresholds of -1, 0 and 1 reach distance {distance}; raise max_parts")
    return best[1], best[2]


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >= 1 << 63 else m


def signatures(groups: list[list[int]], thresholds: list[int]) -> list[list[int]]:
    """Sets of bits; fingerprints within the thresholds agree on all bits of at least one set."""
    out = []
    for g, t in zip(groups, thresholds, strict=True):
        out += [g] if t == 0 else [[x for x in g if x != b] for b in g] if t == 1 else []
    return out


def _keyed(prints: DataFrame, sets: list[list[int]], before: Column) -> DataFrame:
    masks = F.array(*(F.lit(_mask(s)).cast("long") for s in sets))
    each = prints.select("node", "fp", "check", before.alias("_before"), F.posexplode(masks).alias("_no", "_m"))
    return each.select(F.xxhash64("_before", "_no", F.col("fp").bitwiseAND(F.col("_m"))).alias("key"), "node", "fp", "check")


# -- probing and verifying


def _near(fp: np.ndarray, check: np.ndarray, i, j, distance: int, check_distance: int) -> np.ndarray:
    near = np.bitwise_count(fp[i] ^ fp[j]) <= distance
    return near if check_distance >= BITS else near & (np.bitwise_count(check[i] ^ check[j]) <= check_distance)


def link_buckets(keys: np.ndarray, nodes: np.ndarray, fp: np.ndarray, check: np.ndarray, distance: int, check_distance: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links between nodes of equal key, for whole buckets in key order: enough links to connect what links."""
    start = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]
    size = np.diff(np.concatenate([start, [len(keys)]]))
    a, b = [nodes[:0]], [nodes[:0]]
    small = size <= 32
    rest = np.repeat(np.where(small, size, 0), size) - (np.arange(len(keys)) - np.repeat(start, size))
    i = np.arange(len(keys))
    for d in range(1, 32):  # row i against row i + d of its bucket, all small buckets at once
        i = i[rest[i] > d]
        if not len(i):
            break
        near = i[_near(fp, check, i, i + d, distance, check_distance)]
        a.append(nodes[near])
        b.append(nodes[near + d])
    for s, n in zip(start[~small], size[~small], strict=True):
        forest = Forest(n)
        for k in range(n - 1):
            forest.link(k, np.nonzero(_near(fp, check, s + k, slice(s + k + 1, s + n), distance, check_distance))[0] + k + 1)
        a.append(nodes[s + np.array([p for p, _ in forest.kept], np.int64)])
        b.append(nodes[s + np.array([q for _, q in forest.kept], np.int64)])
    return np.concatenate(a), np.concatenate(b)


def _link(keyed: DataFrame, distance: int, check_distance: int) -> DataFrame:
    """Links (a, b) of the buckets of keyed; buckets come sorted and whole, a batch's last one waits for the next batch."""

    def linked(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        key, node, fp, check = (np.concatenate(c) for c in zip(*parts, strict=True))
        found = link_buckets(key, node, fp.view(np.uint64), check.view(np.uint64), distance, check_distance)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[np.ndarray]] = []
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            if not len(columns[0]):
                continue
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            if cut or (waiting and waiting[-1][0][-1] != columns[0][-1]):
                yield linked([*waiting, [c[:cut] for c in columns]])
                waiting = []
            waiting.append([c[cut:] for c in columns])
        if waiting:
            yield linked(waiting)

    n = shuffle_parts(keyed.sparkSession)
    return keyed.repartition(n, "key").sortWithinPartitions("key", "node").mapInArrow(run, "a long, b long")


def _in_blocks(keyed: DataFrame) -> DataFrame:
    """keyed, whose buckets have `count` fingerprints, as groups of two blocks of about BUCKET: every two fingerprints of a bucket meet in one."""
    blocks = F.ceil(F.col("count") / BUCKET).cast("int")
    dealt = keyed.withColumns({"_k": blocks, "_t": F.pmod(F.xxhash64("node"), blocks).cast("int")}).withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return dealt.select(F.xxhash64("key", F.least("_t", "_o"), F.greatest("_t", "_o")).alias("key"), "node", "fp", "check")


def near_prints(prints: DataFrame, distance: int = 2, check_distance: int = BITS) -> DataFrame:
    """(a, b) links of prints(node, fp, check) that connect whatever lies within both distances.

    A bucket above BUCKET agrees on its group's bits; it is dealt again by other cuts of all bits into distance + 1
    parts, one of which must be equal for a pair to link; so on for SPLITS rounds, always with all of its
    fingerprints. Buckets that are large even then are compared block by block over many tasks. Each bucket or pair of blocks gives a
    spanning forest of its links instead of all its pairs.
    """
    n, together = bit_counts(prints)
    groups, thresholds = allocate(n, together, distance)
    keyed, links = _keyed(prints, signatures(groups, thresholds), F.lit(0)), None
    for split in range(SPLITS + 1):
        hot = materialise(keyed.groupBy("key").count().where(F.col("count") > BUCKET), "hot-buckets")
        any_hot = hot.limit(1).count() > 0
        hot = broadcast_if_small(hot, MAX_BROADCAST)
        found = _link(keyed.join(hot, "key", "left_anti") if any_hot else keyed, distance, check_distance)
        links = found if links is None else links.union(found)
        if not any_hot:
            break
        large = keyed.join(hot, "key")
        if split == SPLITS:
            links = links.union(_link(_in_blocks(large), distance, check_distance))
            break
        parts = group_bits(n, together, (distance + 1) * (split + 2))
        again = [sorted(b for g in parts[k :: distance + 1] for b in g) for k in range(distance + 1)]
        keyed = _keyed(large, again, F.col("key"))
    return links


def label(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """(_ord, doc_id, fingerprint, component_id, root) for every row of docs; _ord is the row's number in the scan.

    Rows with one fingerprint collapse before any join, so groups of copies cost one row per task; texts leave the JVM
    once and are never shuffled.
    """
    keys = materialise(with_fingerprints(stored(docs).select("doc_id", "text", row_ordinal().alias("_ord")), words), "prints")
    prints = materialise(keys.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumns({"node": F.col("fp"), "check": F.lit(0).cast("long")}), "distinct-prints")
    parts = connected_components(near_prints(prints.select("node", "fp", "check"), distance)).withColumnRenamed("node", "_node")
    labelled = prints.join(parts, F.col("fp") == F.col("_node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    roots = labelled.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "_root")
    ids = labelled.join(roots, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), "root", "component_id")
    return keys.join(ids, F.col("fp") == F.col("_fp")).select("_ord", "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")


def near_documents(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """docs with fingerprint (16 hex digits) and component_id, the smallest doc_id reachable over links.

    A text without words, null or empty, has fingerprint zero and links like others. Null doc_ids rank after all others;
    a component of nulls alone has id null. Repeated doc_ids and rows, extra columns and empty tables are fine; columns
    with the added names are replaced.
    """
    inner, restore = shield(stored(docs), ["doc_id", "text"])
    found = label(inner, words, distance).select("_ord", "fingerprint", "component_id")
    return restore(inner.withColumn("_row", row_ordinal()).join(found, F.col("_row") == F.col("_ord")), ["fingerprint", "component_id"])


def op7(docs: DataFrame) -> DataFrame:
    return label(docs.select("doc_id", "text")).select("doc_id", "fingerprint", "component_id")
