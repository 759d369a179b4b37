"""Near copies by exact similarity of word shingles: SimHash and then prefixes in one order of all shingles propose, whole sets decide."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import broadcast_if_small, materialise, prepare, row_ordinal, shield, stored
from .components import connected_components
from .simhash import near_prints, of_hashes

#: Bits that fingerprints of a proposed pair may differ in.
DISTANCE = 2
#: Words of a shingle; the least Jaccard similarity of a link, as a fraction.
WORDS, LEAST = 5, (4, 5)
#: The part of the documents of which frequent shingles are learned, and the least number of them; how many must have a frequent one; how many are kept at most.
SAMPLE_SHARE, SAMPLE_DOCS, FREQUENT, MAX_FREQUENT = 0.1, 4_000, 3, 1_000_000
#: Members of a bucket that meet all others in the first round, and by how much their number grows from round to round.
PIVOTS, GROWTH = 4, 16
#: Bins in which the shingles of a set are counted: what two sets share is at most the sum of the lesser counts.
BINS = 128
#: Nodes that are broadcast to find their texts, at most.
MAX_BROADCAST = 1_000_000


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Hashes of the text's distinct word shingles, sorted; A-Z in lower case; a shorter text is one shingle, no words are none."""
    w = (text or "").encode().lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    each = [b" ".join(w)] if len(w) < words else map(b" ".join, zip(*(w[k:] for k in range(words)), strict=False))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in each), np.uint64))


def prefix_length(n: int, least: tuple[int, int] = LEAST) -> int:
    """How many of n shingles, the first in any order of all, meet those of every set that is similar enough."""
    return n - -(-least[0] * n // least[1]) + 1 if n else 0


def _mapped(docs: DataFrame, schema: str | T.StructType, made: Callable[[list], list[pa.Array]]) -> DataFrame:
    """What made gives for the texts of each batch, after the other columns of docs, which has text first."""
    names = T.StructType.fromDDL(schema).names if isinstance(schema, str) else schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made(batch.column(0).to_pylist())], names=names)

    return docs.mapInArrow(run, schema)


def _lists(each: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, each)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*each, np.zeros(0, np.uint64)]).view(np.int64)))


def frequent_shingles(docs: DataFrame, words: int = WORDS) -> np.ndarray:
    """Shingles that several documents of a sample have, the rarest first. They only order the shingles: any order finds all links.

    The sample grows with the table, so a shingle that some thirty documents share comes late in the order at any size, and passages that
    many documents have make no large buckets; what reaches the driver is bounded.
    """
    n = docs.count()
    share = F.pmod(F.xxhash64(F.lit("near"), "_ord"), F.lit(1 << 30)) < int(min(1.0, max(SAMPLE_SHARE, SAMPLE_DOCS / max(n, 1))) * (1 << 30))
    some = _mapped(docs.where(share).select("text"), "each array<long>", lambda texts: [_lists([shingles(t, words) for t in texts])])
    counts = some.select(F.explode("each").alias("h")).groupBy("h").count().where(F.col("count") >= FREQUENT)
    rows = counts.orderBy(F.desc("count"), "h").limit(MAX_FREQUENT).select("h").toArrow()
    return rows["h"].to_numpy()[::-1].copy().view(np.uint64)


def with_prefixes(docs: DataFrame, frequent: np.ndarray, words: int = WORDS, least: tuple[int, int] = LEAST) -> DataFrame:
    """(doc_id, _ord, d1, d2, n, fp, prefix, bins) from docs(doc_id, text, _ord): digest, size and SimHash of the set, its first shingles, frequent ones last, and counts by bin."""
    place = np.argsort(frequent)
    known = frequent[place]

    def made(texts: list) -> list[pa.Array]:
        sets, first = [shingles(t, words) for t in texts], []
        for s in sets:
            if len(known) and len(s):
                at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                hit = known[at] == s
                s = s[np.argsort(np.where(hit, place[at] + 1, 0), kind="stable")]
            first.append(s[: prefix_length(len(s), least)])
        digests = np.array([np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64) for s in sets], np.int64).reshape(-1, 2)
        return [pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array([len(s) for s in sets], pa.int64()), pa.array(np.array([of_hashes(s) for s in sets], np.uint64).view(np.int64)), _lists(first), pa.array([np.bincount((s & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS) for s in sets], pa.list_(pa.int32()))]

    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(k, T.LongType()) for k in ("_ord", "d1", "d2", "n", "fp")), T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("bins", T.ArrayType(T.IntegerType()))])
    return _mapped(docs.select("text", "doc_id", "_ord"), schema, made)


def _nodes(pairs: DataFrame) -> DataFrame:
    return materialise(pairs.select(F.col("a").alias("_node")).union(pairs.select("b")).distinct(), "near-nodes")


def _sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, grams): all shingles of the rows whose numbers are nodes."""
    some = docs.join(broadcast_if_small(nodes, MAX_BROADCAST), F.col("_ord") == F.col("_node"), "left_semi").select("text", "_ord")
    return materialise(_mapped(some, "node long, grams array<long>", lambda texts: [_lists([shingles(t, words) for t in texts])]), "near-sets")


def confirmed(docs: DataFrame, pairs: DataFrame, words: int = WORDS, least: tuple[int, int] = LEAST) -> DataFrame:
    """The pairs(a, b) whose whole sets reach the similarity."""
    sets = _sets(docs, _nodes(pairs), words)
    left, right = (sets.select(F.col("node").alias(k), F.col("grams").alias(f"grams_{k}")) for k in "ab")
    both = pairs.join(left, "a").join(right, "b").withColumn("_both", F.size(F.array_intersect("grams_a", "grams_b")))
    return both.where(F.col("_both") * least[1] >= (F.size("grams_a") + F.size("grams_b") - F.col("_both")) * least[0]).select("a", "b")


def possible(sets: DataFrame, pairs: DataFrame, least: tuple[int, int] = LEAST) -> DataFrame:
    """pairs(a, b) without those whose counts by bin of sets(node, n, bins) show that they share too little; the others may be similar."""
    p, q = least
    own = sets.join(broadcast_if_small(_nodes(pairs), MAX_BROADCAST), F.col("node") == F.col("_node"), "left_semi")
    left, right = (own.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("bins").alias(f"bins_{k}")) for k in "ab")
    shared = F.aggregate(F.zip_with("bins_a", "bins_b", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)
    return pairs.join(left, "a").join(right, "b").where(shared * (p + q) >= (F.col("n_a") + F.col("n_b")) * p).select("a", "b")


def _may_reach(a: Column, b: Column, least: tuple[int, int]) -> Column:
    """False where sizes and places in the order leave too few shingles to share, if this is the first one shared."""
    p, q = least
    n, m, i, j = a["n"], b["n"], a["pos"], b["pos"]
    return (F.least(n, m) * q >= F.greatest(n, m) * p) & (F.least(n - i, m - j) * (p + q) >= (n + m) * p)


def print_pairs(sets: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b) of sets(node, fp, ...) whose fingerprints SimHash links, by the pigeonhole search of operator 7; of equal fingerprints each with the first."""
    first = materialise(sets.groupBy("fp").agg(F.min("node").alias("node")).withColumn("check", F.lit(0).cast("long")), "near-prints")
    same = sets.select(F.col("node").alias("a"), F.col("fp").alias("_fp")).join(first.select("fp", F.col("node").alias("b")), F.col("fp") == F.col("_fp")).where("a <> b").select("b", "a")
    return near_prints(first.select("node", "fp", "check"), distance).union(same)


#: Parts of a bucket whose members are ranked apart.
SALTS = 64


def ranked_buckets(keyed: DataFrame) -> DataFrame:
    """keyed(node, n, pos, key) of the keys that several rows share, with size, and rank: 1, 2, ... in the bucket.

    Keys are counted with partial counts in each task, and the members of a bucket are ranked in SALTS parts laid end to
    end, so a shingle that very many rows share is no one task's work.
    """
    sizes = keyed.groupBy("key").agg(F.count("*").cast("int").alias("size")).where("size > 1").withColumnRenamed("key", "_key")
    shared = materialise(keyed.join(sizes, F.col("key") == F.col("_key")).drop("_key").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")), "near-buckets")
    counts = shared.groupBy(F.col("key").alias("_key"), F.col("salt").alias("_salt")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_key").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # SALTS rows at most
    counts = counts.select("_key", "_salt", before.alias("_before"))
    placed = shared.withColumn("_at", F.row_number().over(Window.partitionBy("key", "salt").orderBy("node")))
    out = placed.join(counts, (F.col("key") == F.col("_key")) & (F.col("salt") == F.col("_salt")))
    return out.select("node", "n", "pos", "key", (F.col("_before") + F.col("_at")).cast("int").alias("rank"), "size")


def in_several(rest: DataFrame) -> DataFrame:
    """Rows of rest(key, root, ...) whose key has several roots: told by aggregation, and joined back."""
    several = rest.groupBy("key").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a <> _b").select(F.col("key").alias("_key"))
    return rest.join(several, F.col("key") == F.col("_key"), "left_semi")


def near_links(docs: DataFrame, sets: DataFrame, words: int = WORDS, least: tuple[int, int] = LEAST) -> DataFrame | None:
    """(node, component) of all nodes of sets(node, n, fp, prefix, bins) with a link; None if there is no link.

    SimHash proposes first: most copies are linked by near fingerprints, each confirmed by its whole sets. What it
    misses, as similar texts may lie many bits apart, is found by prefixes: rows that share a prefix shingle meet in
    its bucket. In each round a few members of a bucket, the pivots, meet all
    others of it that aren't yet in their component; rounds go on while a bucket has members that have not met and lie
    in two components. So every link is found or joins what is joined already, and a group of near copies costs few
    pairs for each row.
    """
    keyed = sets.select("node", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "key"))
    ranked = materialise(ranked_buckets(keyed), "near-shared")
    links = confirmed_of(docs, sets, materialise(print_pairs(sets), "near-pairs"), words, least)
    shared, done, upto = ranked, 0, PIVOTS
    while True:
        parts = materialise(connected_components(links), "near-parts")
        # what is left: buckets whose members still lie in several components, told in one pass by key
        rest = shared.where(F.col("size") > done + 1).join(broadcast_if_small(parts.withColumnRenamed("node", "_node"), MAX_BROADCAST), F.col("node") == F.col("_node"), "left")
        rest = rest.withColumn("root", F.coalesce("component", "node")).drop("_node", "component")
        shared = materialise(in_several(rest), "near-shared")
        if not shared.limit(1).count():
            return parts if links.limit(1).count() else None
        cells = [F.struct("node", "n", "pos", "rank", "root").alias(k) for k in "xy"]
        pivots = shared.where((F.col("rank") > done) & (F.col("rank") <= upto)).select("key", cells[0])
        x, y = F.col("x"), F.col("y")
        met = pivots.join(shared.select(F.col("key").alias("_key"), cells[1]), (F.col("key") == F.col("_key")) & (y["rank"] > x["rank"]) & (y["root"] != x["root"]) & _may_reach(x, y, least))
        links = links.union(confirmed_of(docs, sets, materialise(met.select(x["node"].alias("a"), y["node"].alias("b")).distinct(), "near-pairs"), words, least))
        shared, done, upto = shared.drop("root"), upto, upto * GROWTH


def confirmed_of(docs: DataFrame, sets: DataFrame, pairs: DataFrame, words: int, least: tuple[int, int]) -> DataFrame:
    """The pairs that are links, written: first by counts, then by whole sets."""
    return materialise(confirmed(docs, materialise(possible(sets, pairs, least), "near-possible"), words, least), "near-links")


def keep_one(docs: DataFrame, words: int = WORDS, least: tuple[int, int] = LEAST) -> DataFrame:
    """docs with one row of each group: that with the smallest doc_id, and of several such rows the first in the scan.

    Rows link if the Jaccard similarity of their distinct word shingles is at least `least`; groups are what links
    connect, so each row that goes has a row of that similarity in its group. Near fingerprints propose links, prefixes of
    the sets all others, so every such link counts, however far apart fingerprints are. Texts without words, null or empty, are equal.
    """
    prepare(docs.sparkSession)
    inner, restore = shield(stored(docs), ["doc_id", "text"])
    texts = inner.select("doc_id", "text", row_ordinal().alias("_ord"))
    keys = materialise(with_prefixes(texts, frequent_shingles(texts, words), words, least), "near-prefixes")
    sets = materialise(keys.groupBy("d1", "d2").agg(F.min("_ord").alias("node"), F.count("*").alias("rows")), "near-distinct")
    own = keys.select("_ord", "n", "fp", "prefix", "bins").join(sets.select("node"), F.col("_ord") == F.col("node")).select("node", "n", "fp", "prefix", "bins")
    parts = near_links(texts, own, words, least)
    if parts is None:
        rooted = sets.where("rows > 1").withColumn("root", F.col("node"))
    else:
        rooted = sets.join(parts.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").where("rows > 1 OR component IS NOT NULL").withColumn("root", F.coalesce("component", "node"))
    groups = rooted.select("d1", "d2", "root")
    found = materialise(keys.select("_ord", "doc_id", "d1", "d2").join(groups, ["d1", "d2"]).select("_ord", "root", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("_rank")), "near-labels")
    best = found.groupBy("root").agg(F.min(F.struct("_rank", "_ord")).alias("_best")).select(F.col("root").alias("_root"), F.col("_best._ord").alias("_stays"))
    gone = materialise(found.join(best, F.col("root") == F.col("_root")).where("_ord <> _stays").select("_ord"), "near-gone")
    return restore(inner.withColumn("_ord", row_ordinal()).join(gone, "_ord", "left_anti"), [])
