"""Near-duplicate vectors by int8 tile products with rigorous error bounds; doubtful pairs are computed again in double."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise, stored
from .components import Forest, connected_components

#: Vectors in a tile on average; rows of a product at a time; pairs that are looked at more closely at a time.
TILE, STEP, PAIRS = 4096, 1024, 65536
#: Labels with their tile counts, and nodes of doubtful pairs, are broadcast up to so many rows.
MAX_BROADCAST = 100_000
#: What sums of products in double may be off, at most.
DUST = 1e-9
_LAST = 2**63 - 1


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, a scale per row, and an upper bound of the length of what is lost."""
    scale = np.maximum(np.abs(unit).max(axis=1), 1e-300) / 127.0
    codes = np.rint(unit / scale[:, None]).clip(-127, 127).astype(np.int8)
    lost = np.linalg.norm(unit - codes * scale[:, None], axis=1)
    return codes, scale, lost * (1 + 1e-9) + 1e-12


def two_codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For vectors as rows: int8 codes of the unit vector and of what these lose (rows x 2 dim), and (scale, bound) of both (rows x 4)."""
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    q, s, e = quantise(unit)
    q2, s2, e2 = quantise(unit - q * s[:, None])
    return np.concatenate([q, q2], axis=1), np.stack([s, e, s2, e2], axis=1)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines in double of rows a[i] and b[i]."""
    return np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))


def tile_links(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], threshold: float, same: bool):
    """((i, j) of sure links, (i, j) of doubtful pairs) between two tiles given by two_codes(); same: a is b, and only i < j.

    With u = s q + e for a unit vector, |u.v - s t q.r| <= |e| + |f| + |e||f| as |s q| <= 1 + |e|: pairs that this
    leaves below the threshold are out. The others are multiplied again with both codes, whose bound is some hundred
    times smaller; what it leaves above is a link, and what it leaves open is doubtful. Products of int8 codes are
    summed in float32, which is exact below 2^24, that is up to 1,040 dimensions; longer vectors are summed in float64.
    """
    (qa, sa), (qb, sb) = a, b
    dim = qa.shape[1] // 2
    exact = np.float32 if dim * 127 * 127 < 1 << 24 else np.float64
    e, f = sa[:, 1, None], sb[None, :, 1]
    rough = (qa[:, :dim].astype(exact) @ qb[:, :dim].astype(exact).T) * sa[:, 0, None].astype(exact) * sb[None, :, 0].astype(exact)
    i, j = np.nonzero(rough >= threshold - (e + f + e * f + 1e-5))
    if same:
        i, j = i[i < j], j[i < j]
    fine, slack = np.zeros(len(i)), np.zeros(len(i))
    whole = [q[:, :dim] * s[:, 0, None] + q[:, dim:] * s[:, 2, None] for q, s in (a, b)]
    for k in range(0, len(i), PAIRS):
        ii, jj = i[k : k + PAIRS], j[k : k + PAIRS]
        fine[k : k + PAIRS] = np.einsum("ij,ij->i", whole[0][ii], whole[1][jj])
        slack[k : k + PAIRS] = sa[ii, 3] + sb[jj, 3] + sa[ii, 3] * sb[jj, 3] + DUST
    sure, open_ = fine - slack >= threshold, np.abs(fine - threshold) < slack
    open_ &= ~sure
    return (i[sure], j[sure]), (i[open_], j[open_])


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(np.float64)


def _coded(kinds: DataFrame) -> DataFrame:
    """kinds(label, size, node, least, n, embedding) with codes and scales for the vector; rows of a batch by their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                own = batch.filter(pa.array(sizes == size))
                codes, scales = two_codes(_matrix(own.column("embedding")))
                made = [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(list(scales), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*(own.column(k) for k in ("label", "size", "node", "least", "n")), *made], names=["label", "size", "node", "least", "n", "codes", "scales"])

    rows = kinds.select("label", "size", "node", "least", "n", "embedding")
    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"label {kind}, size int, node long, least long, n long, codes binary, scales array<double>")


_FOUND = pa.schema([("a", pa.int64()), ("la", pa.int64()), ("b", pa.int64()), ("lb", pa.int64()), ("na", pa.int64()), ("nb", pa.int64()), ("sure", pa.bool_())])


def _tile_pairs(coded: DataFrame, threshold: float, tile: int) -> DataFrame:
    """(a, la, b, lb, na, nb, sure) of all pairs of tiles of a label: link counts (b null), a spanning forest of sure links, doubtful pairs."""
    tiles = coded.groupBy("label", "size").count().select(F.col("label").alias("_l"), F.col("size").alias("_s"), F.ceil(F.col("count") / tile).cast("int").alias("_k"))
    tiles = broadcast_if_small(materialise(tiles, "tiles"), MAX_BROADCAST)
    dealt = coded.join(tiles, (F.col("label") == F.col("_l")) & (F.col("size") == F.col("_s"))).withColumn("_t", F.pmod(F.xxhash64("node"), F.col("_k")).cast("int"))
    dealt = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1))).select("label", "size", F.least("_t", "_o").alias("_i"), F.greatest("_t", "_o").alias("_j"), "_t", "node", "least", "n", "codes", "scales")

    def block(table: pa.Table) -> pa.Table:
        t, node, least, n = (table[k].to_numpy() for k in ("_t", "node", "least", "n"))
        codes = np.frombuffer(b"".join(table["codes"].to_pylist()), np.int8).reshape(len(t), -1)
        scales = _matrix(table["scales"].combine_chunks())
        i_, j_ = table["_i"][0].as_py(), table["_j"][0].as_py()
        rows_a, rows_b = np.nonzero(t == i_)[0], np.nonzero(t == j_)[0]
        links, forest, open_a, open_b = np.zeros(len(t), np.int64), Forest(len(t)), [rows_a[:0]], [rows_a[:0]]
        for at_a in range(0, len(rows_a), STEP):
            for at_b in range(at_a if i_ == j_ else 0, len(rows_b), STEP):
                x, y = rows_a[at_a : at_a + STEP], rows_b[at_b : at_b + STEP]
                (i, j), (p, q) = tile_links((codes[x], scales[x]), (codes[y], scales[y]), threshold, i_ == j_ and at_a == at_b)
                i, j = x[i], y[j]
                np.add.at(links, i, n[j])
                np.add.at(links, j, n[i])
                for k in np.unique(i):
                    forest.link(int(k), j[i == k])
                open_a.append(x[p])
                open_b.append(y[q])
        some = np.nonzero(links)[0]
        tree = np.array(forest.kept, np.int64).reshape(-1, 2)
        left = np.concatenate([some, tree[:, 0], *open_a])
        right = np.concatenate([tree[:, 1], *open_b])
        none = pa.nulls(len(some), pa.int64())
        at = lambda c: pa.concat_arrays([none, pa.array(c[right])])
        na, sure = np.concatenate([links[some], n[left[len(some) :]]]), np.arange(len(left)) < len(some) + len(tree)
        return pa.Table.from_arrays([pa.array(node[left]), pa.array(least[left]), at(node), at(least), pa.array(na), at(n), pa.array(sure)], schema=_FOUND)

    return dealt.groupBy("label", "size", "_i", "_j").applyInArrow(block, "a long, la long, b long, lb long, na long, nb long, sure boolean")


def _decided(doubtful: DataFrame, kinds: DataFrame, threshold: float) -> DataFrame:
    """The doubtful pairs whose cosine in double reaches the threshold; only their vectors are fetched."""
    nodes = materialise(doubtful.select(F.col("a").alias("_node")).union(doubtful.select("b")).distinct(), "doubtful-nodes")
    some = kinds.join(broadcast_if_small(nodes, MAX_BROADCAST), F.col("node") == F.col("_node"), "left_semi").select("node", "embedding")
    some = materialise(some, "doubtful-vectors")
    left, right = (some.select(F.col("node").alias(f"_{k}"), F.col("embedding").alias(f"x{k}")) for k in "ab")
    pairs = doubtful.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b")).select("a", "la", "b", "lb", "na", "nb", "xa", "xb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [c.to_pylist() for c in (batch.column("xa"), batch.column("xb"))]
            near = [cosines(np.array([x], np.float64), np.array([y], np.float64))[0] >= threshold for x, y in zip(*own, strict=True)]
            yield batch.select(["a", "la", "b", "lb", "na", "nb"]).filter(pa.array(near, pa.bool_()))

    return pairs.mapInArrow(run, "a long, la long, b long, lb long, na long, nb long")


def near_vectors(vectors: DataFrame, threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of vectors(vec_id, embedding, label).

    Rows link if their labels are equal and not null and the cosine is at least threshold. Equal vectors of a label
    are first collapsed to one with a count, so groups of copies don't multiply. What is left is quantised once, and
    dealt into tiles of about `tile` rows within each label by a hash; each pair of tiles is one group and one block
    product. Two int8 codes a component, scales and bounds are what moves to the tiles; vectors in full follow only for
    pairs that the bounds leave open, and are compared in double. A group returns link counts and a spanning forest
    of its links, never the pairs. Components are found on Spark; nodes are named by their smallest vec_id, so a
    component's name is its result, without a join by component.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
    different lengths with each other. A repeated vec_id is a vector of its own and shares its component's smallest
    id; null vec_ids count as links but name no component of others. An empty table gives an empty one.
    """
    good = F.col("label").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = stored(vectors).select("vec_id", "embedding", "label").withColumn("_good", F.coalesce(good, F.lit(False)))
    kinds = rows.where("_good").groupBy("label", "embedding").agg(F.coalesce(F.min("vec_id"), F.lit(_LAST)).alias("least"), F.min("vec_id").isNull().alias("no_id"), F.count("*").alias("n"))
    kinds = materialise(kinds.withColumns({"node": F.monotonically_increasing_id(), "size": F.size("embedding")}), "vectors")  # numbered as they are written
    found = materialise(_tile_pairs(materialise(_coded(kinds), "codes"), threshold, tile), "vector-links")
    links = found.where("sure AND b IS NOT NULL").drop("sure")
    counts = found.where("b IS NULL").select("a", "na")
    doubtful = found.where("NOT sure").drop("sure")
    if doubtful.limit(1).count():
        decided = materialise(_decided(doubtful, kinds, threshold), "decided")
        links = links.union(decided)
        counts = counts.union(decided.select("a", "nb")).union(decided.select("b", "na"))
    counts = counts.groupBy("a").agg(F.sum("na").alias("_more"))
    name = lambda least, node: F.struct(F.col(least).alias("least"), F.col(node).alias("node"))
    parts = connected_components(links.select(name("la", "a").alias("a"), name("lb", "b").alias("b"))).select(F.col("node.node").alias("_node"), F.col("component.least").alias("_least"))
    known = kinds.join(parts, F.col("node") == F.col("_node"), "left").join(counts, F.col("node") == F.col("a"), "left")
    component = F.coalesce("_least", "least")
    known = known.select(F.struct("label", "embedding").alias("_key"), (F.col("n") - 1 + F.coalesce("_more", F.lit(0))).alias("n_links"), F.when(~F.col("no_id") | (component != _LAST), component).alias("_component"))
    out = rows.withColumn("_key2", F.when(F.col("_good"), F.struct("label", "embedding"))).join(known, F.col("_key2") == F.col("_key"), "left")
    component = F.coalesce("_component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op10(vectors: DataFrame) -> DataFrame:
    return near_vectors(vectors)
