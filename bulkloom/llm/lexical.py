"""Ranked lexical search: documents as bags of the items' terms, equal bags scored once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, prepare
from .terms import texts_of, word_lists

#: (item, term) pairs that go to every task at once; items beyond it are searched in further passes.
BLOCK_PAIRS = 500_000
#: Cells of a score matrix, and postings added up, at once.
CELLS = 1 << 21
#: What stands for a null doc_id while ids are compared; it comes last.
_NO_ID = np.iinfo(np.int64).max


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms) of items(item_id, text): the distinct terms of each row, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted({w for part in word_lists(t) for w in part}) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("item_id")), pa.array(terms, pa.list_(pa.binary()))], names=["item_id", "terms"])

    rows = items.select("item_id", "text")
    return rows.mapInArrow(run, f"item_id {rows.schema['item_id'].dataType.simpleString()}, terms array<binary>")


class Block:
    """The items of one pass: their vocabulary, and for each term the items that have it."""

    def __init__(self, rows: list):
        self.ids = [r["item_id"] for r in rows]
        self.terms = sorted({bytes(t) for r in rows for t in r["terms"]})
        number = {t: k for k, t in enumerate(self.terms)}
        pairs = sorted((number[bytes(t)], i) for i, r in enumerate(rows) for t in r["terms"])
        self.items = np.array([i for _, i in pairs], np.int64)
        self.first = np.searchsorted(np.array([t for t, _ in pairs]), np.arange(len(self.terms) + 1))


def bags(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, bag) of docs with a term: n counts all terms, bag has (term number, occurrences) of those in the vocabulary, in order, as 32-bit words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: k for k, t in enumerate(shared.value)}.get
        for batch in batches:
            n, bag = [], []
            for text in texts_of(batch):
                tf: Counter = Counter()
                total = 0
                for part in word_lists(text):
                    total += len(part)
                    tf.update(map(number, part))
                del tf[None]
                n.append(total)
                bag.append(np.array(sorted(tf.items()), "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(n, pa.int64()), pa.array(bag, pa.binary())], names=["doc_id", "n", "bag"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, bag binary").where("n > 0")


def document_frequencies(bagged: DataFrame, terms: int) -> np.ndarray:
    """How many bags hold each term; a task sends a row per term at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(terms, np.int64)
        for batch in batches:
            n += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4")[::2], minlength=terms)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["term", "n"])

    out = np.zeros(terms, np.int64)
    for r in bagged.select("bag").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():  # a row per term of the block
        out[r["term"]] = r["n"]
    return out


def classes(bagged: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(bag, m, members): documents of equal bag and length class m; members are the k smallest doc_ids, in order.

    Rows meet by a hash of bag and m, and are told apart by bag and m themselves. Only the k smallest ids can be wanted, so
    each task passes on k rows of a class at most, however many copies there are.
    """
    m = F.lit(50) + F.expr(f"(50 * n * {n_docs}L) div {n_terms}L")
    rows = bagged.where(F.length("bag") > 0).select(F.coalesce("doc_id", F.lit(int(_NO_ID))).alias("doc_id"), "bag", m.alias("m"))
    key = ["hash", "m", "bag"]
    rows = rows.withColumn("hash", F.xxhash64("bag", "m")).withColumn("_nth", F.row_number().over(W.partitionBy(*key).orderBy("doc_id"))).where(F.col("_nth") <= k)
    return rows.groupBy(*key).agg(F.sort_array(F.collect_list("doc_id")).alias("members")).select("bag", "m", "members")


class Best:
    """The k best (score, doc_id) of each item: highest score first, then smallest id."""

    def __init__(self, items: int, k: int):
        self.k, self.score, self.doc = k, np.zeros((items, k), np.int64), np.full((items, k), _NO_ID)

    def offer(self, item: int, score: np.ndarray, members: list) -> None:
        """Classes with their scores for an item; a class that can't reach the k best is not expanded."""
        at = np.flatnonzero(score >= max(1, self.score[item, -1]))
        if at.size > self.k:
            at = at[score[at] >= np.partition(score[at], at.size - self.k)[at.size - self.k]]
        if not at.size:
            return
        docs = np.concatenate([members[c] for c in at])
        scores = np.repeat(score[at], [len(members[c]) for c in at])
        docs, scores = np.concatenate([self.doc[item], docs]), np.concatenate([self.score[item], scores])
        order = np.lexsort((docs, -scores))[: self.k]
        self.doc[item], self.score[item] = docs[order], scores[order]


def score_batch(bag: list[bytes], m: np.ndarray, weight: np.ndarray, block: Block) -> Iterator[tuple[int, np.ndarray]]:
    """(first class, scores of some classes for all items), in whole numbers below 2**53, which doubles add exactly."""
    items, sizes = len(block.ids), np.array([len(b) // 8 for b in bag])
    term, tf = np.frombuffer(b"".join(bag), "<i4").astype(np.int64).reshape(-1, 2).T
    of = np.repeat(np.arange(len(bag)), sizes)
    impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[of]))
    fan = block.first[term + 1] - block.first[term]
    work = np.cumsum(np.bincount(of, fan, len(bag)) + items)
    ends = np.cumsum(sizes)
    a = 0
    while a < len(bag):  # as many classes as fit, one at least
        b = max(a + 1, int(np.searchsorted(work, (work[a - 1] if a else 0) + CELLS, "right")))
        lo, hi = ends[a] - sizes[a], ends[b - 1]
        n = fan[lo:hi]
        posting = np.repeat(block.first[term[lo:hi]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        cell = np.repeat(of[lo:hi] - a, n) * items + block.items[posting]
        yield a, np.bincount(cell, np.repeat(impact[lo:hi], n), (b - a) * items).astype(np.int64).reshape(b - a, items)
        a = b


def _search_block(docs: DataFrame, block: Block, k: int, item_type: str) -> DataFrame:
    spark = docs.sparkSession
    bagged = materialise(bags(docs, block.terms), "bags")
    n_docs, n_terms = bagged.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_frequencies(bagged, len(block.terms))
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1).astype(np.float64))).astype(np.int64)
    shared = spark.sparkContext.broadcast((block, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = shared.value
        best = Best(len(block.ids), k)
        for batch in batches:
            members = [np.array(x, np.int64) for x in batch.column(2).to_pylist()]
            for a, scores in score_batch(batch.column(0).to_pylist(), batch.column(1).to_numpy(), weight, block):
                part = members[a : a + len(scores)]
                for item in np.flatnonzero((scores >= np.maximum(1, best.score[:, -1])).any(axis=0)):
                    best.offer(item, scores[:, item], part)
        item, _ = at = np.nonzero(best.score)
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(best.doc[at]), pa.array(best.score[at])], names=["item", "doc_id", "score"])

    found = classes(bagged, n_docs, max(n_terms, 1), k).mapInArrow(run, "item long, doc_id long, score long")
    order = [F.col("score").desc(), "doc_id"]
    # the best of some tasks first, so that an item's last sort has few rows
    found = found.withColumn("_some", F.spark_partition_id() % 64).withColumn("_nth", F.row_number().over(W.partitionBy("item", "_some").orderBy(*order))).where(F.col("_nth") <= k)
    found = found.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    names = F.broadcast(spark.createDataFrame(list(enumerate(block.ids)), f"_item long, item_id {item_type}"))  # the items of a block
    return found.join(names, F.col("item") == F.col("_item")).select("item_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("doc_id") != int(_NO_ID), F.col("doc_id")).alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best docs(doc_id, text) for each row of items(item_id, text), best first, equal scores by doc_id.

    Terms weigh by how rare they are; a document's score adds weight and saturated frequency of each term that it shares
    with the item, damped by its length in steps. Documents are cut down to bags of the items' terms, equal bags of
    equal length class are scored once, and the members of classes that reach the best are expanded by doc_id.

    Items go to the tasks in blocks of about BLOCK_PAIRS (item, term) pairs; each block is a pass over all documents.
    A row of items is an item of its own, also where ids repeat or are null. Null and empty texts have no terms: such
    documents don't count, such items find nothing. A null doc_id comes last of equal scores; rows that repeat are
    documents of their own. Texts of any length are read whole. Extra columns are not read.
    """
    spark = prepare(docs.sparkSession)
    parsed = item_terms(items)
    kind = parsed.schema["item_id"].dataType.simpleString()
    table = materialise(parsed.withColumn("_no", F.monotonically_increasing_id()), "items")
    pairs = table.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = -(-pairs // BLOCK_PAIRS)
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for b in range(blocks):
        rows = table.where((F.size("terms") > 0) & (F.pmod(F.xxhash64("_no"), F.lit(blocks)) == b)).orderBy("_no").collect()  # bounded by BLOCK_PAIRS
        if rows:
            out = _search_block(docs, Block(rows), k, kind) if blocks == 1 else out.unionByName(_search_block(docs, Block(rows), k, kind))
    return out


def op12(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)
