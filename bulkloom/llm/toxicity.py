"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, distance-weighted votes, calibrated."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, prepare, shield
from .terms import texts_of, word_lists

#: Labelled documents that the index holds, chosen by a hash of their id; about so many, whatever the table's size.
MAX_EXAMPLES = 8192
#: Terms of the index, those that part the labels best.
MAX_TERMS = 1024
#: A term must be in so many toxic examples, and its G statistic against the label must reach this.
LEAST_TOXIC, LEAST_G = 3, 20.0
#: Bytes of the pieces of a word, its ends marked.
PIECES = (5, 6, 7)
#: A piece that occurs so often is a term of its own, beside the one for its first time.
LEVELS = (1, 2, 4, 8)
#: Examples in a block of the index, neighbours that vote, and the score from which a document counts as toxic.
BLOCK, NEIGHBOURS, THRESHOLD = 64, 9, 0.3
#: Entries that a task's memories hold, of words and of answers.
MEMORY = 50_000


def pieces(word: bytes) -> list[bytes]:
    """The word with both ends marked, and its stretches of PIECES bytes, as often as they occur."""
    w = b"^" + word + b"$"
    return [w[i : i + n] for n in PIECES for i in range(len(w) - n + 1)] + ([w] if len(w) not in PIECES else [])


def word_counts(text: bytes | None) -> Counter:
    out: Counter = Counter()
    for part in word_lists(text):
        out.update(part)
    return out


class Finder:
    """Counts known pieces in a text in one run of an automaton over its marked words."""

    def __init__(self, known: list[bytes]):
        self.automaton = ahocorasick.Automaton()
        for piece in known:
            self.automaton.add_word(piece.decode("latin-1"), piece)
        self.automaton.make_automaton()
        self.empty = not known

    def __call__(self, text: bytes | None) -> Counter:
        out: Counter = Counter()
        for part in word_lists(text):
            if part and not self.empty:
                out.update(piece for _, piece in self.automaton.iter((b"^" + b"$^".join(part) + b"$").decode("latin-1")))
        return out


def learns_from(doc_id: Column) -> Column:
    """Rows whose labels may be learned from: crc32 of the id as text, modulo 4, is not 2. A null id is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def examples(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES) -> DataFrame:
    """(doc_id, text, label) of about `most` labelled documents; an id with several labels has the largest, one with several texts that of the least hash."""
    known = labels.where(F.col("toxic").isNotNull() & learns_from(F.col("doc_id"))).groupBy(F.col("doc_id").alias("_of")).agg(F.max("toxic").cast("int").alias("label"))
    known = materialise(known, "toxic-labels")
    n = known.count()
    if n > most:
        known = materialise(known.where(F.pmod(F.xxhash64(F.lit(13), "_of"), F.lit(n)) < most), "toxic-sample")
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_of"))  # about `most` rows
    best = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t"), F.max("label").alias("label"))
    return materialise(best.select("doc_id", F.col("t.text").alias("text"), "label"), "toxic-examples")


def term_counts(known: DataFrame) -> DataFrame:
    """(piece, level, clean, toxic): examples of each label in which a piece occurs at least `level` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = lru_cache(MEMORY)(pieces)
        n: dict[tuple[bytes, int], list[int]] = {}

        def flush() -> pa.RecordBatch:
            keys, counts = list(n), list(n.values())
            n.clear()
            columns = [pa.array([k[0] for k in keys], pa.binary()), pa.array([k[1] for k in keys], pa.int32()), pa.array([c[0] for c in counts], pa.int64()), pa.array([c[1] for c in counts], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["piece", "level", "clean", "toxic"])

        for batch in batches:
            for text, label in zip(texts_of(batch), batch.column(batch.schema.get_field_index("label")).to_pylist(), strict=True):
                tf: Counter = Counter()
                for w, k in word_counts(text).items():
                    for p in cut(w):
                        tf[p] += k
                for p, k in tf.items():
                    for level in LEVELS:
                        if k >= level:
                            n.setdefault((p, level), [0, 0])[label == 1] += 1
                if len(n) > 10 * MEMORY:
                    yield flush()
        yield flush()

    return known.select("text", "label").mapInArrow(run, "piece binary, level int, clean long, toxic long").groupBy("piece", "level").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def choose_terms(known: DataFrame) -> list[tuple[bytes, int]]:
    """The (piece, level) that part the labels best, at most MAX_TERMS, more frequent among toxic examples than among clean ones."""
    clean, toxic = known.agg(F.count_if(F.col("label") != 1), F.count_if(F.col("label") == 1)).first()
    if not clean or not toxic:
        return []
    x, y, both = F.col("toxic"), F.col("clean"), F.col("toxic") + F.col("clean")
    part = lambda seen, of, n: F.when(seen > 0, seen * F.ln(seen / (of * n / (clean + toxic)))).otherwise(0.0)
    rest = F.lit(clean + toxic) - both
    g = 2 * (part(x, both, toxic) + part(y, both, clean) + part(toxic - x, rest, toxic) + part(clean - y, rest, clean))
    rows = term_counts(known).where((x >= LEAST_TOXIC) & (x * clean > y * toxic)).withColumn("g", g).where(F.col("g") >= LEAST_G)
    return [(bytes(r["piece"]), r["level"]) for r in rows.orderBy(F.col("g").desc(), "piece", "level").limit(MAX_TERMS).collect()]


def bags(docs: DataFrame, terms: list[tuple[bytes, int]], keep_text: bool = True) -> DataFrame:
    """docs with bag: the numbers of the terms that a text has, in order, as 32-bit words."""
    fields = [f for f in docs.schema.fields if keep_text or f.name != "text"]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels: dict[bytes, list[tuple[int, int]]] = {}
        for k, (piece, level) in enumerate(terms):
            levels.setdefault(piece, []).append((level, k))
        find = Finder(list(levels))
        for batch in batches:
            out = []
            for text in texts_of(batch):
                tf = find(text)
                out.append(np.array(sorted(t for p, k in tf.items() for level, t in levels[p] if k >= level), "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(k)) for k in names), pa.array(out, pa.binary())], names=[*names, "bag"])

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField("bag", T.BinaryType())]))


def inverse_frequencies(bagged: DataFrame, terms: int) -> np.ndarray:
    """ln((documents + 1) / (documents with the term + 1)) + 1 over all rows; a task sends a row per term at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(terms + 1, np.int64)
        for batch in batches:
            n += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=terms + 1)
            n[terms] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(terms + 1)), pa.array(n)], names=["term", "n"])

    n = np.zeros(terms + 1)
    for r in bagged.select("bag").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():  # MAX_TERMS + 1 rows at most
        n[r["term"]] = r["n"]
    return np.log((n[terms] + 1) / (n[:terms] + 1)) + 1


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... of each range, one after another."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Index:
    """Examples under their terms. Postings of a term come in blocks of BLOCK examples, and each has the greatest weight in it."""

    def __init__(self, rows: list[tuple[int, int, np.ndarray]], idf: np.ndarray):
        self.idf = idf
        # like examples stand together: by their rarest terms, so that the bounds of a block are tight
        rows = sorted((r for r in rows if r[2].size), key=lambda r: (tuple(sorted(r[2].tolist(), key=lambda t: (-idf[t], t))), r[0]))
        self.id, self.label = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
        self.number = {i: k for k, i in enumerate(self.id.tolist())}
        self.blocks = -(-len(rows) // BLOCK)
        sizes = [r[2].size for r in rows]
        term = np.concatenate([r[2] for r in rows]) if rows else np.zeros(0, np.int64)
        example = np.repeat(np.arange(len(rows)), sizes)
        weight = np.concatenate([self.weights(r[2]) for r in rows]) if rows else np.zeros(0)
        order = np.lexsort((example, term))
        term, self.example, self.weight = term[order], example[order], weight[order]
        cell = term.astype(np.int64) * max(self.blocks, 1) + self.example // BLOCK
        self.start = np.flatnonzero(np.diff(cell, prepend=-1))  # where a term's block begins among the postings
        self.length = np.diff(self.start, append=cell.size)
        self.block = self.example[self.start] // BLOCK
        self.most = np.maximum.reduceat(self.weight, self.start) if cell.size else self.weight
        self.first = np.searchsorted(term[self.start], np.arange(idf.size + 1))

    def weights(self, terms: np.ndarray) -> np.ndarray:
        return self.idf[terms] / np.sqrt((self.idf[terms] ** 2).sum())

    def nearest(self, terms: np.ndarray, k: int, leave_out: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(cosines, examples) of the k nearest that share a term, nearest first, equal ones by their number.

        Blocks are read in order of the greatest cosine that they can hold, until none left can reach the k found.
        """
        if not terms.size or not self.blocks:
            return np.zeros(0), np.zeros(0, np.int64)
        count = self.first[terms + 1] - self.first[terms]
        entry, q = _ranges(self.first[terms], count), np.repeat(self.weights(terms), count)
        bound = np.bincount(self.block[entry], q * self.most[entry], self.blocks)
        order = np.argsort(-bound, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(order.size)
        at = rank[self.block[entry]]
        by_rank = np.argsort(at, kind="stable")
        entry, q, at = entry[by_rank], q[by_rank], at[by_rank]
        near, who = np.zeros(0), np.zeros(0, np.int64)
        done, step, live = 0, 2, int((bound > 0).sum())
        while done < live and not (near.size == k and near[-1] > bound[order[done]] + 1e-9):
            upto = min(done + step, live)
            lo, hi = np.searchsorted(at, [done, upto])
            n = self.length[entry[lo:hi]]
            posting = _ranges(self.start[entry[lo:hi]], n)
            cell = np.repeat(at[lo:hi] - done, n) * BLOCK + self.example[posting] % BLOCK
            score = np.bincount(cell, np.repeat(q[lo:hi], n) * self.weight[posting], (upto - done) * BLOCK)
            hit = np.flatnonzero(score)
            example = order[done + hit // BLOCK] * BLOCK + hit % BLOCK
            near, who = np.concatenate([near, score[hit]]), np.concatenate([who, example])
            keep = who != leave_out
            near, who = near[keep], who[keep]
            best = np.lexsort((who, -near))[:k]
            near, who = near[best], who[best]
            done, step = upto, step * 2
        return near, who

    def vote(self, near: np.ndarray, who: np.ndarray) -> float:
        """The share of label 1 among the neighbours, nearer ones counting more; -1 without neighbours."""
        if not who.size:
            return -1.0
        w = 1 / (1.02 - np.minimum(near, 1))
        return float((w * (self.label[who] == 1)).sum() / w.sum())


class Calibration:
    """A rising step function from votes to shares of label 1, by pooling neighbours that fall; each pool leans on the overall share as by one example."""

    def __init__(self, votes: list[float], labels: list[int]):
        overall = sum(labels) / len(labels) if labels else 0.0
        pools: list[list[float]] = []
        by_vote: dict[float, list[int]] = {}
        for v, y in zip(votes, labels, strict=True):
            by_vote.setdefault(v, []).append(y)
        for v in sorted(by_vote):
            pools.append([v, sum(by_vote[v]), len(by_vote[v])])
            while len(pools) > 1 and (pools[-2][1] + overall) / (pools[-2][2] + 1) >= (pools[-1][1] + overall) / (pools[-1][2] + 1):
                _, y, n = pools.pop()
                pools[-1][1] += y
                pools[-1][2] += n
        self.at = np.array([p[0] for p in pools])
        self.share = np.array([(y + overall) / (n + 1) for _, y, n in pools])
        self.overall = overall

    def __call__(self, vote: float) -> float:
        k = int(np.searchsorted(self.at, vote, "right")) - 1
        return float(self.share[k]) if k >= 0 else self.overall


def _bag(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i4").astype(np.int64)


def train(docs: DataFrame, labels: DataFrame, bagged: DataFrame, terms: list[tuple[bytes, int]], known: DataFrame) -> tuple[Index, Calibration]:
    """The index over the examples, with frequencies of all documents, and votes against labels, each example judged by the others."""
    idf = inverse_frequencies(bagged, len(terms))
    table = bags(known, terms, keep_text=False)
    rows = [(r["doc_id"], r["label"], _bag(r["bag"])) for r in table.collect()]  # about MAX_EXAMPLES
    index = Index(rows, idf)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = [shared.value.vote(*shared.value.nearest(_bag(b), NEIGHBOURS, shared.value.number.get(i, -1))) for i, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), batch.column(1)], names=["vote", "label"])

    judged = table.mapInArrow(judge, "vote double, label int").collect()  # about MAX_EXAMPLES
    return index, Calibration([r["vote"] for r in judged], [int(r["label"] == 1) for r in judged])


EVIDENCE = T.ArrayType(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("similarity", T.DoubleType())]))


def score_toxicity(docs: DataFrame, labels: DataFrame, keep_text: bool = True) -> DataFrame:
    """docs with score (0 to 1), predicted (1 from THRESHOLD on) and evidence: the nearest labelled examples, with their labels and cosines.

    About MAX_EXAMPLES labelled documents, chosen by a hash of their id, teach: pieces of words, and pieces that repeat,
    which part the labels best are the terms (MAX_TERMS at most); a text's vector holds its terms by inverse frequency over all
    documents. The NEIGHBOURS nearest examples by cosine, found exactly, vote by nearness; votes are calibrated on the
    examples, each judged by the others. All documents are scored over their whole texts; nothing is shuffled but counts.

    Null and empty texts, and those without a term, have no neighbour and get the share of label 1 among such examples;
    equal texts get equal scores. Null labels teach nothing; without examples of both labels all score the overall share,
    0 without any. An empty table gives an empty one. Columns of docs with the added names are replaced, others stay.
    """
    prepare(docs.sparkSession)
    inner, restore = shield(docs, ["doc_id", "text"])
    known = examples(inner, labels)
    terms = choose_terms(known)
    bagged = materialise(bags(inner, terms, keep_text), "toxic-bags")
    index, share = train(inner, labels, bagged, terms, known)
    shared = docs.sparkSession.sparkContext.broadcast((index, share))
    names = [c for c in bagged.columns if c != "bag"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, share = shared.value

        @lru_cache(MEMORY // 5)
        def answer(bag: bytes):
            near, who = index.nearest(_bag(bag), NEIGHBOURS)
            found = [{"doc_id": int(index.id[w]), "label": int(index.label[w]), "similarity": float(c)} for c, w in zip(near, who, strict=True)]
            return share(index.vote(near, who)), found

        for batch in batches:
            got = [answer(b) for b in batch.column(batch.schema.get_field_index("bag")).to_pylist()]
            kept = [batch.column(batch.schema.get_field_index(k)) for k in names]
            score = [g[0] for g in got]
            evidence = pa.array([g[1] for g in got], pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("similarity", pa.float64())])))
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score, pa.float64()), pa.array([int(s >= THRESHOLD) for s in score], pa.int32()), evidence], names=[*names, "score", "predicted", "evidence"])

    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("evidence", EVIDENCE)]
    out = bagged.mapInArrow(run, T.StructType([*(bagged.schema[c] for c in names), *added]))
    return restore(out, ["score", "predicted", "evidence"]) if keep_text else out


def op13(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The evidence as doc_id:label:cosine, nearest first. A null id is not held out."""
    out = score_toxicity(docs.select("doc_id", "text"), labels, keep_text=False)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    shown = F.array_join(F.transform("evidence", lambda e: F.format_string("%d:%d:%.6f", e["doc_id"], e["label"], e["similarity"])), ",")
    return out.select("doc_id", held.alias("held_out"), "score", "predicted", shown.alias("evidence"))
