"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import broadcast_if_small, materialise, prepare, row_ordinal, shield, stored

#: Labelled documents of each language that the network is fitted on, at most, and stretches of each: a bounded sample, on the driver.
SAMPLE_DOCS, SAMPLE_STRETCHES = 400, 6
#: Groups of tasks that choose before all do.
FANS = 64
#: Cells of each direction, bytes of a training stretch, passes of training, stretches in each.
HIDDEN, LENGTH, STEPS, BATCH = 12, 48, 200, 384
#: Bytes that a stretch labels at most, the steps in which it is fitted to a text, and bytes of context that it reads on either side.
STRETCH, FIT, CONTEXT = 320, 32, 16
#: Numbers that a block of stretches may hold per array, about.
BLOCK = 4_000_000
#: Chosen documents are broadcast up to so many.
MAX_BROADCAST = 1_000_000
#: Share of the held-out documents labelled right that may lie below the end that the pipeline's rejection score is taken from.
LOW_SHARE = 0.001
#: The model to give where training found nothing to learn from; None asks for training.
NOTHING = "nothing learned"


def _gate(x: np.ndarray) -> np.ndarray:
    """The hard sigmoid, as gates are used in many places: it costs a tenth of the smooth one."""
    return np.clip(0.25 * x + 0.5, 0, 1)


class ByteGru:
    """Two GRUs, one in each direction, over bytes; a softmax labels every byte. Bytes are 0 to 255, 256 stands for what lies beyond a text's ends."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) * (0.5 / np.sqrt(shape[0]) if len(shape) > 1 else 0)).astype(np.float32)
        self.languages, self.hidden = languages, hidden
        self.p = {"out": draw(2 * hidden, len(languages)), "out_b": np.zeros(len(languages), np.float32)}
        for d in "fb":
            self.p |= {f"in_{d}": (rng.standard_normal((257, 3 * hidden)) * 0.3).astype(np.float32), f"u_{d}": draw(hidden, 3 * hidden), f"b_{d}": np.zeros(3 * hidden, np.float32)}

    def _run(self, x: np.ndarray, d: str, keep: bool):
        """States after each byte of x (bytes x stretches), read in the order given; keep: also what backpropagation needs."""
        (length, n), h_ = x.shape, self.hidden
        table, u = self.p[f"in_{d}"] + self.p[f"b_{d}"], self.p[f"u_{d}"]
        h = np.zeros((n, h_), u.dtype)
        states, tape = np.empty((length, n, h_), u.dtype), []
        for t in range(length):
            a, g = table[x[t]], h @ u
            zr = a[:, : 2 * h_]
            zr += g[:, : 2 * h_]
            zr = _gate(zr)
            z, r, gn = zr[:, :h_], zr[:, h_:], g[:, 2 * h_ :]
            c = np.tanh(a[:, 2 * h_ :] + r * gn)
            if keep:
                tape.append((h, z, r, gn, c))
            h = c + z * (h - c)
            states[t] = h
        return states, tape

    def _states(self, x: np.ndarray, d: str) -> np.ndarray:
        """States after each byte of x (bytes x stretches), read in the order given, without what training needs: (bytes, hidden, stretches).

        Cells come before stretches, so that gates are whole blocks of memory; the slope and middle of the gates are in the weights.
        """
        (length, n), h_ = x.shape, self.hidden
        slope, middle = (np.repeat(np.array(x, np.float32), [2 * h_, h_]) for x in ([0.25, 1.0], [0.5, 0.0]))
        table = np.ascontiguousarray(((self.p[f"in_{d}"] + self.p[f"b_{d}"]) * slope + middle).T, np.float32)
        u = np.ascontiguousarray((self.p[f"u_{d}"] * slope).T, np.float32)
        h, a, g = np.zeros((h_, n), np.float32), np.empty((3 * h_, n), np.float32), np.empty((3 * h_, n), np.float32)
        states = np.empty((length, h_, n), np.float32)
        zr, z, r, c = a[: 2 * h_], a[:h_], a[h_ : 2 * h_], a[2 * h_ :]
        for t in range(length):
            np.take(table, x[t], axis=1, out=a, mode="clip")
            np.dot(u, h, out=g)
            zr += g[: 2 * h_]
            np.clip(zr, 0, 1, out=zr)
            r *= g[2 * h_ :]
            c += r
            np.tanh(c, out=c)
            h = states[t]
            np.subtract(states[t - 1] if t else 0, c, out=h)
            h *= z
            h += c
        return states

    def _probabilities(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        """Of the languages, from both states at each byte in the text's order: (bytes, languages, stretches)."""
        out = np.ascontiguousarray(self.p["out"].T, np.float32)
        score = np.matmul(out[:, : self.hidden], forward)
        score += np.matmul(out[:, self.hidden :], backward)
        score += self.p["out_b"].astype(np.float32)[:, None]
        score -= score.max(axis=1, keepdims=True)
        np.exp(score, out=score)
        score /= score.sum(axis=1, keepdims=True)
        return score

    def label(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the languages at every byte: (bytes, languages, stretches)."""
        return self._probabilities(self._states(x, "f"), self._states(x[::-1], "b")[::-1])

    def pooled(self, x: np.ndarray, counted: np.ndarray) -> np.ndarray:
        """Sums over the bytes of each stretch that count of their probabilities: (stretches, languages)."""
        forward, backward = self._states(x, "f"), self._states(x[::-1], "b")[::-1]
        total = np.zeros((len(self.languages), x.shape[1]))
        step = max(1, BLOCK // (x.shape[1] * len(self.languages)))
        for t in range(0, len(x), step):
            part = slice(t, t + step)
            total += (self._probabilities(forward[part], backward[part]) * counted[part, None, :]).sum(axis=0)
        return total.T

    def _softmax(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        """Both states at each byte, in the text's order, to probabilities."""
        h_ = self.hidden
        score = forward @ self.p["out"][:h_]
        score += backward @ self.p["out"][h_:]
        score += self.p["out_b"]
        score -= score.max(axis=2, keepdims=True)
        np.exp(score, out=score)
        score /= score.sum(axis=2, keepdims=True)
        return score

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all bytes of x (bytes x stretches), with y the language of each stretch, and its gradients."""
        h_, (length, n) = self.hidden, x.shape
        xs = {"f": x, "b": x[::-1]}
        states, tape = {}, {}
        for d in "fb":
            states[d], tape[d] = self._run(xs[d], d, True)
        backward = states["b"][::-1]
        prob = self._softmax(states["f"], backward)
        loss = float(-np.log(prob[:, np.arange(n), y] + 1e-9).mean())
        err = prob
        err[:, np.arange(n), y] -= 1
        err /= n * length
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        both = np.concatenate([states["f"], backward], axis=2)
        grad["out"] = both.reshape(-1, 2 * h_).T @ err.reshape(-1, err.shape[2])
        grad["out_b"] = err.sum(axis=(0, 1))
        back = err @ self.p["out"].T
        into = {"f": back[:, :, :h_], "b": back[::-1, :, h_:]}
        for d in "fb":
            u, dh = self.p[f"u_{d}"], np.zeros((n, h_), back.dtype)
            das, d_u = np.empty((length, n, 3 * h_), back.dtype), grad[f"u_{d}"]
            for t in range(length - 1, -1, -1):
                h, z, r, gn, c = tape[d][t]
                dh = dh + into[d][t]
                dc = dh * (1 - z) * (1 - c * c)
                dz = dh * (h - c) * (0.25 * ((z > 0) & (z < 1)))
                dr = dc * gn * (0.25 * ((r > 0) & (r < 1)))
                das[t] = np.concatenate([dz, dr, dc], axis=1)
                dg = np.concatenate([dz, dr, dc * r], axis=1)
                d_u += h.T @ dg
                dh = dh * z + dg @ u.T
            grad[f"in_{d}"] += _sums_by(xs[d].ravel(), das.reshape(-1, 3 * h_), len(grad[f"in_{d}"]))
            grad[f"b_{d}"] += das.sum(axis=(0, 1))
        return loss, grad

    def fit(self, stretches: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = 0.02, seed: int = 2) -> float:
        """Adam on random batches of stretches (n x bytes), each language as often as any other; returns the last mean loss."""
        rng = np.random.default_rng(seed)
        of = [np.nonzero(labels == k)[0] for k in range(len(self.languages))]
        of = [rows for rows in of if len(rows)]
        m, v = ({k: np.zeros_like(p) for k, p in self.p.items()} for _ in range(2))
        losses = []
        for step in range(1, steps + 1):
            which = rng.integers(0, len(of), batch)
            rows = np.array([of[k][j] for k, j in zip(which, (rng.random(batch) * [len(of[k]) for k in which]).astype(int), strict=True)])
            loss, grad = self.gradients(np.ascontiguousarray(stretches[rows].T), labels[rows])
            losses.append(loss)
            now = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
            for name, g in grad.items():
                m[name] = 0.9 * m[name] + 0.1 * g
                v[name] = 0.999 * v[name] + 0.001 * g * g
                self.p[name] = (self.p[name] - now * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
        return float(np.mean(losses[-30:]))


def _sums_by(keys: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by key, 0 to n - 1."""
    order = np.argsort(keys, kind="stable")
    sorted_ = keys[order]
    first = np.nonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))[0]
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    out[sorted_[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


END = 256


def stretches_of(text: bytes, stretch: int = STRETCH, context: int = CONTEXT) -> tuple[np.ndarray, np.ndarray]:
    """(stretches, counted): the whole text in stretches that overlap by their context; each byte counts in one of them."""
    n = max(1, -(-len(text) // stretch))
    padded = np.full(n * stretch + 2 * context, END, np.int16)
    padded[context : context + len(text)] = np.frombuffer(text, np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(padded, stretch + 2 * context)[::stretch]
    inside = np.zeros(len(padded), np.float32)
    inside[context : context + len(text)] = 1
    counted = np.lib.stride_tricks.sliding_window_view(inside, stretch + 2 * context)[::stretch].copy()
    counted[:, :context] = 0
    counted[:, context + stretch :] = 0
    return rows, counted


def document_scores(model: ByteGru, texts: list[str]) -> np.ndarray:
    """Mean probabilities over all bytes of each text, white space included; a text without bytes gets zeros.

    A text is cut into equal stretches, so that little is spent on what lies beyond its end. Stretches of
    many texts go through the network together, in blocks of bounded size.
    """
    raw = [t.encode("utf-8", "replace") for t in texts]
    out = np.zeros((len(texts), len(model.languages)))
    width = np.array([-(-len(r) // (max(1, -(-len(r) // STRETCH)) * FIT)) * FIT for r in raw])
    for w in np.unique(width):
        own = np.nonzero(width == w)[0] if w else []
        rows_at_once = max(64, BLOCK // ((w + 2 * CONTEXT) * 2 * model.hidden))
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush(held=held) -> None:
            x, counted, of = (np.concatenate(c) for c in zip(*held, strict=True))
            for k in range(0, len(x), rows_at_once):
                part = slice(k, k + rows_at_once)
                np.add.at(out, of[part], model.pooled(np.ascontiguousarray(x[part].T), np.ascontiguousarray(counted[part].T)))
            held.clear()

        for i in own:
            rows, counted = stretches_of(raw[i], w)
            held.append((rows, counted, np.full(len(rows), i)))
            size += len(rows)
            if size >= rows_at_once:
                flush()
                size = 0
        if held:
            flush()
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-300)


def held_out(doc_id: Column) -> Column:
    """True for documents that training never sees; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, steps: int = STEPS) -> ByteGru | None:
    """A network fitted on at most sample_docs documents of each language, those with the least hashes, that aren't held out.

    The choice ranks ids by a hash within each language. Spark keeps the first of each task before it shuffles, and
    FANS groups of tasks rank theirs before all do, so no task reads many rows however many tasks there are. Of each chosen document SAMPLE_STRETCHES
    stretches at random places, cut in the tasks, reach the driver. Without a labelled document there is no network.
    """
    own = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & (F.length("text") > 0))
    order = F.xxhash64(F.lit("sample"), "doc_id")
    first = lambda rows, *by: rows.withColumn("_rank", F.row_number().over(W.partitionBy(*by).orderBy(order, "doc_id"))).where(F.col("_rank") <= sample_docs)
    ranked = first(first(own.select("doc_id", "lang", (F.spark_partition_id() % FANS).alias("_fan")), "lang", "_fan"), "lang")
    chosen = materialise(ranked.select(F.col("doc_id").alias("_chosen"), F.col("lang").alias("_lang")).distinct(), "lang-sample")
    few = own.join(broadcast_if_small(chosen, MAX_BROADCAST), (F.col("doc_id") == F.col("_chosen")) & (F.col("lang") == F.col("_lang"))).select("lang", "text", order.alias("seed"))
    # a doc_id that many rows repeat brings them all: of each language no more than the bound's own rows are taken
    few = few.withColumn("_rank", F.row_number().over(W.partitionBy("lang").orderBy("seed", F.xxhash64("text")))).where(F.col("_rank") <= sample_docs).select("lang", "text", "seed")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, parts = [], []
            for lang, text, seed in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                raw = text.encode("utf-8", "replace")
                for at in np.random.default_rng(seed & (2**63 - 1)).integers(0, max(1, len(raw) - LENGTH + 1), min(SAMPLE_STRETCHES, max(1, len(raw) // LENGTH))):
                    langs.append(lang)
                    parts.append(raw[at : at + LENGTH])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(parts, pa.binary())], names=["lang", "part"])

    got = sorted((r["lang"], bytes(r["part"])) for r in few.mapInArrow(cut, "lang string, part binary").collect())
    if not got:
        return None
    languages = sorted({lang for lang, _ in got})
    x = np.full((len(got), LENGTH), END, np.int16)
    for row, (_, part) in zip(x, got, strict=True):
        row[: len(part)] = np.frombuffer(part, np.uint8)
    model = ByteGru(languages)
    place = {lang: k for k, lang in enumerate(languages)}
    model.fit(x, np.array([place[lang] for lang, _ in got]), steps)
    return model


def identify(docs: DataFrame, model: ByteGru | str | None = None, keep_text: bool = True) -> DataFrame:
    """docs with held_out, lang_pred and score; one row for each row; without a model, one is trained on docs; NOTHING: none is.

    Every byte of the whole text, white space included, is labelled by the network, which reads on over blanks and lines: the
    text goes through it in stretches of STRETCH bytes with CONTEXT more on either side. A document's score is the mean
    over its bytes. The text decides alone: lang, source and doc_id are no inputs.

    lang_pred is `und`, with score 0, if the text is null, empty or has no letter, or if nothing could be learned.
    Ties go to the language first in code point order. Columns of docs with the added names are replaced; extra
    columns stay; an empty table gives an empty one.
    """
    prepare(docs.sparkSession)
    model = train(docs) if model is None else None if model == NOTHING else model
    added = ["held_out", "lang_pred", "score"]
    inner, restore = shield(docs, ["doc_id", "text"])
    rows = inner.withColumn("held_out", held_out(F.col("doc_id"))).withColumn("_letters", F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False)))
    fields = [f for f in rows.schema.fields if f.name != "_letters" and (keep_text or f.name != "text")]
    names = [f.name for f in fields]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            some = batch.column(batch.schema.get_field_index("_letters")).to_pylist()
            lang, score = ["und"] * len(texts), [0.0] * len(texts)
            at = [i for i, ok in enumerate(some) if ok and model]
            if at:
                found = document_scores(model, [texts[i] for i in at])
                for i, p in zip(at, found, strict=True):
                    k = int(p.argmax())
                    lang[i], score[i] = model.languages[k], float(p[k])
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(k)) for k in names), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*names, "lang_pred", "score"])

    out = rows.mapInArrow(run, schema)
    return restore(out, added) if keep_text else out


def low_end(scores: DataFrame, share: float = LOW_SHARE) -> float | None:
    """The quantile of scores(score) at a small share, between its neighbours as percentile() has it; None without a score.

    Spark's percentile would hold all distinct scores in one task. Here each task passes on the lowest alone, as many as stand at or
    below the quantile: one in a thousand.
    """
    n = scores.count()
    if not n:
        return None
    place = share * (n - 1)
    low = [r["score"] for r in scores.orderBy("score").limit(int(place) + 2).collect()][-2 if int(place) + 2 <= n else -1 :]
    return low[0] + (place - int(place)) * (low[-1] - low[0])


def _threshold(scored: DataFrame, model: ByteGru) -> float:
    """The rejection score from scored(doc_id, lang, held_out, lang_pred, score): all its held-out documents labelled right count."""
    uniform = 1 / len(model.languages) * (1 - 1e-6)
    right = low_end(scored.where(F.col("doc_id").isNotNull() & F.col("held_out") & (F.col("lang_pred") == F.col("lang")) & (F.col("lang_pred") != "und")).select("score"))
    return uniform if right is None else (uniform + right) / 2


def rejection_score(docs: DataFrame, model: ByteGru) -> float:
    """The score below which a document is rejected: halfway from uniform to the lowest scores of all held-out documents labelled right.

    Uniform is one over the number of learned languages and the least that a best language can score. Without such
    documents nothing but uniform is known, and no score is rejected.
    """
    own = docs.where(F.col("lang").isin(model.languages) & F.col("text").isNotNull() & held_out(F.col("doc_id")))
    return _threshold(materialise(identify(own.select("doc_id", "lang", "text"), model).drop("text"), "judged"), model)


def keep_identified(docs: DataFrame, reject_below: float | None = None) -> DataFrame:
    """docs without those that language ID rejects: undetermined ones, and scores below reject_below or else rejection_score().

    For the latter all documents are scored once; what is written of a document is its number in the scan and its score, without
    text and other columns, and rows are left out by these numbers. The rejection score is taken from the held-out ones among them.
    """
    prepare(docs.sparkSession)
    docs = stored(docs)
    model = train(docs)
    inner, restore = shield(docs, ["doc_id", "text", "lang"])
    stays = (F.col("lang_pred") != "und") & (F.col("score") >= F.lit(reject_below or 0.0))
    if model is None or reject_below is not None:
        return restore(identify(inner, NOTHING if model is None else model).where(stays), [])
    numbered = inner.withColumn("_ord", row_ordinal())
    scored = materialise(identify(numbered.select("doc_id", "text", "lang", "_ord"), model).drop("text"), "identified")
    stays = (F.col("lang_pred") != "und") & (F.col("score") >= F.lit(_threshold(scored, model)))
    gone = materialise(scored.where(~stays).select(F.col("_ord").alias("_gone")), "rejected")
    return restore(numbered.join(broadcast_if_small(gone, MAX_BROADCAST), F.col("_ord") == F.col("_gone"), "left_anti"), [])


def op8(docs: DataFrame) -> DataFrame:
    return identify(docs.select("doc_id", "text", "lang"), keep_text=False).select("doc_id", "held_out", "lang_pred", "score")
