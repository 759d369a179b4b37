"""Personal data: generators propose overlapping spans, boosted trees score them, calibrated thresholds select."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, shield

KINDS = ("email", "ip", "card", "phone")
#: A text without any of these has neither a base span nor a proposal, so it need not leave the JVM: numbers and @, or an `at` in any
#: of the generator's forms (see _AT and _AFTER_AT) with a word and a dot of any form behind it. It asks less than the generator does.
TRIGGER = r"[@0-9]|(?i:at ?[)\]}]? ?[^\s.]{1,63}(?:\.\S| ?[(\[{] ?dot| dot ))"
#: The trees are fitted on about so many documents, on so many own proposals of each at most, and on so many planted spans in each.
SAMPLE_DOCS, OWN_SPANS, PLANTS = 1_500, 6, 6
#: Planted spans without a document around them, so that there is a model for any table.
BARE_PLANTS = 3_000
#: Precision that a kind's threshold must reach on documents that the trees haven't seen.
PRECISION = 0.99

# -- base spans, as the contract fixes them

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Around each @, the run of local characters before it and the domain after it: linear for any text."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _ips(text: str) -> list[tuple[int, int]]:
    """Of each run of numbers joined by dots, every four in turn are a match: each run is read once, however long."""
    out = []
    for m in _DOTTED.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(map(_small, four)):
                out.append((at, at + size))
            at += size + 1
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; code points, end exclusive."""
    out = [("email", *s) for s in _emails(text)]
    out += [("ip", *s) for s in _ips(text)]
    out += [("card", *m.span()) for m in _CARD.finditer(text) if 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


# -- proposals and their features

_AT = re.compile(r"@|[(\[{] ?at ?[)\]}]|\bat\b", re.I)
_BEFORE_AT = re.compile(r"[\w.%+-]{1,64} ?$")
_AFTER_AT = re.compile(r" ?[\w-]{1,63}(?:(?:\.| ?[(\[{] ?dot ?[)\]}] ?| dot )[\w-]{1,63}){1,6}", re.I)
_NUMBER = re.compile(r"[0-9]+")
_JOINT = re.compile(r"[ .,:()/_-]{1,3}")
#: Numbers that one span may be made of, at most.
GROUPS = 8
_CONTEXT = (re.compile(r"mail|contact", re.I), re.compile(r"phone|tel\b|call|mobil|fax", re.I), re.compile(r"card|visa|credit|pay", re.I), re.compile(r"\bip\b|host|server|addr", re.I), re.compile(r"version|licen|v\.|\bno\b|isbn|doi", re.I))


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Spans that may be personal data; they overlap, also within a kind.

    Emails: what stands around each @, (at) or at. Numbers: every chain of up to GROUPS numbers with short joints
    between them is a proposal of each kind that its count of digits or numbers allows, so a number that stands
    right beside another is proposed both with and without it.
    """
    out = []
    for m in _AT.finditer(text):
        left, right = _BEFORE_AT.search(text, max(0, m.start() - 66), m.start()), _AFTER_AT.match(text, m.end())
        if left and right:
            out.append(("email", left.start(), right.end()))
    numbers = [m.span() for m in _NUMBER.finditer(text)]
    for i, (start, end) in enumerate(numbers):
        if end - start > 20:
            continue
        digits, lead = 0, start
        if start and text[start - 1] == "(":
            lead -= 1
        if lead and text[lead - 1] == "+":
            lead -= 1
        for k in range(i, min(i + GROUPS, len(numbers))):
            s, e = numbers[k]
            if k > i and not _JOINT.fullmatch(text, numbers[k - 1][1], s):
                break
            digits += e - s
            if digits > 20:
                break
            if k == i + 3:
                out.append(("ip", start, e))
            if digits >= 12:
                out.append(("card", start, e))
            if 7 <= digits <= 16:
                out.append(("phone", lead, e))
    return out


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span and what stands around it."""
    span, before, after = text[start:end], text[max(0, start - 30) : start], text[end : end + 30]
    digits = digits_of(span)
    groups = _NUMBER.findall(span)
    sizes = [len(g) for g in groups] or [0]
    seps = [c for c in span if not c.isalnum()]
    joints = [j for j in _NUMBER.split(span)[1:-1]]
    tail = re.search(r"([A-Za-z]*)$", span)
    small = [int(g) for g in groups if len(g) < 9]
    return [
        *(float(kind == k) for k in KINDS), len(span), len(digits), len(set(digits)), len(seps), len(set(seps)), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        float(bool(digits) and luhn(digits)), float(max(small, default=999) <= 255 and max(sizes) <= 3), float(span.startswith("+")), float(span.startswith("00")), float("(" in span), float("@" in span), span.count("."), span.count(" "), sum(c.isalpha() for c in span),
        float(len(set(joints)) <= 1), float(any(len(g) > 1 and g[0] == "0" for g in groups)), sum(1900 <= v <= 2099 for v in small), float(bool(re.search(r"[(\[{] ?(?:at|dot)", span, re.I))), float(bool(re.search(r" dot ", span, re.I))),
        len(tail[1]) if tail else 0, float(before[-1:].isspace() or not before), float(after[:1].isspace() or not after), float(after[:1] in {".", ",", ";"} and bool(after)), float(before[-1:] in set("0123456789.+-/:") and bool(before)), float(bool(re.match(r"[.:/-]?[0-9]", after))), int(digits[0]) if digits else -1,
        *(float(bool(c.search(before)) or bool(c.search(after))) for c in _CONTEXT),
    ]


FEATURES = len(features("", "ip", 0, 0))


def _overlaps(span: tuple[str, int, int], others: list[tuple[str, int, int]]) -> bool:
    return any(span[1] < e and s < span[2] for _, s, e in others)


# -- planted spans: labels that don't come from the base patterns


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _grouped(digits: str, sizes: list[int], sep: str) -> str:
    out, at = [], 0
    for n in sizes:
        out.append(digits[at : at + n])
        at += n
    return sep.join(g for g in [*out, digits[at:]] if g)


def _card(rng: random.Random) -> str:
    """A number of an issuer's range and length that passes Luhn, in one of the ways in which it is written."""
    lead, n, sizes = rng.choice([("4", 16, [4, 4, 4]), (f"5{rng.randrange(1, 6)}", 16, [4, 4, 4]), ("34", 15, [4, 6]), ("37", 15, [4, 6]), ("6011", 16, [4, 4, 4])])
    body = lead + _digits(rng, n - len(lead) - 1)
    body += next(d for d in "0123456789" if luhn(body + d))
    return _grouped(body, rng.choice([[], [], sizes]), rng.choice([" ", "-", ".", "/", "_"]))


def _phone(rng: random.Random) -> str:
    """A number of the plans +CC, 00CC or with an area code in brackets."""
    area, three, four = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    return rng.choice([f"({area}) {three}-{four}", f"+1 ({area}) {three}-{four}", f"00{rng.choice(['1', '33', '44', '49'])} {area} {three} {four}", f"+{rng.choice(['33', '44', '49'])} {area} {three}{four}", f"{area}-{three}-{four}", f"0{area}/{three}{four}", f"+1.{area}.{three}.{four}"])


def _email(rng: random.Random) -> str:
    word = lambda n=7: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, n)))
    name, host, end = word() + rng.choice(["", "." + word(), str(rng.randrange(100))]), word() + rng.choice(["", "." + word()]), rng.choice(["com", "org", "net", "de", "fr", "es", "io", "edu"])
    at, dot = rng.choice([("@", "."), ("@", "."), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot "), (" @ ", "."), ("[at]", "."), (" (at) ", ".")])
    return name + at + (host + "." + end).replace(".", dot)


def _ip(rng: random.Random) -> str:
    parts = [str(rng.randrange(1, 255)) for _ in range(4)]
    return rng.choice([".", ".", ". ", " . ", ","]).join(parts)


def _lookalike(rng: random.Random) -> tuple[str, str]:
    """What looks like personal data and is none, with the kind it resembles."""
    n, kind = rng.randrange(12), rng.choice(KINDS)
    year, month, day = rng.randrange(1900, 2100), rng.randrange(1, 13), rng.randrange(1, 29)
    if n < 4:
        body = _digits(rng, rng.choice([13, 15, 16, 16, 16, 19]))
        body = body if not luhn(body) else body[:-1] + str((int(body[-1]) + rng.randrange(1, 10)) % 10)
        return _grouped(body, rng.choice([[], [], [4, 4, 4]]), rng.choice([" ", "-"])), "card"
    every = {
        "ip": [f"{rng.randrange(1, 20)}.{rng.randrange(300, 900)}.{rng.randrange(300, 9999)}.{rng.randrange(1, 90)}", f"{rng.randrange(1, 9)}, {rng.randrange(1, 99)}, {rng.randrange(300, 999)}, {rng.randrange(1, 99)}", f"{rng.randrange(256, 999)}.{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}"],
        "card": [_digits(rng, rng.choice([12, 14, 17, 18, 20])) + rng.choice(["", "x"]), f"{year}{month:02}{day:02}{_digits(rng, 6)}"],
        "phone": [f"{year}-{month:02}-{day:02}", f"{day:02}/{month:02}/{year}", f"{year}-{year + 1}", f"{year}-{month:02}-{day:02} {rng.randrange(24):02}:{rng.randrange(60):02}", _digits(rng, rng.randrange(7, 14)), f"{rng.randrange(1, 999)},{_digits(rng, 3)},{_digits(rng, 3)}", f"{_digits(rng, 4)}.{_digits(rng, 5)}", f"978-{_digits(rng, 1)}-{_digits(rng, 4)}-{_digits(rng, 4)}-{_digits(rng, 1)}"],
        "email": [f"look at the.{rng.choice(['dot', 'end'])} dot {rng.choice(['it', 'we', 'that'])}", "meet at noon.then", f"see you at {rng.randrange(1, 12)}.{rng.randrange(10, 60)}", "@someone", "a @ b"],
    }
    return rng.choice(every[kind]), kind


#: What people write before such data; look-alikes get it too, but seldom.
_CUES = {"email": ("mail ", "e-mail: ", "contact "), "ip": ("host ", "server ", "ip address "), "card": ("card ", "visa ", "paid by credit card "), "phone": ("call ", "phone: ", "tel. ", "Tel: ", "fax ", "mobile ", "call me at ")}
_MADE = {"email": _email, "ip": _ip, "card": _card, "phone": _phone}


def planted(rng: random.Random, text: str) -> list[tuple[str, list[float], float]]:
    """(kind, features, label) of the proposals that touch a span written into an excerpt of the text, at one of its blanks.

    The label is 1 for the proposal that is the written span, if that is personal data, and 0 for parts of it, for
    what runs over its ends and for look-alikes. Now and then another number is written right beside it.
    """
    good = rng.random() < 0.5
    kind = rng.choice(KINDS)
    span, kind = (_MADE[kind](rng), kind) if good else _lookalike(rng)
    at = rng.randrange(len(text) + 1)
    at = text.find(" ", at) + 1
    left, right = text[max(0, at - 120) : at], text[at : at + 120]
    if rng.random() < (0.5 if good else 0.05):
        left += rng.choice(_CUES[kind])
    elif rng.random() < 0.15:
        left += rng.choice([_digits(rng, 16), _digits(rng, 3), str(rng.randrange(3000)), _card(rng)]) + " "
    if rng.random() < 0.15:
        right = rng.choice([_digits(rng, 16), _digits(rng, 3), str(rng.randrange(3000)), _card(rng)]) + " " + right
    whole = left + span + rng.choice(["", "", ",", ".", "!!", "###"]) + (" " if right else "") + right
    start, end = len(left), len(left) + len(span)
    return [(k, features(whole, k, s, e), float(good and (k, s, e) == (kind, start, end))) for k, s, e in proposals(whole) if s < end and start < e]


def learnt_from(text: str, seed: int) -> list[tuple[str, list[float], float]]:
    """(kind, features, label) of one sampled document: planted spans, and its own proposals, chosen by chance where they are many.

    Of its own, a number that passes Luhn in an issuer's range and length is a card; proposals that the base patterns
    neither hold nor touch are look-alikes; all others stay out.
    """
    rng = random.Random(seed)
    out = [row for _ in range(PLANTS) for row in planted(rng, text)]
    base = base_spans(text)
    own = [p for p in proposals(text) if not _overlaps(p, base)]
    for kind, s, e in rng.sample(own, min(OWN_SPANS, len(own))):
        issued = kind == "card" and text[s:e].isdigit() and luhn(text[s:e]) and (len(text[s:e]), text[s]) in {(16, "4"), (16, "5"), (15, "3"), (16, "6")}
        if not luhn(digits_of(text[s:e])) or issued:
            out.append((kind, features(text, kind, s, e), float(issued)))
    return out


# -- boosted trees


class BoostedTrees:
    """Gradient boosting for the logistic loss: trees of fixed depth over binned features, with shrinkage."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, penalty: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.penalty = rounds, depth, rate, bins, penalty
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, self.bins)))[:-1] for k in range(x.shape[1])]
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        binned, score = self._binned(x), np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = self._grow(binned, p - y, p * (1 - p))
            self.trees.append(tree)
            score += tree[2][leaf]
        return self

    def _grow(self, binned: np.ndarray, grad: np.ndarray, hess: np.ndarray):
        """A tree as (feature, bin) of each inner node, in heap order, and values of the leaves; rows with a larger bin go right."""
        inner = (1 << self.depth) - 1
        feature, cut, node = np.zeros(inner, np.int64), np.full(inner, self.bins, np.int64), np.zeros(len(grad), np.int64)
        for level in range(self.depth):
            first = (1 << level) - 1
            for n in range(first, 2 * first + 1):
                rows = np.nonzero(node == n)[0]
                feature[n], cut[n] = self._split(binned[rows], grad[rows], hess[rows])
            node = 2 * node + 1 + (binned[np.arange(len(node)), feature[node]] > cut[node])
        leaf = node - inner
        value = -self.rate * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, hess, inner + 1) + self.penalty)
        return (feature, cut, value), leaf

    def _split(self, binned: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[int, int]:
        best, found = 1e-6, (0, self.bins)
        g, h = grad.sum(), hess.sum()
        for k in range(binned.shape[1]):
            gl = np.cumsum(np.bincount(binned[:, k], grad, self.bins + 1))
            hl = np.cumsum(np.bincount(binned[:, k], hess, self.bins + 1))
            gain = gl**2 / (hl + self.penalty) + (g - gl) ** 2 / (h - hl + self.penalty) - g**2 / (h + self.penalty)
            at = int(gain.argmax())
            if gain[at] > best:
                best, found = gain[at], (k, at)
        return found

    def score(self, x: np.ndarray) -> np.ndarray:
        binned, out = self._binned(x), np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
            out += value[node - len(feature)]
        return out


class SpanModel:
    """Trees, and for each kind the least score that reaches the wanted precision on documents that the trees haven't seen."""

    def __init__(self, trees: BoostedTrees | None, thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def added(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Proposals above their threshold that touch no base span, the best first where they overlap each other."""
        if self.trees is None:
            return []
        ends = sorted((s, e) for _, s, e in base)
        some = [p for p in proposals(text) if p[0] in self.thresholds]
        some = [p for p, free in zip(some, _free(some, ends), strict=True) if free]
        if not some:
            return []
        score = np.concatenate([self.trees.score(np.array([features(text, *p) for p in some[k : k + 4096]])) for k in range(0, len(some), 4096)])
        taken, out = bytearray(len(text)), []
        for k in np.argsort(-score, kind="stable"):
            kind, s, e = some[k]
            if score[k] >= self.thresholds[kind] and not any(taken[s:e]):
                taken[s:e] = b"\x01" * (e - s)
                out.append(some[k])
        return out


def _free(spans: list[tuple[str, int, int]], taken: list[tuple[int, int]]) -> np.ndarray:
    """Whether each span touches none of taken, which are sorted by start: by a running maximum of their ends."""
    if not taken or not spans:
        return np.ones(len(spans), bool)
    starts, last = np.array([s for s, _ in taken]), np.maximum.accumulate([e for _, e in taken])
    before = np.searchsorted(starts, [e for _, _, e in spans]) - 1
    return (before < 0) | (last[before] <= np.array([s for _, s, _ in spans]))


def fit_model(x: np.ndarray, y: np.ndarray, kinds: np.ndarray, docs: np.ndarray, seed: int = 3) -> SpanModel:
    """Trees on the rows of seven tenths of the documents, thresholds on those of the rest.

    A kind's threshold is the least score from which on its rows reach PRECISION, one more miss being counted than
    there are; a kind that never does gets no threshold and adds nothing.
    """
    if len(set(y.tolist())) < 2:
        return SpanModel(None, {})
    names = np.unique(docs)
    fitted = np.isin(docs, np.random.default_rng(seed).permutation(names)[: max(1, int(0.7 * len(names)))])
    if len(set(y[fitted].tolist())) < 2 or fitted.all():
        fitted = np.arange(len(y)) % 10 < 7
    trees = BoostedTrees().fit(x[fitted], y[fitted])
    rest = np.nonzero(~fitted)[0]
    score, thresholds = trees.score(x[rest]), {}
    for kind in KINDS:
        own = kinds[rest] == kind
        by_score = np.argsort(-score[own], kind="stable")
        s, hits = score[own][by_score], np.cumsum(y[rest][own][by_score])
        good = np.nonzero(hits >= PRECISION * (np.arange(1, len(s) + 1) + 1))[0]
        if len(good):
            thresholds[kind] = float(s[good[-1]])
    return SpanModel(trees, thresholds)


# -- on Spark


def _masked(docs: DataFrame):
    return F.when(F.regexp_like("text", F.lit(TRIGGER)), F.col("text"))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> SpanModel:
    """A model from a bounded sample: about sample_docs documents, by a hash of doc_id, each with a bounded number of rows.

    Labels don't come from the base patterns: personal data of many written forms and look-alikes are planted into
    excerpts of the sampled documents; their own proposals add cards by issuer and Luhn and further look-alikes.
    Spans planted without a document around them are always there, so every table, an empty one too, has a model.
    """
    prepare(docs.sparkSession)
    n = docs.count()
    share = F.pmod(F.xxhash64(F.lit("pii"), "doc_id"), F.lit(1 << 30)) < int(min(1.0, sample_docs / max(n, 1)) * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(seed, *row) for seed, text in zip(*(c.to_pylist() for c in batch.columns), strict=True) for row in learnt_from(text, seed)]
            of, kinds, x, labels = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(of, pa.int64()), pa.array(kinds, pa.string()), pa.array(labels, pa.float64()), pa.array(x, pa.list_(pa.float64()))], names=["of", "kind", "y", "x"])

    some = docs.where(share & F.col("text").isNotNull()).select(F.xxhash64("doc_id", "text").alias("seed"), "text")
    got = [(r["of"], r["kind"], r["x"], r["y"]) for r in some.mapInArrow(run, "of long, kind string, y double, x array<double>").collect()]
    rng = random.Random(5)
    got += [(k, *row) for k in range(BARE_PLANTS) for row in planted(rng, "")]
    got.sort(key=lambda r: (r[0], r[1], r[2]))
    of, kinds, x, y = zip(*got, strict=True)
    return fit_model(np.array(x), np.array(y), np.array(kinds), np.array(of))


def find_pii(docs: DataFrame, model: SpanModel | None = None, keep_text: bool = True) -> DataFrame:
    """docs with base and pii: array<struct<kind, start, end>>, by kind as listed and then start; one row for each row.

    pii holds every base span and those that the model adds. Without a model, one is trained on a sample of docs.
    Whole texts are read; those that TRIGGER leaves out can hold no span and stay in the JVM.
    Null text counts as empty; columns of docs with the added names are replaced; an empty table gives an empty one.
    """
    prepare(docs.sparkSession)
    model = model or train(docs)
    inner, restore = shield(docs, ["doc_id", "text"])
    rows = inner.withColumn("_seen", _masked(inner))
    fields = [f for f in rows.schema.fields if f.name != "_seen" and (keep_text or f.name != "text")]
    names = [f.name for f in fields]
    spans = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    as_rows = lambda found: [{"kind": k, "start": s, "end": e} for k, s, e in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [], []
            for text in batch.column(batch.schema.get_field_index("_seen")).to_pylist():
                found = base_spans(text) if text else []
                more = model.added(text, found) if text else []
                base.append(as_rows(found))
                every.append(as_rows(sorted([*found, *more], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(k)) for k in names), pa.array(base, arrow), pa.array(every, arrow)], names=[*names, "base", "pii"])

    if not keep_text:
        rows = rows.drop("text")
    out = rows.mapInArrow(run, T.StructType([*fields, T.StructField("base", spans), T.StructField("pii", spans)]))
    return restore(out, ["base", "pii"]) if keep_text else out


def redact(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """docs with every span of pii in the text replaced by its kind in brackets; overlapping spans become one."""
    inner, restore = shield(docs, ["doc_id", "text"])
    found, names = find_pii(inner, model), inner.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(batch.schema.get_field_index("text")).to_pylist(), batch.column(batch.schema.get_field_index("pii")).to_pylist(), strict=True):
                out, at = [], 0
                for s in sorted(spans or [], key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= at:
                        out += [text[at : s["start"]], f"[{s['kind']}]"]
                    at = max(at, s["end"])
                texts.append(text if text is None else "".join([*out, text[at:]]))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if k == "text" else batch.column(batch.schema.get_field_index(k)) for k in names], names=names)

    return restore(found.select(*names, "pii").mapInArrow(run, inner.schema), [])


def op3(docs: DataFrame) -> DataFrame:
    out = find_pii(docs.select("doc_id", "text"), keep_text=False)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select("doc_id", *(count(k) for k in KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("pii").alias("spans"))
