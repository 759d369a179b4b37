"""Secret scan through a trigram inverted index, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shield
from .trigrams import ANY, Query, query_of

#: Rules in order: the pattern, the least length of a group, the group. The index needs nothing else: a rule's query follows from its pattern.
#: For access and hex a run that is too short fails as a whole, so the length stands in the pattern.
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 1),
    "access": (r"AKIA[A-Z0-9]{16,}", 20, 0),
    "hex": (r"[0-9a-f]{24,}", 24, 0),
}
#: Further rules: private keys and the fixed forms of some services' tokens.
RULES = BASE | {
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    "forge": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    "chat": (r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    "cloud": (r"AIza[0-9A-Za-z_-]{35}", 0, 0),
}
#: Documents in a block of the index, about: a posting list never grows beyond it.
BLOCK = 4096
#: Matches whose places are summed at a time.
STRIDE = 64


def queries_of(rules=RULES) -> dict[str, Query]:
    """The trigram queries of the rules that have one; the others scan every text."""
    return {kind: q for kind, (pattern, *_) in rules.items() if (q := query_of(pattern)) != ANY}


def build_index(docs: DataFrame, rules=RULES) -> DataFrame:
    """(block, trigram, ids): posting lists of the trigrams that the rules' queries ask for, over every whole text in lower case.

    A block holds about BLOCK doc_ids, dealt by their hash, so lists stay bounded at any size. Null doc_ids aren't indexed.
    """
    asked = sorted({t for q in queries_of(rules).values() for s in q for t in s})
    blocks = max(1, -(-docs.count() // BLOCK))
    low = docs.where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.lower("text").alias("_low"))
    found = F.array_compact(F.array(*(F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in asked)))
    postings = low.select("doc_id", F.explode(found).alias("trigram"))
    return postings.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block"), "trigram").agg(F.collect_set("doc_id").alias("ids"))


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(_id, _may_<rule> for each rule that has a query): per block, posting lists intersect within a set and unite over the sets."""
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("of"))
    none = F.filter(F.flatten(F.map_values("of")), lambda x: F.lit(False))
    ids = lambda t: F.coalesce(F.try_element_at("of", F.lit(t)), none)
    answers = {kind: reduce(F.array_union, [reduce(F.array_intersect, map(ids, sorted(s))) for s in sorted(q, key=sorted)]) for kind, q in queries_of(rules).items()}
    named = lambda kind: lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("id"))
    hits = lists.select(F.explode(F.flatten(F.array(*(F.transform(found, named(kind)) for kind, found in answers.items())))).alias("hit"))
    return hits.groupBy(F.col("hit.id").alias("_id")).agg(*(F.bool_or(F.col("hit.kind") == kind).alias(f"_may_{kind}") for kind in answers))


def spans_of(text: Column, pattern: str, least: int, group: int) -> Column:
    """array<struct<start, end>> in code points: running sums over the pieces between matches and the matches.

    Places are summed STRIDE matches at a time, and the strides' arrays joined at the end: an array that grows by one
    match a step would be copied in each.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    each = F.arrays_zip(F.transform(gaps, lambda g: F.length(g)).alias("g"), F.transform(found, lambda m: F.length(m)).alias("m"), F.transform(inner, lambda x: F.length(x)).alias("x"))
    span = "struct<start:bigint,end:bigint,n:int>"

    def step(acc: Column, one: Column) -> Column:
        start = acc["at"] + one["g"]
        end = start + F.coalesce(one["m"], F.lit(0))
        made = F.struct(start.alias("start"), end.alias("end"), one["x"].alias("n"))
        return F.struct(end.alias("at"), F.when(one["m"].isNull(), acc["some"]).otherwise(F.concat(acc["some"], F.array(made))).alias("some"))

    def stride(pieces: Column):
        def one(acc: Column, first: Column) -> Column:
            zero = F.struct(acc["at"].alias("at"), F.array().cast(f"array<{span}>").alias("some"))
            some = F.aggregate(F.slice(pieces, first, STRIDE), zero, step)
            return F.transform(F.array(some), lambda s: F.struct(s["at"].alias("at"), F.concat(acc["all"], F.array(s["some"])).alias("all")))[0]

        return one

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<array<{span}>>").alias("all"))
    # the pieces are one element of an array, so that they are made once and not in every step
    spans = F.transform(F.array(each), lambda pieces: F.aggregate(F.sequence(F.lit(1), F.size(pieces), F.lit(STRIDE)), zero, stride(pieces), lambda acc: F.flatten(acc["all"])))[0]
    return F.filter(spans, lambda s: s["n"] >= least)


def _labelled(text: Column, kind: str, rank: int):
    def one(s: Column) -> Column:
        found = F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        return F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), found.alias("text"))

    return one


def scan_secrets(docs: DataFrame, rules=RULES, keep_found: bool = True) -> DataFrame:
    """docs with secrets: array<struct<kind, start, end, text>>, by start and then rule order; code points, end exclusive.

    Each rule's Boolean trigram query is derived from its pattern. The index holds posting lists for the trigrams that
    the queries ask for, over every document; intersected and united they leave the candidates of the rules that have
    mandatory trigrams, and the patterns verify these on whole texts. Rules without (hex) scan every text.
    Candidates join by doc_id: repeated ids are candidates together and verified one by one, and rows without doc_id
    are always verified. keep_found: give the secrets' texts too.

    Null text counts as empty; extra columns stay, one named secrets is replaced; an empty table gives an empty one.
    """
    inner, restore = shield(docs, ["doc_id", "text"])
    asked = queries_of(rules)
    rows = inner
    if asked:
        may = candidates(build_index(inner, rules), rules)
        rows = inner.join(may, F.col("doc_id") == F.col("_id"), "left")
    empty = F.array().cast("array<struct<kind:string,rank:int,start:bigint,end:bigint,text:string>>")
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = []
    for rank, (kind, (pattern, least, group)) in enumerate(rules.items()):
        test = F.col("doc_id").isNull() | F.coalesce(F.col(f"_may_{kind}"), F.lit(False)) if kind in asked else F.lit(True)
        spans = F.transform(spans_of(text, pattern, least, group), _labelled(text if keep_found else F.lit(""), kind, rank))
        parts.append(F.when(test & F.regexp_like(text, F.lit(pattern)), spans).otherwise(empty))
    by_start = lambda a, b: F.when(F.struct(a["start"], a["rank"]) < F.struct(b["start"], b["rank"]), -1).otherwise(1)
    every = F.array_sort(F.concat(*parts), by_start)
    every = F.transform(every, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text")))
    return restore(rows.withColumn("secrets", every), ["secrets"])


def op5(docs: DataFrame) -> DataFrame:
    out = scan_secrets(docs.select("doc_id", "text"), keep_found=False).select("doc_id", "secrets")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE))
    return out.select("doc_id", *(count(k) for k in BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined("secrets").alias("spans"))
