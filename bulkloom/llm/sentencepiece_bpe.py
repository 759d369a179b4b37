"""SentencePiece BPE encoding by backtracking over Aho-Corasick matches, and decoding."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import prepare

#: Chunks in each of the two halves of a worker's memory; when the newer is full, it becomes the older, whose rest goes.
MEMORY = 200_000
#: Characters of a chunk that is remembered, at most, so that the memory is bounded in bytes too.
LONGEST = 64
_NEVER = float("-inf")


class Codec:
    """Encoder and decoder for one BPE model; only the vocabulary is read from the library.

    A token sequence is the BPE encoding exactly if each two neighbours, merged again from their characters, come out as
    these two tokens. Every prefix of a text has one such sequence, so a position that couldn't be extended can be
    marked once, in a bitfield. Candidates at a position are the tokens that Aho-Corasick found there, longest first,
    among those that merging their own characters yields.

    Text is cut into chunks where no piece of the vocabulary spans the cut, which changes nothing; chunks repeat, so
    their encodings are remembered.
    """

    def __init__(self, model_path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ids = range(sp.get_piece_size())
        self.unknown, self.end = sp.unk_id(), sp.eos_id()
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in ids if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.silent = {i for i in ids if sp.is_control(i)}
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.piece = {i: sp.id_to_piece(i).replace("▁", " ") for i in plain}
        self.id = {p: i for i, p in self.piece.items()}
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self._read_as_assumed(sp)
        self.chunk = self._chunks()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.whole = {p for p in self.id if self.merge(p) == [p]}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for p in self.whole:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()

    def _read_as_assumed(self, sp: sentencepiece.SentencePieceProcessor) -> None:
        """Stop if the model normalises texts, folds or trims blanks, or puts no blank in front: this codec does what a model without these does."""
        seen = "Ａ ﬁ ①  e\u0301 x "
        if sp.decode(sp.encode(seen)) != seen or not sp.encode("a", out_type=str)[0].startswith("▁"):
            raise ValueError("the model normalises text or puts no blank in front of it")

    def _chunks(self) -> re.Pattern:
        """A pattern whose matches cover any text and end only where no piece goes on.

        Cuts are before spaces and between letters and others, where the vocabulary allows; characters that count as
        letters but share pieces with others, such as superscript digits, are taken for others.
        """
        joints = {(a, b) for p in self.id for a, b in zip(p, p[1:], strict=False)}
        if any(b == " " and a != " " for a, b in joints):
            return re.compile(r"(?s).+")
        odd, new = set(), {""}
        while new and len(odd) < 100:
            letter = re.compile(rf"[^\W\d_{re.escape(''.join(sorted(odd)))}]")
            new = {a if letter.match(a) else b for a, b in joints if a != " " and bool(letter.match(a)) != bool(letter.match(b))}
            odd |= new
        if new:
            return re.compile(r" *[^ ]+| +")
        odd = re.escape("".join(sorted(odd)))
        return re.compile(rf" *(?:[^\W\d_{odd}]+|(?:[^\w ]|[\d_{odd}])+)| +")

    def merge(self, text: str) -> list[str]:
        """BPE by its definition: the best adjacent pair in the vocabulary merges, the leftmost of equals, until none is left."""
        parts, score = list(text), self.score.get
        pairs = [score(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (best := max(pairs)) > _NEVER:
            k = pairs.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k:
                pairs[k - 1] = score(parts[k - 1] + parts[k], _NEVER)
            if k < len(pairs):
                pairs[k] = score(parts[k] + parts[k + 1], _NEVER)
        return parts

    def fits(self, a: str, b: str) -> bool:
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) > MEMORY:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merge(a + b) == [a, b]
        return got

    def tokens(self, chunk: str) -> list[str]:
        """The chunk's encoding as pieces; characters outside the vocabulary stand for themselves."""
        if chunk in self.whole:
            return [chunk]
        n = len(chunk)
        lengths: list[list[int]] = [[] for _ in range(n)]
        for last, size in self.automaton.iter(chunk):  # by last place, so that sizes at one place ascend
            lengths[last - size + 1].append(size)
        out: list[str] = []
        at, failed, skip = 0, 0, [0] * (n + 1)
        while at < n:
            sizes = lengths[at] or [1]
            for k in range(skip[at], len(sizes)):
                size = sizes[-1 - k]
                token = chunk[at : at + size]
                if not failed >> (at + size) & 1 and (not out or self.fits(out[-1], token)):
                    skip[at] = k + 1
                    out.append(token)
                    at += size
                    skip[at] = 0
                    break
            else:
                failed |= 1 << at
                at -= len(out.pop())
        return out

    def ids_of(self, token: str) -> list[int]:
        known = self.id.get(token)
        if known is not None:
            return [known]
        return [self.bytes[b] for b in token.encode()] if self.bytes else [self.unknown]

    def _chunk_ids(self, chunk: str) -> tuple[str, str]:
        ids = [i for t in self.tokens(chunk) for i in self.ids_of(t)]
        return " ".join(map(str, ids)), self.decode_part(ids)

    def lookup(self, text: str) -> list[tuple[str, str]]:
        """For each chunk of the text, behind a space as the model puts one, its ids and what these decode to."""
        if not text:
            return []
        known, out = self.known, []
        for c in self.chunk.findall(" " + text.replace("▁", " ")):
            got = known.get(c)
            if got is None:
                if len(known) > MEMORY:
                    self.older, self.known = known, {}
                    known = self.known
                got = self.older.get(c) or self._chunk_ids(c)
                if len(c) <= LONGEST:
                    known[c] = got
            out.append(got)
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of the text and the end id."""
        return [int(i) for ids, _ in self.lookup(text) for i in ids.split()] + [self.end]

    def decode_part(self, ids: list[int]) -> str:
        """Text of ids, with the leading space kept; runs of byte ids are read as UTF-8."""
        out, run = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            out.append("" if i in self.silent else self.piece.get(i, " ⁇ "))
        return "".join(out) + (run.decode("utf-8", "replace") if run else "")

    def decode(self, ids: list[int]) -> str:
        text = self.decode_part(ids)
        return text[1:] if text.startswith(" ") else text


_CODECS: dict[str, Codec] = {}


def codec(model_path: str) -> Codec:
    """This process's codec of the model."""
    if model_path not in _CODECS:
        _CODECS[model_path] = Codec(model_path)
    return _CODECS[model_path]


_FIELDS = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
_ARROW = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "decoded": pa.string(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}


def encode_documents(docs: DataFrame, model_path: str, outputs=("n_tokens", "ids", "decoded"), keep_text: bool = True) -> DataFrame:
    """docs with the wanted outputs: n_tokens, ids, decoded, ids_sha256, decoded_sha256; one row for each row.

    Whole texts are encoded, with an end id after each, and decoded from their ids. The digests are taken where the
    ids are, so that a query that wants only them moves no ids. There is no shuffle; a task holds one Arrow batch
    and the bounded memory of its codec.

    Null text counts as empty: the end id alone. Columns of docs with the names of outputs are replaced; extra
    columns stay; an empty table gives an empty one.
    """
    prepare(docs.sparkSession)
    rows = docs.drop(*outputs)
    fields = [f for f in rows.schema.fields if keep_text or f.name != "text"]
    schema = T.StructType([*fields, *(T.StructField(k, _FIELDS[k]) for k in outputs)])
    names = [f.name for f in fields]
    wants_text = {"decoded", "decoded_sha256"} & set(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        end = str(c.end)
        for batch in batches:
            made: dict[str, list] = {k: [] for k in outputs}
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                parts = c.lookup(text or "")
                ids = " ".join([*[p[0] for p in parts], end])
                if "n_tokens" in made:
                    made["n_tokens"].append(ids.count(" ") + 1)
                if "ids" in made:
                    made["ids"].append(list(map(int, ids.split())))
                if "ids_sha256" in made:
                    made["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
                if wants_text:
                    decoded = "".join([p[1] for p in parts])[1:]
                    if "decoded" in made:
                        made["decoded"].append(decoded)
                    if "decoded_sha256" in made:
                        made["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(k)) for k in names), *(pa.array(made[k], _ARROW[k]) for k in outputs)], names=[*names, *outputs])

    return rows.mapInArrow(run, schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9(docs: DataFrame) -> DataFrame:
    return encode_documents(docs.select("doc_id", "text"), default_model(), ("n_tokens", "ids_sha256", "decoded_sha256"), keep_text=False)
