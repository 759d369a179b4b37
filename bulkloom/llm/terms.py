"""Words as the ranking, resampling and toxicity operators take them: runs of digits, a to z and all beyond ASCII, A to Z lower-cased."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: One byte to one byte: what parts words becomes a blank, A to Z lose their case, all else stays.
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEPT or b >= 128 else 32 for b in range(256))
#: Bytes of text that are split at once.
PIECE = 1 << 20


def word_lists(text: bytes | None, limit: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, in order, as lists of about limit bytes each; a word is never cut. Null text has none."""
    flat, at = (text or b"").translate(TABLE), 0
    while at < len(flat):
        end = flat.find(b" ", at + limit) if len(flat) - at > limit else len(flat)
        end = len(flat) if end < 0 else end
        yield flat[at:end].split()
        at = end


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()
