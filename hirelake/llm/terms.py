"""Words of letters and digits, A-Z lower-cased: bytes 0-9, a-z and all of characters beyond ASCII."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from hirelake.llm.wordhash import text_slices

#: Every other byte becomes a space. Bytes of characters beyond ASCII stay, so the text stays valid.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_TABLE = np.frombuffer(PLAIN, np.uint8)


def collapsed(text: str | None) -> bytes:
    """The words of a text, each after one space."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(PLAIN).split()
    return b" " + b" ".join(words) if words else b""


def term_slices(column: pa.Array, most_bytes: int = 2 << 20):
    """(words of a slice of texts as one Arrow array, number of the text that each stands in, number of texts)."""
    for first, end, data, offsets in text_slices(column, most_bytes):
        plain = pa.LargeStringArray.from_buffers(end - first, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_TABLE[data]))
        parts = pc.ascii_split_whitespace(plain)
        words, doc = parts.flatten(), pc.list_parent_indices(parts).to_numpy()
        full = pc.greater(pc.binary_length(words), 0)
        yield words.filter(full), doc[full.to_numpy(zero_copy_only=False)], end - first
