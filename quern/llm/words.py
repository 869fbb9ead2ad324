"""Words of many texts at once, inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text looked at together, in bytes; bounds what a task holds beside its batch.
PIECE_BYTES = 1 << 20


def pieces(batch: pa.RecordBatch, column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have at most ``size`` bytes together, or one longer text alone."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def split_words(texts: pa.Array, lower: bool = False) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, a number into them for every word of every text, and words per text.

    Words are runs of anything but the six ASCII white-space characters; ``lower`` folds A-Z.
    Null texts have no words.
    """
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    encoded = lists.flatten().dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    distinct = encoded.dictionary.to_pylist()
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = offsets - offsets[0]
    if "" in distinct:  # white space at the ends of a text
        real = codes != distinct.index("")
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
        codes = codes[real]
    return distinct, codes, np.diff(offsets)
