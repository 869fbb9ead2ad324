"""Text columns: normalization, hashes, byte tokens, fixed-length rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.schema import BOS_ID, EOS_ID

# Fixed value: the characters Python's str.split() treats as space, which are Unicode
# white space and four control characters. The property is three times faster here
# than the same characters listed one by one.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
TERM = r"[\p{L}\p{N}]+"

# Ids below this can be code points; a missing id sorts before any 32-bit one.
CODE_POINTS = 0x110000
NULL_ID = -(2**31) - 1


def normalize_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITESPACE, " "))


def content_hash(text: Column) -> Column:
    """md5 of the text with runs of white space collapsed."""
    return F.md5(normalize_space(text))


def content_key(text: Column) -> Column:
    """The content hash as 16 bytes, half the shuffle width of its hex form."""
    return F.unhex(content_hash(text))


def terms(text: Column) -> Column:
    """Lower-case letter and digit runs."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def byte_token_count(text: Column) -> Column:
    """Length of the byte tokens, without building them."""
    return (F.octet_length(text) + 2).cast("int")


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def byte_tokens(text: pa.Array) -> pa.Array:
    """[BOS, utf-8 bytes, EOS]; one pass over the Arrow data buffer per batch."""
    n = len(text)
    raw = text.cast(pa.large_string()).cast(pa.large_binary())
    _, offset_buffer, data_buffer = raw.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[raw.offset : raw.offset + n + 1]
    ends = offsets - offsets[0] + 2 * np.arange(n + 1)
    out = np.empty(int(ends[-1]), np.int32)
    body = np.ones(len(out), bool)
    body[ends[:-1]] = False
    body[ends[1:] - 1] = False
    out[ends[:-1]] = BOS_ID
    out[ends[1:] - 1] = EOS_ID
    if data_buffer is not None:
        out[body] = np.frombuffer(data_buffer, np.uint8)[offsets[0] : offsets[-1]]
    nulls = text.is_null() if text.null_count else None
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out), mask=nulls)


@F.arrow_udf(T.BinaryType())
def packed_ids(ids: pa.Array) -> pa.Array:
    """Token ids as bytes, for rows that travel or are sorted: in UTF-8, with each id as a code
    point, most ids of text take one byte instead of four. A row with a null, negative or larger
    id takes eight bytes an id. Either form sorts as the ids do."""
    ends, values = ids.offsets.to_numpy(), ids.values
    flat = values.fill_null(-1).to_numpy(zero_copy_only=False)
    wide = np.flatnonzero((flat < 0) | (flat >= CODE_POINTS))
    first = np.searchsorted(wide, ends)  # of the wide ids, per row
    found = []
    for i, valid in enumerate(ids.is_valid().to_pylist()):
        own = slice(ends[i], ends[i + 1])
        if not valid:
            found.append(None)
        elif first[i] < first[i + 1]:
            all_ids = values[ends[i] : ends[i + 1]].cast(pa.int64()).fill_null(NULL_ID).to_numpy()
            found.append(b"\1" + (all_ids - NULL_ID).astype(">u8").tobytes())
        else:
            text = flat[own].astype("<i4", copy=False).tobytes().decode("utf-32-le", "surrogatepass")
            found.append(b"\0" + text.encode("utf-8", "surrogatepass"))
    return pa.array(found, pa.binary())


def _ids_of(packed: bytes) -> np.ndarray:
    if packed[:1] == b"\1":
        return np.frombuffer(packed, ">u8", offset=1).astype(np.int64) + NULL_ID
    points = packed[1:].decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass")
    return np.frombuffer(points, "<i4")


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def unpacked_ids(pieces: pa.Array) -> pa.Array:
    """The ids of an array of packed pieces, one after another; NULL if a piece is NULL."""
    parts, ends, nulls = [np.empty(0, np.int32)], [0], []
    for row in pieces.to_pylist():
        nulls.append(row is None or None in row)
        own = [] if nulls[-1] else [_ids_of(piece) for piece in row]
        parts += own
        ends.append(ends[-1] + sum(map(len, own)))
    flat = np.concatenate(parts)
    values = pa.array(flat) if flat.dtype == np.int32 else pa.array(flat, mask=flat == NULL_ID)
    mask = pa.array(nulls, pa.bool_()) if any(nulls) else None
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values.cast(pa.int32()), mask=mask)


def pad_id_of(vocab_size: int) -> int:
    """The pad id: one past the vocabulary, so never a real token."""
    return vocab_size


def padded(ids: Column, length: int, pad_id: int) -> Column:
    """First ``length`` tokens, padded on the right."""
    kept = F.slice(ids, 1, length)
    return F.concat(kept, F.array_repeat(F.lit(pad_id), F.lit(length) - F.size(kept)))


def loss_mask(n_tokens: Column, length: int) -> Column:
    """True on real tokens, false on padding."""
    kept = F.least(n_tokens, F.lit(length)).cast("int")
    return F.concat(
        F.array_repeat(F.lit(True), kept), F.array_repeat(F.lit(False), F.lit(length) - kept)
    )


def real_tokens(ids: Column, pad_id: int) -> Column:
    """Number of tokens that are not padding."""
    return F.size(F.filter(ids, lambda x: x != F.lit(pad_id)))
