"""Token files against plain encoding, and packing against its definition."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import token_files
from quern.llm.encoding import TextEncoder, encoder
from quern.llm.queries import vocabulary


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.integers(0, 300), st.data())
def test_pack_round_trip(width, n, data):
    rng = np.random.default_rng(data.draw(st.integers(0, 1000)))
    ids = rng.integers(0, 1 << width, n, dtype=np.uint64).astype("<u4")
    payload = token_files.pack(ids, width)
    assert len(payload) == -(-n // 64) * 8 * width
    start = data.draw(st.integers(0, n))
    count = data.draw(st.integers(0, n - start))
    assert (token_files.unpack(payload, width, start, count) == ids[start : start + count]).all()


def test_pack_refuses_wide_ids():
    with pytest.raises(ValueError):
        token_files.pack(np.array([8], "<u4"), 3)


ODD = [
    "Plain words, and ends. Here's a ΣΊΣΥΦΟΣ; naïve été ÉTÉ",
    "tabs\tand\x0bfeeds\x0c\r\n and\x1cother\x85spaces\xa0here x",
    "<|startoftext|> a<|endoftext|>b <|STARTOFTEXT|>", "İstanbul ǅ ß ẞ ﬁ 1234 ½ x²", "don't WE'LL it's'", "日本語 テキスト 🙂🙂",
    "...,,, ;:! a,b,c. .a", "ab" * 5000, "ñ" * 300 + "Ñandú,", "",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_gives_the_librarys_ids(name):
    encode = TextEncoder(vocabulary(name), remembered=20)
    for texts in (ODD, [*ODD[::-1], None], [None], []):
        plain = [encode.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        ids, counts = encode.ids(pa.array(texts, pa.string()))
        assert ids.tolist() == sum(plain, [])
        assert counts.tolist() == [len(p) for p in plain]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=40))
def test_encoder_on_any_text(text):
    encode = encoder(vocabulary())
    ids, _ = encode.ids(pa.array([text]))
    assert ids.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def expected(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    return out


def test_files_describe_every_document(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(20, None), (21, "x" * 200_000), (3, ODD[3]), (None, "no id")]
    docs = spark.createDataFrame(rows[::-1], "doc_id long, text string").selectExpr(
        "*", "1 AS part", "'a' AS payload", "2L AS start")
    path = str(tmp_path / "files")
    token_files.write_token_files(docs.repartition(3), path, vocabulary(), 2, block_ids=50)
    got = [tuple(r) for r in token_files.document_starts(spark, path).orderBy("start").collect()]
    assert [(g[0], g[2], g[3]) for g in got] == expected(rows)
    assert [g[1] for g in got] == np.cumsum([0] + [g[2] for g in got[:-1]]).tolist()


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.token_output(empty, vocabulary()).count() == 0
