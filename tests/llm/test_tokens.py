import base64
import functools
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.fixture import documents, plain, texts
from zonekit.llm import bpe_codec, queries, token_files
from zonekit.llm.common import scratch


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(queries.WORD_TOKENIZER)


@pytest.fixture(scope="module")
def byte_pairs():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.BYTE_RANKS, "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_files_in_id_order(spark, words):
    out = scratch(spark, "t")
    token_files.write_token_files(plain(spark).repartition(5), out, queries.WORD_TOKENIZER, 2)
    got = {r.doc_id: r for r in token_files.read_token_files(spark, out, queries.WORD_VOCABULARY, part_ids=500).withColumn("crc", F.crc32("ids")).collect()}
    start = 0
    for i, text in enumerate(texts()):
        ids = np.array([*words.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].crc) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_with_null_and_repeated_ids_and_empty(spark):
    out, docs = scratch(spark, "t"), documents(spark)
    manifest = token_files.write_token_files(docs, out, queries.WORD_TOKENIZER, 2)
    rows = token_files.read_token_files(spark, out, queries.WORD_VOCABULARY).collect()
    assert len(rows) == docs.count()
    assert sorted(rows, key=lambda r: r.start)[0].doc_id is None
    ends = {r.start + r.n_tokens for r in rows}
    assert all(r.start == 0 or r.start in ends for r in rows)
    assert manifest.agg(F.sum("n_tokens")).first()[0] == max(ends)
    out = scratch(spark, "t")
    token_files.write_token_files(docs.where("false"), out, queries.WORD_TOKENIZER, 2)
    assert token_files.read_token_files(spark, out, queries.WORD_VOCABULARY).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from([*"aA'sS tl1éÉßÿ×÷\x1c\x85\xa0 ", "<|endoftext|>", "<|startoftext|>"]))).map("".join))
def test_word_encoder_is_the_library(text):
    enc = token_files.encoder(queries.WORD_TOKENIZER)
    assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == _untouched().encode(text, add_special_tokens=False).ids


@functools.cache
def _untouched():
    return Tokenizer.from_file(queries.WORD_TOKENIZER)


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "x<|endoftext|><|startoftext|>y", "<|ENDOFTEXT|>", "<|endoftext|", "É\u0301<|endoftext|>\u0301 日本<|startoftext|>語"])
def test_added_tokens_as_the_library_recognises_them(text):
    enc = token_files.encoder(queries.WORD_TOKENIZER)
    assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == _untouched().encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("ab1 \n\t'.\x1c\xa0"))), st.integers(1, 20))
def test_parts_encode_like_the_whole(text, size):
    enc = bpe_codec.codec(queries.BYTE_RANKS, public_tokenizers.PATTERN)
    assert "".join(bpe_codec.parts(text, size)) == text
    assert bpe_codec.encode_text(enc, text, size) == enc.encode_ordinary(text)
    assert enc.decode_bytes(enc.encode_ordinary(text)) == text.encode()


def test_codec_query_columns(spark, byte_pairs):
    docs = documents(spark)
    got = bpe_codec.round_trip_digests(docs, queries.BYTE_RANKS, public_tokenizers.PATTERN, part_chars=1000).collect()
    ids = lambda t: byte_pairs.encode_ordinary(t or "")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    key = lambda x: (x[0] is None, x)
    want = [(r.doc_id, len(ids(r.text)), sha(",".join(map(str, ids(r.text))).encode()), sha((r.text or "").encode())) for r in docs.collect()]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_encode_then_decode_keeps_columns(spark):
    docs = documents(spark)
    back = bpe_codec.decode(bpe_codec.encode(docs, queries.BYTE_RANKS, public_tokenizers.PATTERN), queries.BYTE_RANKS, public_tokenizers.PATTERN)
    assert set(back.columns) == {*docs.columns, "decoded"}
    assert back.where(F.decode("decoded", "utf-8") != F.coalesce("text", F.lit(""))).count() == 0
    assert bpe_codec.encode(docs.where("false"), queries.BYTE_RANKS, public_tokenizers.PATTERN).count() == 0
