from __future__ import annotations

import zlib

import numpy as np
import pyarrow.fs as pafs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forumlens.llm import token_files
from forumlens.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return token_files.Encoder(tokenizer_path())


def expected(tokenizer, rows):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((-1 if doc_id is None else doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def read_back(spark, docs, folder):
    token_files.write_tokens(docs, folder, tokenizer_path())
    return sorted(tuple(r) for r in token_files.read_tokens(spark, folder).collect())


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_pieces_give_the_ids_of_the_text(tokenizer, encoder, text):
    want = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
    assert np.frombuffer(encoder(text), encoder.kind).tolist() == want


@pytest.mark.parametrize("text", ["  a  b \n\n c", "it's we'll 12,345 ***%%% ñandú", "a<|endoftext|>b", "\x1c a\x85b", "日本語 text", "a" * 3000])
def test_texts_of_many_kinds(tokenizer, encoder, text):
    assert np.frombuffer(encoder(text), encoder.kind).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_memory_of_pieces_is_bounded(tokenizer, encoder, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE", 10)
    for k in range(5):
        text = " ".join(f"w{k}{i}" for i in range(30))
        assert np.frombuffer(encoder(text), encoder.kind).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_round_trip(spark, sample, tokenizer, tmp_path):
    docs = spark.read.parquet(f"{sample}/documents.parquet").repartition(5)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert read_back(spark, docs, str(tmp_path / "t")) == expected(tokenizer, rows)


def test_odd_rows(spark, make_docs, tokenizer, tmp_path):
    rows = [(3, None), (1, ""), (2, "x" * 200_000), (2, "b"), (2, "b"), (None, "no id"), (7, "end")]
    docs = make_docs(*rows).withColumn("part", F.lit(1)).withColumn("file", F.lit("x"))
    assert read_back(spark, docs, str(tmp_path / "t")) == sorted(expected(tokenizer, rows))


def test_no_rows(spark, make_docs, tmp_path):
    assert read_back(spark, make_docs((1, "a")).where("false"), str(tmp_path / "t")) == []


def test_damage_is_an_error(spark, make_docs, tmp_path):
    folder = str(tmp_path / "t")
    token_files.write_tokens(make_docs((1, "some text"), (2, "more")), folder, tokenizer_path())
    for info in pafs.LocalFileSystem().get_file_info(pafs.FileSelector(folder)):
        if info.path.endswith(".bin"):
            with open(info.path, "ab") as f:
                f.write(b"\0\0")
    with pytest.raises(Exception, match="damaged part"):
        token_files.read_tokens(spark, folder).collect()
