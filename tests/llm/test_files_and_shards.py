from __future__ import annotations

import json
import zlib
from itertools import accumulate

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm import ODD_TEXTS, documents

from acadmetric.llm.common import vocabulary_file
from acadmetric.llm.sharding import byte_shards, write_shards
from acadmetric.llm.token_files import Encoder, _place, qualified, read_token_files, write_token_files
from acadmetric.session import new_path

WORDS = vocabulary_file("word_bpe_49k.json")


def test_files_hold_the_ids_of_the_whole_texts(spark, odd):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(WORDS)
    order = sorted(ODD_TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    ids = [[*plain.encode(t or "", add_special_tokens=False).ids, 1] for _, t in order]
    starts = list(accumulate(map(len, ids), initial=0))
    want = [(i, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, _), s, x in zip(order, starts, ids, strict=False)]
    files = write_token_files(odd.repartition(5), new_path(spark, "tokens"), WORDS, 1)
    got = sorted(map(tuple, read_token_files(spark, files, WORDS).collect()), key=lambda r: r[1])
    assert got == want


def test_no_documents_make_no_rows(spark, empty):
    files = write_token_files(empty, new_path(spark, "tokens"), WORDS, 1)
    assert read_token_files(spark, files, WORDS).count() == 0


def test_pieces_are_the_tokenizers_own():
    texts = ["It's don't. İx J̌. x́y é! Fin×. … 12.5% a b <|endoftext|>! CAFÉ, café; ß ... ,a .b",
             json.dumps({"k": ["v", 1]}), "a\x1cb\x85c d", "Ωσς Σ. ŉ ǅ ŒŒ!!"]
    encoder = Encoder(WORDS)
    for text, raw in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(raw, encoder.dtype).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_shards_are_contiguous_gapless_and_equal(spark, many_ranges, odd, empty):
    rows = [(i, "x" * (i * 37 % 200)) for i in range(2000)]
    got = sorted(byte_shards(documents(spark, rows).repartition(6), 24).collect())
    total, before, shard = sum(r.size for r in got), 0, []
    for r in got:
        shard.append(min(23, (2 * before + r.size) * 24 // (2 * total)))
        before += r.size
    assert [r.shard for r in got] == shard and sorted(set(shard)) == list(range(24))
    assert [r.slot for r in got] == [i - shard.index(s) for i, s in enumerate(shard)]
    assert all(r.text_crc32 == zlib.crc32(b"x" * (r.doc_id * 37 % 200)) and r.size == r.doc_id * 37 % 200 + 8 for r in got)
    sums = np.bincount(shard, [r.size for r in got])
    assert np.abs(sums - total / 24).max() <= 208
    few = byte_shards(odd, 24).collect()
    assert len(few) == len(ODD_TEXTS) and {r.size for r in few if r.doc_id in (1, 2)} == {8}
    assert byte_shards(empty, 24).count() == 0


def test_written_shards_read_back(spark, odd, tmp_path):
    clashing = odd.withColumn("_row", F.lit("mine")).withColumn("_part", F.lit("mine")).withColumn("_bytes", F.lit("mine"))
    write_shards(clashing, 3, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {*clashing.columns, "given_shard", "given_slot"}
    own = back.select(*[F.col(f"given_{c}" if c in ("shard", "slot") else c).alias(c) for c in clashing.columns])
    assert own.exceptAll(clashing).count() == 0 and clashing.exceptAll(own).count() == 0
    placed = byte_shards(odd, 3).select("doc_id", "shard", "slot").collect()
    assert sorted(map(str, back.select("doc_id", "shard", "slot").collect())) == sorted(map(str, placed))


def test_folders_are_taken_as_spark_takes_them(spark):
    assert qualified(spark, "/a/b").startswith("file:/") and qualified(spark, "file:///a/b").startswith("file:/")
    assert _place(qualified(spark, "/a/b"))[1] == "/a/b"
    with pytest.raises(Exception, match="(?i)unrecognized"):
        _place("other://store/a")


@pytest.mark.parametrize("text", ["", " "])
def test_blank_texts_have_the_end_alone(text):
    assert Encoder.of(WORDS).encode([text.encode()]) == [b""]
