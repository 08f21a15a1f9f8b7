"""Token files: ids against the plain tokenizer, exact round trip, order, pruning."""
from __future__ import annotations

import glob
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from growthloom.llm import token_files
from growthloom.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, part string, ids int, at string, n string"


@pytest.fixture(scope="module")
def tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")


def plain(text, path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [2]


def texts():
    rng = random.Random(11)
    return [None, "", " \n\t ", "One two", "x" * 30_000, "word " * 20_000, "Ärger über 的 Σας ΣΑΣ naïve é é", "a<|endoftext|>b <|startoftext|>", "A<|EndOfText|> B", "Mixed CASE Words, IT'S", "it's we'll 12 34",
            *["\n".join("".join(rng.choice("abcé ſİ的 .,́  '") for _ in range(rng.randint(0, 60))) for _ in range(4)) for _ in range(40)]]


def lists(ids, counts):
    return [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])]


@pytest.mark.parametrize("split,lower", [(True, True), (True, False), (False, False)])
def test_runs_give_the_ids_of_the_whole_text(tokenizer, split, lower, monkeypatch):
    rows = texts()
    encode = token_files.Encoder(tokenizer, split, lower)
    assert lists(*encode(rows)) == [plain(t, tokenizer) for t in rows]
    monkeypatch.setattr(token_files, "AT_ONCE", 9)
    monkeypatch.setattr(token_files, "CACHE", 3)
    again = token_files.Encoder(tokenizer, split, lower)
    assert [lists(*again([t]))[0] for t in rows] == [plain(t, tokenizer) for t in rows]
    assert again([])[0].size == 0


def written(spark, frame, rows, tokenizer, **options):
    path = scratch_path(spark, "test-tokens")
    token_files.write(frame([(i, t, "x", 1, "y", "z") for i, t in rows], DOCS).repartition(3), path, tokenizer, **options)
    return path, token_files.read(spark, path)


def test_stream_against_plain_encoding(spark, frame, tokenizer):
    rows = list(enumerate(texts())) + [(-5, "first of all"), (7, "twice"), (7, "twice"), (7, "other"), (None, "no id")]
    _, files = written(spark, frame, rows, tokenizer, files=6)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_files.stream(files).collect() if r["doc_id"] is not None)
    ids = {t: plain(t, tokenizer) for _, t in rows}
    at, want = len(ids["no id"]), []
    places = sorted((r["start"], r["ids_crc32"]) for r in token_files.stream(files).where("doc_id = 7").collect())
    crc = {t: zlib.crc32(struct.pack(f"<{len(x)}I", *x)) for t, x in ids.items()}
    order = {c: k for k, (_, c) in enumerate(places)}  # rows of one id: by hash of the text
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], order.get(crc[r[1]], 0) if r[0] == 7 else 0)):
        want.append((at, i, len(ids[t]), crc[t]))
        at += len(ids[t])
    assert got == want


def test_files_ascend_hold_the_ids_and_prune(spark, frame, tokenizer):
    rng = random.Random(3)
    rows = [(i * 3, " ".join(rng.choice(["red", "green", "tree", "house"]) for _ in range(rng.randint(0, 9)))) for i in range(3000)]
    path, files = written(spark, frame, rows, tokenizer, files=5)
    back = {r["doc_id"]: r["ids"] for r in files.collect()}
    assert back == {i: x for (i, _), x in zip(rows, lists(*token_files.Encoder(tokenizer, False)([t for _, t in rows])))}
    ranges = sorted((r["part"], r["low"], r["high"]) for r in files.groupBy("part").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).collect())
    assert all(a[2] < b[1] for a, b in zip(ranges, ranges[1:])) and len(ranges) > 1
    one = files.where("doc_id = 300")
    assert [r["ids"] for r in one.collect()] == [back[300]] and files.where("doc_id = 301").count() == 0
    assert "EqualTo(doc_id,300)" in one._jdf.queryExecution().toString()
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    streams = set()
    for f in glob.glob(f"{path.removeprefix('file:')}/*.orc"):
        reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(f), jvm.org.apache.orc.OrcFile.readerOptions(conf))
        stripes = reader.getStripes()
        for k in range(stripes.size()):
            footer = reader.rows().readStripeFooter(stripes.get(k))
            streams |= {str(s.getKind()) for s in footer.getStreamsList()}
            streams |= {str(e.getKind()) for e in footer.getColumnsList()}
    assert {"ROW_INDEX", "BLOOM_FILTER_UTF8", "DIRECT_V2"} <= streams


def test_a_table_without_rows(spark, frame, tokenizer):
    _, files = written(spark, frame, [], tokenizer)
    assert token_files.stream(files).collect() == []


def test_query_against_plain_encoding(spark, sf, tokenizer):
    from growthloom.llm.queries import QUERIES

    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    ids = [np.array(x) for x in lists(*token_files.Encoder(tokenizer, False)([t for _, t in docs]))]
    starts = np.cumsum([0, *map(len, ids)])
    want = [(i, int(s), len(x), zlib.crc32(x.astype("<u4").tobytes())) for (i, _), s, x in zip(docs, starts, ids)]
    assert sorted(tuple(r) for r in QUERIES["op11_tokens"](spark, sf).collect()) == want
