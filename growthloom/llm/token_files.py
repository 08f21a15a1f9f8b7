"""Token ids in ORC files: integer run-length coded lists, row indexes and Bloom filters on document ids.

Documents are dealt out by ranges of doc_id, so files and the stripes in them ascend and their minimum and maximum prune whole
files, stripes and row groups; a Bloom filter per row group prunes look-ups of single ids. Stripes are small enough that several
tasks read one file. Every row carries the tokens before it in its file (`at`), so a document's place in the whole stream is
known once the files' totals are summed, one number per file.
"""
from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

END = 2  # id appended to every document
AT_ONCE = 500_000  # characters of texts, or of new runs, encoded at once
CACHE = 1_000_000  # runs whose ids a worker remembers, the first ones it meets
STRIPE = 16 << 20  # bytes of a stripe
ROW_GROUP = 1_000  # rows of an index entry and of a Bloom filter
FALSE_HITS = 0.01  # of a Bloom filter
OPTIONS = {"orc.stripe.size": str(STRIPE), "orc.row.index.stride": str(ROW_GROUP), "orc.create.index": "true",
           "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": str(FALSE_HITS), "orc.compress": "ZSTD"}
FILE = "part int, doc_id long, at long, n int, ids array<int>"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use all cores
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _encoder(path: str, split: bool, lower: bool) -> Encoder:
    """The worker's encoder: what one task has learned serves the next one."""
    return Encoder(path, split, lower)


class Encoder:
    """Ids of texts, END behind each; null counts as empty.

    With `split`, for tokenizers that cut at white space and drop it, the ids of a text are those of its runs without ASCII white
    space, and a run that came before is not encoded again. With `lower`, for tokenizers that lower-case, A-Z are lower-cased
    first, except in texts that may hold the name of a special token. Without `split` every text is encoded whole.
    """

    def __init__(self, path: str, split: bool = True, lower: bool = False):
        self.tokenizer, self.split, self.lower = _tokenizer(path), split, lower
        self.forget()

    def forget(self) -> None:
        self.rows: dict[bytes, int] = {}  # run -> its row in `starts`; row 0 is END
        self.starts, self.flat = np.zeros(1 << 16, dtype=np.int64), np.full(1 << 17, END, dtype=np.int32)
        self.starts[1] = 1

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        return array if size <= len(array) else np.concatenate([array, np.empty(max(size, 2 * len(array)) - len(array), dtype=array.dtype)])

    def _learn(self, new: list[bytes]) -> None:
        low, row = 0, len(self.rows) + 1
        self.starts = self._room(self.starts, row + len(new) + 1)
        self.rows.update(zip(new, range(row, row + len(new))))
        texts = [x.decode() for x in new]
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size + len(texts[high]) <= AT_ONCE):
                size += len(texts[high])
                high += 1
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts[low:high], add_special_tokens=False)]
            begin, count = int(self.starts[row]), len(found)
            self.starts[row + 1 : row + 1 + count] = begin + np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=count))
            end = int(self.starts[row + count])
            self.flat = self._room(self.flat, end)
            self.flat[begin:end] = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=end - begin)
            low, row = high, row + count

    def _runs(self, text: str | None) -> list[bytes]:
        if not text:
            return []
        data = text.encode()
        if not self.split:
            return [data]
        return (data.lower() if self.lower and b"<|" not in data else data).split()  # as bytes: A-Z and ASCII white space only

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one behind the other, and how many each text has."""
        if not self.split:
            self.forget()
        kept = len(self.rows)
        runs = [self._runs(t) for t in texts]
        many = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs)) + 1
        words = list(chain.from_iterable(runs))
        places = np.fromiter(map(self.rows.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(places < 0)
        if len(missing):
            new = [words[i] for i in missing]
            self._learn(list(dict.fromkeys(new)))
            places[missing] = np.fromiter(map(self.rows.__getitem__, new), dtype=np.int64, count=len(new))
        at = np.zeros(int(many.sum()), dtype=np.int64)
        own = np.ones(len(at), dtype=bool)
        own[np.cumsum(many) - 1] = False  # the places of END
        at[own] = places
        lengths = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(lengths)
        ids = self.flat[np.repeat(self.starts[at] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        if kept >= CACHE:  # what is new now is rare: it served this call
            for _ in range(len(self.rows) - kept):
                self.rows.popitem()  # the last one added
        return ids, np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(many)])])


def write(docs: DataFrame, path: str, tokenizer: str, split: bool = True, lower: bool = False, files: int | None = None) -> None:
    """Write the ids of (doc_id, text) as ORC files, ascending by doc_id over files and rows: `files` of them, or as Spark sees fit.

    Null ids come first; equal ids are ordered by a hash of their texts, equal rows lie anywhere among each other and may be
    split over files, so no repeated row burdens a task. Other columns are not looked at. No rows give files without rows.
    """
    tie = F.xxhash64("text")
    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumns({"__hash": tie, "__spread": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first("doc_id"), "__hash", "__spread"]
    ranged = rows.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, encode = TaskContext.get().partitionId(), 0, _encoder(tokenizer, split, lower)
        for batch in batches:
            low, size = 0, 0
            lengths = pc.fill_null(pc.utf8_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
            for high in range(1, batch.num_rows + 1):
                size += int(lengths[high - 1])
                if size < AT_ONCE and high < batch.num_rows:
                    continue
                ids, counts = encode(batch["text"].slice(low, high - low).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(counts), part, dtype=np.int32)), batch["doc_id"].slice(low, high - low), pa.array(np.cumsum(counts) - counts + at),
                     pa.array(counts.astype(np.int32)), lists],
                    names=["part", "doc_id", "at", "n", "ids"])
                at += int(counts.sum())
                low, size = high, 0

    ranged.mapInArrow(run, FILE).write.options(**OPTIONS).mode("errorifexists").orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(part, doc_id, at, n, ids) of the files, n the number of ids. Filters on doc_id reach the files' statistics and Bloom filters."""
    return spark.read.schema(FILE).orc(path)


def starts(files: DataFrame) -> DataFrame:
    """(part, first): ids in the files before each one. One row per file; the lists are not read."""
    ends = files.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("total"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return ends.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("first"))


def digest(files: DataFrame) -> DataFrame:
    """(part, doc_id, at, n_tokens, ids_crc32) of rows read back: CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["ids"]
            bounds = lists.offsets.to_numpy()
            data = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch["part"], batch["doc_id"], batch["at"], pa.array(np.diff(bounds).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["part", "doc_id", "at", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")


def stream(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of the files."""
    rows = digest(files)
    # One row per file on the right: bounded by the number of tasks that wrote.
    return rows.join(F.broadcast(starts(files)), "part").select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
