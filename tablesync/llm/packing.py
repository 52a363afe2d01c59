"""Packing by power-of-two decomposition.

A document of n tokens is cut into whole pieces of ``most`` tokens and one piece for each bit of the rest,
longest first. A piece is a sequence of its own: its length is a power of two, so it needs no padding and
no sequence crosses documents. ``bucket`` is the length's exponent; batches are formed inside a bucket
(``write_buckets`` lays the pieces out so).

Tokens are those of a whole text. The vocabulary's pre-tokenizer never joins across white space, so a text
is encoded word by word, and each worker keeps the ids of words it has met, ``keep`` of them before it
begins anew, and works on ``batch`` bytes of text at a time; neither changes the pieces.

Nulls and empties: a null or empty text is the end token alone. A null id is kept; rows that repeat id or
text are documents of their own. Empty input gives no pieces. Other columns are left out.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.words import Words

KEEP = 1 << 20
AT_ONCE = 1 << 13
BATCH = 6 << 20
END_ID = 2
MOST = 4096
#: Bits of a place for a document's pieces (a text has less than 2 GB), and for a file's rows; 23 are left for files.
PIECES, ROWS = 20, 20


class _Encoder:
    """Token ids of words (no white space inside), kept by fingerprint."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.place: dict[int, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def places(self, w: Words, keep: int) -> np.ndarray:
        """For each word, where its ids are kept."""
        if len(self.place) > keep:
            self.clear()
        own, first, back = np.unique(w.hashes(lower=False), return_index=True, return_inverse=True)
        at = np.array([self.place.get(h, -1) for h in own.tolist()], np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            texts = [w.data[w.start[i] : w.end[i]].tobytes().decode("utf-8", "replace") for i in first[new]]
            encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
            got = [e.ids for lo in range(0, len(texts), AT_ONCE) for e in encode(texts[lo : lo + AT_ONCE], add_special_tokens=False)]
            size = np.array([len(x) for x in got], np.int64)
            begin = len(self.ids) + np.cumsum(size) - size
            at[new] = len(self.begin) + np.arange(len(new))
            self.ids = np.concatenate((self.ids, np.fromiter((i for x in got for i in x), np.uint32, int(size.sum()))))
            self.begin, self.size = np.concatenate((self.begin, begin)), np.concatenate((self.size, size))
            self.place.update(zip(own[new].tolist(), at[new].tolist()))
        return at[back]

    def encode(self, texts: list[bytes | None], keep: int) -> list[np.ndarray]:
        w = Words(texts)
        at = self.places(w, keep)
        size = self.size[at]
        over = np.concatenate(([0], np.cumsum(size)))
        flat = self.ids[np.repeat(self.begin[at] - over[:-1], size) + np.arange(over[-1])] if len(at) else np.zeros(0, np.uint32)
        cut = over[w.first]
        return [flat[a:b] for a, b in zip(cut[:-1], cut[1:])]


@lru_cache(2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def lengths(n: int, most: int = MOST) -> list[int]:
    """The pieces of n tokens; ``most`` is a power of two."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _pieces(path: str, most: int, end: int, with_ids: bool, keep: int, batch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path)

        def out(ids: list, places: list, texts: list) -> pa.RecordBatch:
            doc, start, length, crc, total, seq, own = [], [], [], [], [], [], []
            for i, p, t in zip(ids, places, enc.encode(texts, keep)):
                t = np.append(t, np.uint32(end)).astype("<u4")
                at = 0
                for k, n in enumerate(lengths(len(t), most)):
                    doc.append(i)
                    seq.append(None if p is None else (p << PIECES) + k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(t[at : at + n].tobytes()))
                    total.append(len(t))
                    if with_ids:
                        own.append(t[at : at + n].astype(np.int32))
                    at += n
            cols = [pa.array(x, pa.int64()) for x in (doc, start, length, crc, total, seq)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place"]
            if with_ids:
                cols.append(pa.array(own, pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(cols, names=names)

        ids, places, texts, size = [], [], [], 0
        for b in batches:
            for i, t, p in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist()):
                ids.append(i)
                places.append(p)
                texts.append(t)
                size += len(t or b"")
                if size >= batch:
                    yield out(ids, places, texts)
                    ids, places, texts, size = [], [], [], 0
        if ids:
            yield out(ids, places, texts)

    return run


def written_place(docs: DataFrame) -> Column | None:
    """A row's place in the order in which Spark wrote the table: part number and row; None for other tables.

    More than 2**23 files, or 2**20 rows in one, raise."""
    parts = [re.search(r"/part-(\d+)-[^/]*$", f) for f in docs.inputFiles()]
    if not parts or None in parts or len({int(m[1]) for m in parts}) < len(parts):
        return None
    if max(int(m[1]) for m in parts) >> 63 - PIECES - ROWS:
        raise ValueError(f"more than 2**{63 - PIECES - ROWS} files")
    meta = docs.metadataColumn("_metadata")
    row = F.when(meta["row_index"] < 1 << ROWS, meta["row_index"]).otherwise(F.raise_error(F.lit(f"more than 2**{ROWS} rows in a file")))
    try:
        docs.select(meta["row_index"])
    except AnalysisException:
        return None
    return F.regexp_extract(meta["file_name"], r"part-(\d+)-", 1).cast("long") * (1 << ROWS) + row


def pack(docs: DataFrame, tokenizer: str, most: int = MOST, end: int = END_ID, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True, keep: int = KEEP, batch: int = BATCH, place: Column | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids], bucket, sequence_id, offset): a row for each piece.

    ``tokenizer`` is the path of a vocabulary file, the same on every machine. Sequence ids are unique, not
    dense: a partition's number and a place in it, or, with ``place`` (a unique long), in its order.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, place long" + ", ids array<int>" * with_ids
    cut = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), (F.lit(None) if place is None else place).cast("long").alias("place")).mapInArrow(_pieces(tokenizer, most, end, with_ids, keep, batch), schema)
    return cut.withColumns({"bucket": F.log2("length").cast("int"), "sequence_id": F.monotonically_increasing_id() if place is None else F.col("place"), "offset": F.lit(0).cast("long")}).drop("place")


def write_buckets(pieces: DataFrame, path: str) -> None:
    """A folder for each length, from which batches of equal sequences are read."""
    pieces.write.partitionBy("bucket").parquet(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, default_tokenizer(), with_ids=False)


QUERIES = {"op8_pack_documents": op8_pack_documents}
ORACLES: dict[str, str] = {}
