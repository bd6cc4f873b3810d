"""Token ids in ORC files: written in ascending id order, read stripe by stripe.

Texts are encoded with a ``tokenizers`` file and get an end id; the ids are an
integer column that ORC stores run-length encoded. Files, stripes and row groups
follow the order of document ids, with row indexes and Bloom filters on the ids,
so that a lookup prunes by metadata and a scan reads stripes in parallel.

Byte-level pre-tokenisation never joins characters over a blank that stands
before a visible character, nor over a line break between visible ones. Texts
are therefore cut there, and the parts are numbered by array operations and encoded
by the library once per worker (a bounded cache, many parts in one call); a text with
blanks in other places, or with a special token, is encoded as a whole. Both ways give
the library's own ids for the whole text, which the tests compare.

Null or empty texts have the end id alone. Null ids come first; of equal ids the
rows follow the XXH64 of their texts. Repeated rows are kept. An empty table
writes an empty data set. Other columns play no part.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwell.llm.common import durable, text_of
from clipwell.llm.spans import Spans
from clipwell.operators.ordering import with_running_total

END_ID = 2
_CACHED_PARTS = 800_000
_JOINED = 128
_BATCH = 2048
SCHEMA = "doc_id bigint, text_xxh64 bigint, n_tokens bigint, ids array<int>"
NAMES, CHECKED = ["doc_id", "text_xxh64", "n_tokens", "ids"], ["doc_id", "text_xxh64", "n_tokens", "ids_crc32"]


class Encoder:
    """Ids of whole texts as little-endian 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        pre = self.model.pre_tokenizer
        added = [x.content for x in self.model.get_added_tokens_decoder().values()]
        self.by_parts = type(pre).__name__ == "ByteLevel" and not pre.add_prefix_space and self.model.normalizer is None
        self.by_parts &= not re.search(r"\s", "".join(added))
        # a token of a byte-level vocabulary has one character for each of its bytes
        self.token_bytes = np.zeros(self.model.get_vocab_size(), np.int64)
        for token, i in self.model.get_vocab(with_added_tokens=False).items():
            self.token_bytes[i] = len(token)
        # a blank of any kind behind the first byte, nothing behind it, or a special token
        blank = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
        self.odd = re.compile(b"|".join([b".(?:%s|$)" % b"|".join(re.escape(c.encode()) for c in blank), *(b".*" + re.escape(x.encode()) for x in added)]), re.DOTALL).match
        self.parts: dict[bytes, bytes | None] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<i4") for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, missing: list[bytes]) -> None:
        """Parts with a second blank at their begin, or a special token, have no ids of their own: their text goes another way."""
        plain = list(filterfalse(self.odd, missing))
        for at in range(0, len(plain), _JOINED):
            own = plain[at : at + _JOINED]
            # joined parts are cut where they were joined; the ids' bytes tell which part an id is from
            (ids,) = self._ids([b"".join(own).decode("utf-8")])
            ends = np.searchsorted(np.cumsum(self.token_bytes[ids]), np.cumsum([*map(len, own)]), side="left") + 1
            data, places = ids.tobytes(), (4 * ends).tolist()
            self.parts.update(zip(own, map(data.__getitem__, map(slice, [0, *places], places))))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, the ids of all texts in order)."""
        if not self.by_parts:
            found = self._ids([t.decode("utf-8") for t in texts])
            return np.array([len(x) for x in found], np.int64), np.concatenate([np.empty(0, "<i4"), *found])
        if len(self.parts) > _CACHED_PARTS:
            self.parts.clear()
        raw = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        begins = ends - [len(t) for t in texts]
        # a blank or a line break is the first character of a part; what comes before the first one is the text's head
        cut = (raw == 32) | (raw == 10)
        cut[begins[begins < len(raw)]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(raw))[: len(start)]
        spans, owner = Spans(raw, start, end), np.searchsorted(ends, start, side="right")
        joined, at = raw.tobytes(), spans.first
        distinct = list(map(joined.__getitem__, map(slice, start[at].tolist(), end[at].tolist())))
        blank = (raw[start[at]] == 32) | (raw[start[at]] == 10)
        heads = np.flatnonzero(~blank).tolist()
        missing = list(filterfalse(self.parts.__contains__, compress(distinct, blank.tolist())))
        if missing:
            self._learn(missing)
        found: list[bytes | None] = list(map(self.parts.get, distinct))
        head_texts = [distinct[i].decode("utf-8") for i in heads]
        for i, text, ids in zip(heads, head_texts, self._ids(head_texts)):
            # blanks of other kinds at a head's end would join what follows
            found[i] = ids.tobytes() if text == text.rstrip() else None
        code, whole = spans.code, np.empty(0, np.int64)
        if None in found:
            lost = np.array([x is None for x in found])
            whole = np.unique(owner[lost[code]])
        if len(whole):
            stay = ~np.isin(owner, whole)
            code = np.concatenate([code[stay], len(found) + np.arange(len(whole))])
            owner = np.concatenate([owner[stay], whole])
            found += [x.tobytes() for x in self._ids([texts[i].decode("utf-8") for i in whole.tolist()])]
            order = np.argsort(owner, kind="stable")
            code, owner = code[order], owner[order]
        if len(whole):
            found = [x or b"" for x in found]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<i4")
        listed = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(ids))
        return np.bincount(owner, size[code], len(texts)).astype(np.int64), listed.take(pa.array(code)).flatten().to_numpy()


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _rows(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                g = batch.slice(at, _BATCH)
                sizes, found = _encoder(path).encode(g.column("text").to_pylist())
                sizes += 1
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                ids = np.full(offsets[-1], end_id, np.int32)
                ids[np.arange(len(found)) + np.repeat(np.arange(len(sizes)), sizes - 1)] = found
                listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_arrays([g.column("doc_id"), g.column("text_xxh64"), pa.array(sizes), listed], names=NAMES)

    return run


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, key: str = "doc_id", text: str = "text",
    stripe_bytes: int = 16 << 20, index_stride: int = 1000,
) -> None:
    """Encode all texts and write the ORC files; ``tokenizer`` is a path that every worker can read."""
    t = text_of(f"`{text}`")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.xxhash64(t).alias("text_xxh64"), F.make_valid_utf8(t).cast("binary").alias("text"))
    encoded = rows.orderBy("doc_id", "text_xxh64").mapInArrow(_rows(tokenizer, end_id), SCHEMA)
    (
        encoded.write.mode("overwrite")
        .option("orc.stripe.size", str(stripe_bytes))
        .option("orc.row.index.stride", str(index_stride))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("compression", "snappy")
        .orc(folder)
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(folder)


def lookup(spark: SparkSession, folder: str, ids: list[int]) -> DataFrame:
    """Rows of the given documents; min/max statistics and Bloom filters skip the other stripes and row groups."""
    return read_tokens(spark, folder).where(F.col("doc_id").isin(*ids))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("ids")
        at, values = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4", copy=False)
        crc = np.fromiter((zlib.crc32(values[i:j]) for i, j in zip(at, at[1:])), np.int64, b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_xxh64"), pa.array(np.diff(at).astype(np.int64)), pa.array(crc)], names=CHECKED)


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    # read from the files; the narrow rows are put in file order again and summed by partition
    rows = read_tokens(spark, folder).select("doc_id", "text_xxh64", "ids")
    narrow = durable(rows.mapInArrow(_checksums, "doc_id bigint, text_xxh64 bigint, n_tokens bigint, ids_crc32 bigint"))
    run = with_running_total(narrow, ["doc_id", "text_xxh64"], "n_tokens", "end")
    return run.select("doc_id", (F.col("end") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")
