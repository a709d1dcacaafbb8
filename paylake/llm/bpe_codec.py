"""Byte-level BPE encoding and decoding with the tokenizers library.

A rank file becomes a ``tokenizers`` BPE model: each token is written with one
printable character per byte, and its merge is the last one that happens when
its own bytes are merged by the lower ranks.  Encoding cuts pieces
(``pieces.split_batch``) and encodes each piece not seen before with the
library, in batches; decoding maps ids back to bytes through the reversed byte
table.  A token may hold only a part of a character: ``decode_parts`` holds the
bytes of an unfinished character back until the rest has come.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from . import common
from .pieces import TokenIds, byte_characters, token_bytes


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a file of lines ``base64 rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) }


def last_merge(word: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that ``word`` is made of, or None for a single byte or a
    word that lower ranks cannot build."""
    parts = [word[i:i + 1] for i in range(len(word))]
    top = ranks[word]
    while len(parts) > 2:
        steps = [ranks.get(a + b, top) for a, b in zip(parts, parts[1:])]
        low = min(steps)
        if low >= top:
            return None
        k = steps.index(low)
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """A tokenizers BPE model equal to the rank file, as JSON text."""
    table = byte_characters()
    written = lambda w: "".join(table[b] for b in w)
    merges = [m for w in sorted(ranks, key=ranks.__getitem__) if (m := last_merge(w, ranks))]
    model = models.BPE(vocab={written(w): r for w, r in ranks.items()},
                       merges=[(written(a), written(b)) for a, b in merges], ignore_merges=True)
    return Tokenizer(model).to_str()


class Codec:
    """Encoder and decoder of one vocabulary, kept while the worker lives."""

    def __init__(self, model: str):
        tokenizer = Tokenizer.from_str(model)
        self.memo = TokenIds(tokenizer)
        by_id = token_bytes(tokenizer.get_vocab())
        self.bytes = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(data, "<u4") for data in self.memo.values(texts)]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def offsets(self, text: str, ids: np.ndarray) -> list[tuple[int, int]]:
        """Span of each token in code points, end exclusive; a token that holds
        a part of a character spans the whole character."""
        first = np.cumsum([1] + [(b & 0xC0) != 0x80 for b in text.encode()[1:]]) - 1 if text else []
        out, at = [], 0
        for i in ids.tolist():
            n = len(self.bytes[i])
            out.append((int(first[at]), int(first[at + n - 1]) + 1))
            at += n
        return out

    def decode_parts(self, ids: Iterable[int]) -> Iterator[str]:
        """The text of each token as far as its characters are complete; what
        is unfinished at the end comes as replacement characters."""
        reader = codecs.getincrementaldecoder("utf-8")(errors="replace")
        for i in ids:
            yield reader.decode(self.bytes[i])
        yield reader.decode(b"", final=True)


_CODECS: dict[int, Codec] = {}


def _codec(model: str) -> Codec:
    key = hash(model)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def encode(docs: DataFrame, ranks_path: str, offsets: bool = False, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Ids of every whole text: doc_id, ids (array of int) and, if asked for,
    starts and ends (code points, end exclusive) of each token.

    Special tokens are not recognised.  Null and empty texts have no ids.  Rows
    with equal ids each give a row.  One pass, no shuffle; the vocabulary is
    broadcast (its size is the file's).
    """
    spark = docs.sparkSession
    common.ship(spark)
    model = spark.sparkContext.broadcast(tokenizer_json(read_ranks(ranks_path)))
    fields = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))]
    if offsets:
        fields += [("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))]
    schema = pa.schema(fields)

    def run(batches):
        codec = _codec(model.value)
        for b in common.row_slices(batches, limit=2 << 20):
            texts = b.column("text").to_pylist()
            ids = codec.encode(texts)
            more = {}
            if offsets:
                spans = [codec.offsets(t, i) for t, i in zip(texts, ids)]
                more = {"starts": [[a for a, _ in s] for s in spans],
                        "ends": [[e for _, e in s] for s in spans]}
            yield common.table_batch(schema, doc_id=b.column("doc_id"), ids=_lists(ids), **more)

    ddl = "doc_id long, ids array<int>" + ", starts array<int>, ends array<int>" * offsets
    return common.texts(docs, id_col, text_col).mapInArrow(run, ddl)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, "<u4"), *arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat))


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Bytes and text of every id list: doc_id, data (binary), text (bytes that
    are no valid UTF-8 become replacement characters).  Null lists count as
    empty; an id outside the vocabulary is an error."""
    spark = encoded.sparkSession
    common.ship(spark)
    model = spark.sparkContext.broadcast(tokenizer_json(read_ranks(ranks_path)))
    schema = pa.schema([("doc_id", pa.int64()), ("data", pa.binary()), ("text", pa.string())])

    def run(batches):
        codec = _codec(model.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                data = [codec.decode(i or []) for i in b.column("ids").to_pylist()]
                yield common.table_batch(schema, doc_id=b.column("doc_id"), data=data,
                                         text=[d.decode("utf-8", "replace") for d in data])

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, data binary, text string")


def codec_digests(docs: DataFrame, ranks_path: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Encode and decode every whole text and return digests of both ways:
    doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit
    integers), decoded_sha256 (decoded bytes).  Handles rows as ``encode``."""
    spark = docs.sparkSession
    common.ship(spark)
    model = spark.sparkContext.broadcast(tokenizer_json(read_ranks(ranks_path)))
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    digest = lambda data: hashlib.sha256(data).hexdigest()

    def run(batches):
        codec = _codec(model.value)
        for b in common.row_slices(batches):
            ids = codec.encode(b.column("text").to_pylist())
            yield common.table_batch(schema, doc_id=b.column("doc_id"),
                                     n_tokens=[len(i) for i in ids],
                                     ids_sha256=[digest(i.tobytes()) for i in ids],
                                     decoded_sha256=[digest(codec.decode(i.tolist())) for i in ids])

    return common.texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
