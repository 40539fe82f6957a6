"""Byte-level BPE with a sentencepiece model made from a rank file.

The model is serialised directly (no training): one piece per vocabulary
entry, its bytes mapped to printable characters, scored by negative rank,
identity normalisation. sentencepiece merges the best-scored adjacent pair,
leftmost first, which is the lowest-rank merge rule of the rank file, so each
pre-token gets the ids the rank file's own library gives. Decoding maps ids
back to pieces and characters back to bytes.

Texts are split by the public pattern into pre-tokens; each task keeps the ids
of recent pre-tokens (a bounded cache), so a frequent word is encoded once per
task.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import NOT_PLAIN, PLAIN_LETTERS, pick
from candlewick.llm.workers import release_memory
from candlewick.session import ship_package

CACHE_WORDS = 100_000
LONGEST_CACHED = 64
STEP_ROWS = 128
FIRST_CHAR = 0x100  # byte b is written as chr(0x100 + b)
BYTE_CHARS = "".join(chr(FIRST_CHAR + b) for b in range(256))
#: The public pattern restricted to plain texts (see ``common.NOT_PLAIN``), for
#: Python's faster engine; other texts are split by the pattern itself.
PLAIN_SPLIT = (
    rf" ?[{PLAIN_LETTERS}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\t-\r {PLAIN_LETTERS}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> list[bytes]:
    """The pieces of a rank file in rank order."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(rank): base64.b64decode(piece) for piece, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ... without a gap")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while True:
        n, low = n >> 7, n & 127
        out.append(low | (128 if n else 0))
        if not n:
            return bytes(out)


def _field(number: int, payload: bytes) -> bytes:
    """A length-delimited protobuf field."""
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def mapped(piece: bytes) -> str:
    return codecs.charmap_decode(piece, "strict", BYTE_CHARS)[0]


def model_bytes(pieces: list[bytes]) -> bytes:
    """The serialised sentencepiece model: pieces in rank order (so a piece's
    id is its rank), then the unknown piece the format demands (never used:
    every byte is a piece)."""
    if {p for p in pieces if len(p) == 1} != {bytes([b]) for b in range(256)}:
        raise ValueError("every single byte must be a piece")
    out = []
    for rank, piece in enumerate(pieces):
        out.append(_field(1, _field(1, mapped(piece).encode()) + b"\x15" + struct.pack("<f", -float(rank))))
    out.append(_field(1, _field(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, 2)))  # type 2: unknown
    trainer = _number(3, 2) + _number(4, len(pieces) + 1)  # model type 2: BPE; vocabulary size
    trainer += _number(40, len(pieces)) + b"".join(_varint(n << 3) + b"\xff" * 9 + b"\x01" for n in (41, 42, 43))  # unk id; no bos, eos, pad
    normal = _field(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)  # no dummy prefix, no space changes
    return b"".join(out) + _field(2, trainer) + _field(3, normal)


class Codec:
    """Encoder and decoder of one worker process.

    ``encode_many`` takes a few texts at once: the pre-tokens that the bounded
    cache does not hold are encoded in one call of the library.
    """

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.pieces = read_ranks(path)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.pieces))
        self.split = regex.compile(pattern).findall
        plain = re.compile(PLAIN_SPLIT).findall if pattern == default_pattern() else self.split
        self.split_plain, self.not_plain = plain, re.compile(NOT_PLAIN).search
        back = {chr(FIRST_CHAR + b): bytes([b]) for b in range(256)}
        self.bytes_of = [b"".join(back[c] for c in self.processor.id_to_piece(i)) for i in range(len(self.pieces))]
        self.ids_of: dict[str, list[int]] = {}
        self.told: dict[str, str] = {}

    def pretokens(self, text: str) -> list[str]:
        return self.split(text) if self.not_plain(text) else self.split_plain(text)

    def learn(self, words: set[str]) -> None:
        new = list(words)
        for word, ids in zip(new, self.processor.encode([mapped(w.encode()) for w in new], num_threads=1)):
            self.ids_of[word] = ids
            self.told[word] = " ".join(map(str, ids))

    def encode_many(self, texts: list[str]) -> Iterator[tuple[list[int], str]]:
        """Ids of each text, and the ids as text."""
        split = [self.pretokens(t) for t in texts]
        if len(self.ids_of) > CACHE_WORDS:
            self.ids_of.clear()
            self.told.clear()
        new = set().union(*split) - self.ids_of.keys()
        if new:
            self.learn(new)
        for words in split:
            yield list(chain.from_iterable(map(self.ids_of.__getitem__, words))), " ".join(map(self.told.__getitem__, words))
        for word in new:
            if len(word) > LONGEST_CACHED:
                del self.ids_of[word], self.told[word]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    pattern: str | None = None,
    ids: bool = True,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_tokens, ids`` (array of int),
    ``ids_sha256`` (of the decimal ids joined by one space) and
    ``decoded_sha256`` (of the bytes decoded from the ids). ``ids=False``
    leaves the arrays out.

    A null text counts as empty: no ids, and both digests are those of nothing.
    Whole texts are encoded however long they are; extra columns are ignored,
    whatever their names; an empty table gives an empty result. Rows are independent (repeated rows give repeated results, a null id stays
    null); the map needs no shuffle. The vocabulary file must exist at the
    same path on every executor (as the installed package of public
    tokenizers does).
    """
    path, pat = vocabulary or default_vocabulary(), pattern or default_pattern()
    ship_package(docs.sparkSession)
    small = pick(docs, id_col, text_col).toDF("doc_id", "text")
    id_type = small.schema["doc_id"].dataType
    fields = [
        T.StructField("doc_id", id_type),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pat)
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):  # bounds what a step holds
                part = batch.slice(start, STEP_ROWS)
                texts = [t or "" for t in part.column("text").to_pylist()]
                done = {}  # equal texts near each other (copies that a mix takes) are encoded once
                kinds = list(dict.fromkeys(texts))
                for text, (got, as_text) in zip(kinds, tool.encode_many(kinds)):
                    done[text] = (len(got), hashlib.sha256(as_text.encode()).hexdigest(), hashlib.sha256(tool.decode(got)).hexdigest(), got if ids else None)
                n, told, plain, lists = zip(*map(done.__getitem__, texts))
                cols = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(told, pa.string()), pa.array(plain, pa.string())]
                if ids:
                    cols.append(pa.array(lists, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])
        release_memory()

    return small.mapInArrow(run, T.StructType(fields))


def decode_documents(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``doc_id, decoded`` (binary) from arrays of ids; null ids decode to
    nothing."""
    path, pat = vocabulary or default_vocabulary(), default_pattern()
    ship_package(encoded.sparkSession)
    small = pick(encoded, id_col, ids_col).toDF("doc_id", "ids")
    schema = T.StructType([T.StructField("doc_id", small.schema["doc_id"].dataType), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pat)
        for batch in batches:
            out = [tool.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "decoded"])

    return small.mapInArrow(run, schema)
