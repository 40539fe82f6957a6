"""Token ids in ORC, written in document order and read back by stripe.

Documents are range-partitioned by id, encoded in order and written as one ORC
file per range: ids as arrays (integer run-length encoding), a row index every
``row_stride`` rows and a Bloom filter on the document id, stripes of
``stripe_mb``. Readers split files by stripe; a lookup of a few documents skips
stripes and row groups by min/max and Bloom filter.

Each row stores its file's number and how many ids lie before it in its file;
adding the totals of the earlier files (one number per file) gives the
position of any document in the whole stream.
"""

from __future__ import annotations

import codecs
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import pick
from candlewick.session import scratch_folder, ship_package

END_ID = 1
CACHE_WORDS = 500_000
LONGEST_CACHED = 64
STEP_BYTES = 4 << 20
TOTALS = "_totals"  # folder of the files' totals: Spark's readers pass over names that start so

def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_chars() -> str:
    """The usual byte-level alphabet: printable Latin-1 characters stand for
    themselves, the other bytes for the characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in shown else chr(next(rest)) for b in range(256))


#: Kinds of bytes in plain texts (see ``WordEncoder``).
SPACE, LETTER, DIGIT, OTHER, HIGH = range(5)


def byte_kinds() -> np.ndarray:
    kinds = np.full(256, OTHER, np.uint8)
    kinds[[*range(9, 14), 32]] = SPACE
    kinds[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = LETTER
    kinds[ord("0") : ord("9") + 1] = DIGIT
    kinds[0x80:] = HIGH
    return kinds


def cut_words(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts laid end to end (``starts``: where each begins), as the
    tokenizer's own pattern cuts them: runs of letters, single digits, English
    endings (``'s``, ``'re``, ...) where no other sign stands before, and runs of
    any other signs; white space is dropped.

    Returns the lower-cased bytes without white space, where words begin in
    them, and which texts are not plain (they hold another character than ASCII
    and Latin-1 letters; their words mean nothing)."""
    kinds = byte_kinds()[raw]
    high = np.flatnonzero(kinds == HIGH)
    low = raw | np.where((raw >= 65) & (raw <= 90), 32, 0).astype(np.uint8)
    odd = np.empty(0, np.int64)
    if len(high):
        lead, tail = raw[high] == 0xC3, raw[np.maximum(high - 1, 0)] == 0xC3
        sign = (raw[high] == 0x97) | (raw[high] == 0xB7)
        odd = high[~lead & ~(tail & (high > 0) & ~sign)]
        kinds[high] = LETTER
        capital = high[tail & (raw[high] < 0x9F)]
        low[capital] = raw[capital] + 32
    first = np.zeros(len(raw) + 1, bool)  # a word may begin here
    first[1:-1] = kinds[1:] != kinds[:-1]
    first[:-1] |= kinds == DIGIT
    first[starts] = True
    # endings: at an apostrophe that begins a run of signs
    marks = np.flatnonzero((raw == 39) & first[:-1])
    if len(marks):
        limit = np.append(starts[1:], len(raw))[np.searchsorted(starts, marks, side="right") - 1]
        ahead = [np.where(marks + k < limit, low[np.minimum(marks + k, len(raw) - 1)], 0) for k in (1, 2)]
        one = np.isin(ahead[0], np.frombuffer(b"stmd", np.uint8))
        two = np.isin(ahead[0].astype(np.int64) << 8 | ahead[1], [int.from_bytes(e, "big") for e in (b"re", b"ve", b"ll")])
        for end, length in ((one, 2), (two, 3)):
            at = marks[end]
            first[at + 1] = False
            first[at + length] = True
    bare = kinds != SPACE
    where = np.cumsum(bare) - 1
    begins = np.flatnonzero(first[:-1] & bare)
    return low[bare], where[begins], np.unique(np.searchsorted(starts, odd, side="right") - 1)


def _values(column: pa.Array) -> list[bytes]:
    """The values of a binary array without offset or nulls (several times as
    fast as ``to_pylist``)."""
    at, data = np.frombuffer(column.buffers()[1], np.int32)[: len(column) + 1].tolist(), column.buffers()[2].to_pybytes()
    return [data[a:b] for a, b in zip(at, at[1:])]


class WordEncoder:
    """The library's tokenizer with a bounded cache of words.

    The normaliser of this vocabulary treats each character by itself and
    drops white space, and its words never cross white space. A plain text
    (ASCII and Latin-1 letters only, so it is already composed) is lower-cased
    and cut here, by array operations over many texts; their distinct words are
    looked up once, and unknown ones go to the library's BPE model together. Any
    other text, and any that holds the content of an added token (such as
    ``<|endoftext|>``, one id of its own), goes through the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        added = self.whole.get_added_tokens_decoder().values()
        forms = [f"(?i:{re.escape(t.content)})" if t.normalized else re.escape(t.content) for t in added]
        self.holds_added = re.compile("|".join(forms) or "(?!)").search
        self.words = Tokenizer(self.whole.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.words.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.chars = byte_chars()
        self.forget()

    def forget(self) -> None:
        """Words in the order learned: their place, and their ids end to end."""
        self.known: dict[bytes, int] = {}
        self.ids = np.empty(1 << 16, np.int32)
        self.cuts = np.zeros(1 << 16, np.int64)  # word w has ids[cuts[w]:cuts[w + 1]]

    def learn(self, new: list[bytes]) -> None:
        for start in range(0, len(new), 500):
            some = new[start : start + 500]
            line = " ".join(codecs.charmap_decode(w, "strict", self.chars)[0] for w in some)
            ids = np.array(self.words.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self.ends[ids]) + 1  # each word's last token has the end mark
            if len(ends) != len(some):
                raise ValueError("the vocabulary has no word-end form of some byte")
            n, at = len(self.known), int(self.cuts[len(self.known)])
            while n + len(some) >= len(self.cuts):
                self.cuts = np.append(self.cuts, np.zeros(len(self.cuts), np.int64))
            while at + len(ids) > len(self.ids):
                self.ids = np.append(self.ids, np.empty(len(self.ids), np.int32))
            self.ids[at : at + len(ids)] = ids
            self.cuts[n + 1 : n + 1 + len(some)] = at + ends
            self.known.update(zip(some, range(n, n + len(some))))

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (int32) of all ``texts`` end to end, and how many each text has."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
        offsets -= offsets[0]
        n = np.zeros(len(texts), np.int64)
        if not len(raw):
            return np.empty(0, np.int32), n
        full = np.flatnonzero(np.diff(offsets))  # empty texts begin where the next does
        low, begins, odd = cut_words(raw, offsets[full])
        aside = set(full[odd].tolist())
        if b"<|" in raw.tobytes():
            aside |= {i for i in full.tolist() if i not in aside and self.holds_added(texts[i].as_py())}
        ids = np.empty(0, np.int32)
        if len(begins):
            cuts = np.append(begins, len(low)).astype(np.int32)
            kinds = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(cuts), pa.py_buffer(low)]).dictionary_encode()
            words = _values(kinds.dictionary)
            if len(self.known) + len(words) > CACHE_WORDS:
                self.forget()
            new = [w for w in words if w not in self.known]
            self.learn(new)
            place = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))[kinds.indices.to_numpy()]
            size = self.cuts[place + 1] - self.cuts[place]
            upto = np.cumsum(size)
            ids = self.ids[np.repeat(self.cuts[place] - upto + size, size) + np.arange(int(upto[-1]))]
            # a text's words begin in it: count by the bytes without white space
            text_of = np.searchsorted(self._bare(raw, offsets), begins, side="right") - 1
            n = np.bincount(text_of, size, len(texts)).astype(np.int64)
            if any(len(w) > LONGEST_CACHED for w in new):
                self.forget()  # rare: very long words are not kept
        if aside:
            parts = np.split(ids, np.cumsum(n)[:-1])
            for i in aside:
                parts[i] = np.array(self.whole.encode(texts[i].as_py(), add_special_tokens=False).ids, np.int32)
            n = np.array([len(p) for p in parts], np.int64)
            ids = np.concatenate(parts)
        return ids, n

    @staticmethod
    def _bare(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where each text begins when white space is dropped."""
        kept = np.append(0, np.cumsum(byte_kinds()[raw] != SPACE))
        return kept[offsets[:-1]]

    def encode_many(self, texts: list[str]) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        ids, n = self.encode_texts(pa.array(texts, pa.string()))
        for part in np.split(ids, np.cumsum(n)[:-1]):
            yield part.astype("<u4").tobytes()


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    files: int | None = None,
    stripe_mb: int = 64,
    row_stride: int = 1000,
) -> None:
    """Write ``doc_id, part, local_start, n_tokens, ids`` as ORC under ``path``.

    A null text counts as empty (only the end id). Documents are ordered by
    id, a null id first, those of one id by a digest of their text, so rows of
    one id (or without any) are spread over files like others. ``files``
    defaults to the session's shuffle partitions; ranges are balanced by Spark's
    sampling of ids, which places range borders only. Whole texts are encoded
    however long they are. Extra columns are ignored, whatever their names. An
    empty table gives an empty data set. The files' totals are written beside
    them, under ``_totals``.
    """
    from pyspark import TaskContext

    spark, tok = docs.sparkSession, tokenizer or default_tokenizer()
    ship_package(spark)
    small = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("row")]
    placed = small.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = placed.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = T.StructType(
        [
            T.StructField("doc_id", small.schema["doc_id"].dataType),
            T.StructField("part", T.IntegerType()),
            T.StructField("local_start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part, before = encoder(tok), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in steps(batch):
                ids, sizes = tool.encode_texts(rows.column("text"))
                sizes = sizes + 1
                offsets = np.append(0, np.cumsum(sizes))
                values = np.empty(int(offsets[-1]), np.int32)
                ends = np.zeros(len(values), bool)
                ends[offsets[1:] - 1] = True
                values[ends], values[~ends] = end_id, ids
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(np.full(len(sizes), part, np.int32)),
                        pa.array(before + offsets[:-1]),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values)),
                    ],
                    names=schema.names,
                )
                before += int(offsets[-1])

    (
        ordered.mapInArrow(run, schema)
        .write.option("orc.stripe.size", stripe_mb << 20)
        .option("orc.row.index.stride", row_stride)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .option("orc.compress", "ZSTD")
        .orc(path)
    )
    totals = spark.read.orc(path).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    line = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    totals.select("part", F.coalesce(F.sum("total").over(line), F.lit(0)).alias("base")).write.parquet(f"{path}/{TOTALS}")


def steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``STEP_BYTES`` of text each, at least a row."""
    column = batch.column("text")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(offsets, int(offsets[begin]) + STEP_BYTES, side="right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def read_documents(spark: SparkSession, path: str, doc_ids: list | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from the files. ``doc_ids`` is pushed to
    the scan, which skips stripes and row groups by their statistics; the files'
    totals, one row a file, are read from where they were written."""
    rows = spark.read.orc(path)
    bases = spark.read.parquet(f"{path}/{TOTALS}")
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin(doc_ids))
    return rows.join(bases, "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def id_checksums(rows: DataFrame) -> DataFrame:
    """``ids`` replaced by their number and crc32 (as little-endian unsigned
    32-bit integers), counted from the ids themselves."""
    ship_package(rows.sparkSession)
    keep = [f for f in rows.schema.fields if f.name not in ("ids", "n_tokens")]
    schema = T.StructType([*keep, T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            at = lists.offsets.to_numpy()
            crcs = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in keep), pa.array(np.diff(at).astype(np.int64)), pa.array(crcs, pa.int64())],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def scratch_path(spark: SparkSession) -> str:
    return scratch_folder(spark, "token-orc")
