"""Language-model scoring by context-tree weighting over bytes.

A text is the byte sequence of its lower-cased words joined by one space and
closed by one end byte (a line feed, which no word contains); before a text
stand ``depth`` end bytes. Every byte is eight binary decisions; the context
of a decision is the preceding bytes (0 to ``depth`` of them) and the bits of
the byte so far. At each node a Krichevsky-Trofimov estimate of its own counts
is mixed with the product over its children, one half each, so a prediction
weighs all depths by how well they explained the corpus; the code length of a
text is -log2 of its probability, divided by its bytes.

The training counts of all ``depth + 1``-byte grams are aggregated by Spark;
the tree over the last two context bytes and deeper is evaluated in parallel
by those two bytes, and only the nodes of depth 1 and 0 (at most 65,280 + 255)
pass through the driver.

Texts are scored in blocks: a block's distinct words and grams are looked up
by joins and come back to the block, so no model is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import fold, pick
from candlewick.llm.workers import release_memory
from candlewick.session import cut_lineage, ship_package

DEPTH = 5
BLOCK_BYTES = 18 << 20
CHUNK_BYTES = 1 << 20
STEP_BYTES, GRAM_BYTES, MERGE_GRAMS = 2 << 20, 2 << 20, 2_000_000
_NO_CODE = np.uint64((1 << 64) - 1)  # grams have 56 bits
END = b"\n"
GRAMS_PER_TASK = 100_000
_LN2 = math.log(2.0)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for positive arguments (Stirling's series from 8 upwards)."""
    x = np.asarray(x, float)
    low = x < 8
    y = np.where(low, x + 8, x)
    out = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * y * y)) / (y * y)) / (y * y)) / y
    if low.any():
        out[low] -= np.log(np.prod(x[low][:, None] + np.arange(8), axis=1))
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of ``zeros`` 0s and ``ones`` 1s under the KT estimate."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def merge(keys: np.ndarray, *sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct ``keys``, where each key went, and the sums by key."""
    found, back = np.unique(keys, return_inverse=True)
    return found, back, *(np.bincount(back, s, len(found)) for s in sums)


class Subtrees:
    """Context trees over whole subtrees: all grams that share their last
    ``low`` context bytes. ``grams``: context bytes and next byte, the next
    byte lowest; ``n``: training counts (0 allowed)."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, depth: int, low: int):
        byte = (grams & np.uint64(0xFF)).astype(np.int64)
        step = np.arange(8)
        node = (1 << step) | (byte[:, None] >> (8 - step))
        self.bit = ((byte[:, None] >> (7 - step)) & 1).astype(bool)
        context = grams >> np.uint64(8)
        keys = ((context[:, None] << np.uint64(8)) | node.astype(np.uint64)).ravel()
        weight = np.repeat(n.astype(float), 8)
        ones = np.where(self.bit.ravel(), weight, 0.0)
        keys, back, zeros, ones = merge(keys, weight - ones, ones)
        estimate = log_kt(zeros, ones)
        self.depth, self.low, self.back = depth, low, back
        #: per depth from the deepest: zeros, ones, own weight, and the parent's position
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray | None]] = [(zeros, ones, None, None)]
        weighted = estimate
        for d in range(depth - 1, low - 1, -1):
            mask = np.uint64((1 << (8 * d + 8)) - 1)
            keys, up, zeros, ones, below = merge(keys & mask, zeros, ones, weighted)
            estimate = log_kt(zeros, ones)
            weighted = np.logaddexp(estimate, below) - _LN2
            own = np.exp(estimate - _LN2 - weighted)
            last = self.levels[-1]
            self.levels[-1] = (*last[:3], up)
            self.levels.append((zeros, ones, own, None))
        self.keys, self.weighted = keys, weighted

    def predict(self, top: TopNodes | None = None) -> np.ndarray:
        """Natural log probability of each gram's byte after its context."""
        at, p = self.back, None
        bit = self.bit.ravel()
        for zeros, ones, own, up in self.levels:
            z, o = zeros[at], ones[at]
            kt = (np.where(bit, o, z) + 0.5) / (z + o + 1.0)
            p = kt if p is None else own[at] * kt + (1 - own[at]) * p
            keys = at
            if up is not None:
                at = up[at]
        if top is not None:
            p = top.finish(self.keys[keys], bit, p)
        return np.log(p.reshape(-1, 8)).sum(1)


class TopNodes:
    """The nodes of depth 1 and 0: ``keys`` (context byte and node), counts and
    the summed log weights of their children."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        order = np.argsort(keys)
        self.levels = []
        keys, zeros, ones, below = keys[order], zeros[order].astype(float), ones[order].astype(float), below[order]
        for d in (1, 0):
            if d == 0:
                keys, _, zeros, ones, below = merge(keys & np.uint64(0xFF), zeros, ones, weighted)
            estimate = log_kt(zeros, ones)
            weighted = np.logaddexp(estimate, below) - _LN2
            self.levels.append((np.uint64((1 << (8 * d + 8)) - 1), keys, zeros, ones, np.exp(estimate - _LN2 - weighted)))

    def finish(self, keys: np.ndarray, bit: np.ndarray, p: np.ndarray) -> np.ndarray:
        for mask, known, zeros, ones, own in self.levels:
            at = np.searchsorted(known, keys & mask)
            kt = (np.where(bit, ones[at], zeros[at]) + 0.5) / (zeros[at] + ones[at] + 1.0)
            p = own[at] * kt + (1 - own[at]) * p
        return p


def gram_chunks(bodies: Iterator[tuple[int, bytes]], depth: int, limit: int = CHUNK_BYTES):
    """Gram codes of the bodies (index, bytes with the end byte) in chunks of
    about ``limit`` bytes, a longer body in several pieces: yields codes (0 at
    the places that only give context), piece starts and piece indices."""

    def emit(pieces):
        raw = np.frombuffer(b"".join(b for _, b in pieces), np.uint8)
        codes = np.zeros(len(raw), np.uint64)
        for k in range(depth + 1):  # the oldest byte highest
            codes[depth:] |= raw[k : len(raw) - depth + k].astype(np.uint64) << np.uint64(8 * (depth - k))
        starts = np.cumsum([0] + [len(b) for _, b in pieces[:-1]])
        valid = np.ones(len(raw), bool)
        valid[(starts[:, None] + np.arange(depth)).ravel()] = False
        return codes, valid, starts, np.array([i for i, _ in pieces])

    pieces, size = [], 0
    for index, body in bodies:
        body = END * depth + body
        for at in range(0, len(body) - depth, limit):
            piece = body[at : at + limit + depth]
            pieces.append((index, piece))
            size += len(piece)
            if size >= limit:
                yield emit(pieces)
                pieces, size = [], 0
    if pieces:
        yield emit(pieces)


def _is_space(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw - np.uint8(9)) < 5)


class Texts:
    """Some texts of a block, as arrays: their bodies end to end (see the
    module's head) and their words."""

    def __init__(self, texts: pa.Array):
        n = len(texts)
        texts = texts.fill_null("") if texts.null_count else texts
        cuts = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
        data = texts.buffers()[2]
        text = np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]] if data is not None else np.empty(0, np.uint8)
        cuts -= cuts[0]
        # every text with an end byte behind it
        ends = cuts[1:] + np.arange(n)
        raw = np.insert(text, cuts[1:], END[0])
        raw += ((raw - np.uint8(65)) < 26).view(np.uint8) << 5
        space = _is_space(raw)
        # of white space one byte stays behind each word; of a text without words its end byte
        begins = np.append(0, ends[:-1] + 1)
        stay = ~space
        stay[1:] |= space[1:] & ~space[:-1]
        stay[begins] &= ~space[begins]
        where = np.cumsum(stay, dtype=np.int32)
        bare = where[ends] == np.append(0, where[ends[:-1]])
        if bare.any():
            stay[ends[bare]] = True
            where = np.cumsum(stay, dtype=np.int32)
        self.cuts = np.append(0, where[ends]).astype(np.int64)  # where bodies end
        self.body = np.where(space, np.uint8(32), raw)[stay]
        sign = ~space[stay]
        self.body[self.cuts[1:] - 1] = END[0]
        self.lengths = np.diff(self.cuts)
        first = sign.copy()
        first[1:] &= ~sign[:-1]
        begin = np.flatnonzero(first)
        letters = np.cumsum(sign, dtype=np.int32)
        offsets = np.append(letters[begin] - 1, letters[-1:]).astype(np.int32)
        self.words = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(self.body[sign])])
        self.text_of = np.searchsorted(self.cuts, begin, side="right") - 1  # each word's text

    @staticmethod
    def steps(column: pa.ChunkedArray, limit: int = 0) -> Iterator[tuple[int, int, Texts]]:
        """Texts of ``column`` in steps of about ``limit`` bytes, whole texts each:
        first and last row, and the texts."""
        texts = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
        cuts = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        begin = 0
        while begin < len(texts):
            end = max(begin + 1, int(np.searchsorted(cuts, int(cuts[begin]) + (limit or STEP_BYTES), side="right")) - 1)
            yield begin, end, Texts(texts.slice(begin, end - begin))
            begin = end

    def bodies(self, only: np.ndarray | None = None) -> Iterator[tuple[int, bytes]]:
        for i in range(len(self.lengths)) if only is None else np.flatnonzero(only).tolist():
            yield i, self.body[self.cuts[i] : self.cuts[i + 1]].tobytes()


def _gram_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and their summed counts."""
    codes, n = np.concatenate([c for c, _ in parts]), np.concatenate([k for _, k in parts])
    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.diff(codes, prepend=codes[:1] + np.uint64(1)))
    return codes[first], np.add.reduceat(n, first)


def _word_counts(tokens: pa.Table) -> pa.Table:
    return tokens.group_by("word").aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select(["word", "n"])


def block_dictionary(table: pa.Table, depth: int) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Of one block (``text, held_out``): training counts of its words (0 for
    words of held-out texts only) as a table ``word, n``, and of its grams."""
    held = table.column("held_out").to_numpy()
    counts = [pa.table({"word": pa.array([END], pa.binary()), "n": pa.array([int((~held).sum())], pa.int64())})]
    grams: list[tuple[np.ndarray, np.ndarray]] = []
    for begin, end, texts in Texts.steps(table.column("text")):
        out = held[begin:end]
        tokens = pa.table({"word": texts.words, "n": pa.array((~out[texts.text_of]).astype(np.int64))})
        counts.append(_word_counts(tokens))
        for side in (False, True):
            for codes, valid, _, _ in gram_chunks(texts.bodies(out == side), depth, GRAM_BYTES):
                found, n = np.unique(codes[valid], return_counts=True)
                grams.append((found, n * (0 if side else 1)))
                if sum(len(c) for c, _ in grams[1:]) > MERGE_GRAMS:
                    grams = [_gram_counts(grams)]
    words = _word_counts(pa.concat_tables(counts))
    return (words, *(_gram_counts(grams) if grams else (np.empty(0, np.uint64), np.empty(0, np.int64))))


class CodeTable:
    """Values by distinct 64-bit codes: open addressing in arrays, so a lookup
    is a few array operations (about a fifth of the time of a binary search)."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(codes)).bit_length())
        self.codes, self.values = np.full(1 << self.bits, _NO_CODE, np.uint64), np.zeros(1 << self.bits)
        left, slot = np.arange(len(codes)), self._slot(codes)
        while len(left):
            free = self.codes[slot] == _NO_CODE
            self.codes[slot[free]] = codes[left[free]]  # one of those at a slot wins
            won = self.codes[slot] == codes[left]
            self.values[slot[won]] = values[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        mixed = (codes ^ (codes >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        """Values of ``codes``, all of which are known."""
        slot = self._slot(codes)
        left = np.flatnonzero(self.codes[slot] != codes)
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            left = left[self.codes[slot[left]] != codes[left]]
        return self.values[slot]


def score_block(column: pa.ChunkedArray, words: pa.Array, values: np.ndarray, codes: np.ndarray, logp: np.ndarray, depth: int):
    """Per text of the block: number of tokens, known tokens, sum of
    log10(c + 1), the model's log10 probability and the body's length.
    ``words`` and ``values``: log10(c + 1) of each word."""
    look, end_value = CodeTable(codes, logp), values[pa.compute.index(words, END).as_py()]
    kinds, tokens, scores, lengths = [], [], [], []
    for _, _, texts in Texts.steps(column):
        kinds.append(texts.words.dictionary_encode())
        tokens.append(np.bincount(texts.text_of, minlength=len(texts.lengths)))
        score = np.zeros(len(texts.lengths))
        for found, valid, starts, index in gram_chunks(texts.bodies(), depth):
            each = np.zeros(len(found))
            each[valid] = look(found[valid])
            np.add.at(score, index, np.add.reduceat(each, starts))
        scores.append(score / math.log(10.0))
        lengths.append(texts.lengths)
    # the steps' distinct words are looked up together
    value = values[pa.compute.index_in(pa.concat_arrays([k.dictionary for k in kinds]), value_set=words).to_numpy()]
    known, base, at = [], [], 0
    for k, n in zip(kinds, tokens):
        each = value[at : at + len(k.dictionary)][k.indices.to_numpy()]
        text_of = np.repeat(np.arange(len(n)), n)
        known.append(np.bincount(text_of, each > 0, len(n)).astype(np.int64) + int(end_value > 0))
        base.append(np.bincount(text_of, each, len(n)) + end_value)
        at += len(k.dictionary)
    return np.concatenate(tokens) + 1, *(np.concatenate(c) for c in (known, base, scores, lengths))


def train_model(grams: DataFrame, depth: int) -> DataFrame:
    """``grams``: distinct ``gram, n``. Returns ``gram, logp`` (natural log of
    the probability of the gram's byte after its context) for each."""
    spark = grams.sparkSession
    ship_package(spark)
    low = min(2, depth)
    tasks = max(1, -(-grams.count() // GRAMS_PER_TASK))
    # 65,536 subtrees at most, each whole in one task
    dealt = grams.withColumn("tree", F.shiftright("gram", 8).bitwiseAND(F.lit((1 << (8 * low)) - 1))).repartition(tasks, "tree")

    def subtrees(batches: Iterator[pa.RecordBatch]) -> Subtrees | None:
        got = list(batches)
        if not sum(b.num_rows for b in got):
            return None
        whole = pa.Table.from_batches(got)
        return Subtrees(whole.column("gram").to_numpy().astype(np.uint64), whole.column("n").to_numpy(), depth, low)

    def tops(batches):
        tree = subtrees(batches)
        if tree is not None:
            zeros, ones = tree.levels[-1][:2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree.keys.astype(np.int64)), pa.array(zeros), pa.array(ones), pa.array(tree.weighted)],
                names=["key", "zeros", "ones", "weighted"],
            )

    nodes = dealt.mapInArrow(tops, "key long, zeros double, ones double, weighted double")
    first = F.col("key").bitwiseAND(F.lit(0xFFFF))
    rows = nodes.groupBy(first.alias("key")).agg(F.sum("zeros"), F.sum("ones"), F.sum("weighted")).collect()  # <= 65,280
    if not rows:
        return spark.createDataFrame([], "gram long, logp double")
    top = TopNodes(
        np.array([r[0] for r in rows], np.uint64), *(np.array([r[i] for r in rows], float) for i in (1, 2, 3))
    )
    shared = spark.sparkContext.broadcast(top)

    def logs(batches):
        got = list(batches)
        tree = subtrees(got)
        if tree is not None:
            whole = pa.Table.from_batches(got)
            yield pa.RecordBatch.from_arrays(
                [whole.column("gram").combine_chunks(), pa.array(tree.predict(shared.value))], names=["gram", "logp"]
            )

    return dealt.mapInArrow(logs, "gram long, logp double")


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 7,
    held_fold: int = 2,
    depth: int = DEPTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score, bits_per_byte``.

    Rows whose id's fold (crc32 of the id as text, modulo ``folds``) is
    ``held_fold`` are not learned from. A null or empty text is the end token
    alone. Repeated rows are learned from and scored each. With no training
    text every byte costs 8 bits. An empty table gives an empty result. Extra
    columns are ignored, whatever their names. A block holds about
    ``block_bytes`` of whole texts (or one longer text); texts are dealt to
    blocks by id and text, so many rows of one id, or without any, are spread.
    """
    if not 2 <= depth <= 6:
        raise ValueError("depth: 2 to 6 bytes (a gram is a 56-bit number at most)")
    spark = docs.sparkSession
    ship_package(spark)
    small = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("held_out", fold(F.col("doc_id"), folds) == held_fold)
    size = small.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    small = small.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def dictionary(key, table):
        words, codes, n = block_dictionary(table, depth)
        out = pa.table(
            {
                "block": pa.array(np.full(len(words) + len(codes), key[0].as_py(), np.int32)),
                "word": pa.chunked_array([*words.column("word").chunks, pa.nulls(len(codes), pa.binary())]),
                "gram": pa.array(np.concatenate([np.zeros(len(words), np.int64), codes.astype(np.int64)])),
                "n": pa.array(np.concatenate([words.column("n").to_numpy(), n])),
            }
        )
        release_memory()  # the worker lives on
        return out

    entries = cut_lineage(
        small.select("block", "text", "held_out").groupBy("block").applyInArrow(dictionary, "block int, word binary, gram long, n long"),
        "ctw-entries",
    )
    # a word has one row per block that holds it: the largest group is the number of blocks
    by_word = Window.partitionBy("word")
    words = cut_lineage(
        entries.where("word IS NOT NULL")
        .select("block", "word", F.sum("n").over(by_word).alias("c"), (F.min("block").over(by_word) == F.col("block")).alias("first")),
        "ctw-words",
    )
    total = words.where("first").agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    n_train, kinds = int(total["n"] or 0), int(total["v"] or 0)
    grams = entries.where("word IS NULL").select("block", "gram", "n")
    distinct = cut_lineage(grams.groupBy("gram").agg(F.sum("n").alias("n")), "ctw-grams")
    model = cut_lineage(train_model(distinct, depth), "ctw-model")
    values = words.select("block", "word", F.lit(0).cast("long").alias("gram"), F.log10(F.col("c") + 1.0).alias("value")).unionByName(
        grams.join(model, "gram").select("block", F.lit(None).cast("binary").alias("word"), "gram", F.col("logp").alias("value"))
    )
    norm = math.log10(n_train + kinds + 1)
    schema = T.StructType(
        [
            T.StructField("doc_id", small.schema["doc_id"].dataType),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("train_tokens", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("bits_per_byte", T.DoubleType()),
        ]
    )

    def score(texts: pa.Table, found: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table({f.name: [] for f in schema.fields}, schema=pa.schema([("doc_id", texts.schema.field("doc_id").type), ("held_out", pa.bool_()), *((f.name, pa.int64()) for f in schema.fields[2:5]), *((f.name, pa.float64()) for f in schema.fields[5:])]))
        is_word = found.column("word").is_valid()
        word_rows, gram_rows = found.filter(is_word), found.filter(pa.compute.invert(is_word))
        del found
        words, values = word_rows.column("word").combine_chunks(), word_rows.column("value").to_numpy()
        codes, logp = gram_rows.column("gram").to_numpy().astype(np.uint64), gram_rows.column("value").to_numpy()
        tokens, known, base, total, lengths = score_block(texts.column("text"), words, values, codes, logp, depth)
        del words, values, codes, logp, word_rows, gram_rows
        release_memory()  # the worker lives on
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "held_out": texts.column("held_out"),
                "n_tokens": tokens,
                "n_known": known,
                "train_tokens": np.full(len(tokens), n_train, np.int64),
                "base_score": base - tokens * norm,
                "score": total,
                "bits_per_byte": -total / math.log10(2.0) / lengths,
            }
        )

    return small.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(score, schema)
