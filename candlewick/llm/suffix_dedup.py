"""Removal of repeated passages with suffix arrays of shards.

A byte goes if a string of ``window`` bytes that covers it also starts anywhere
else, in the same document or another. Which windows repeat is read off sorted
suffixes: neighbours with a common prefix of ``window`` bytes or more. Shards are
sorted by external induced sorting (``induced.py``), so a shard may be far larger
than a task's memory.

Equal windows must meet in one shard. In every window the ``GRAM``-byte string of
the smallest hash (the leftmost on a tie) is its *anchor*; equal windows have
equal anchors at equal offsets, and the windows of a document fall into runs
with the same anchor: *regions*. So:

1. all regions of the corpus are listed (places and hashes, no text);
2. regions whose anchor occurs once hold no repeated window and are left;
3. equal regions are combined, one of them stands for all; where that is the
   only one of its anchor, all its windows are known to repeat;
4. texts of the remaining distinct regions go to shards by anchor, suffixes of
   those that share enough bytes around the anchor with another are sorted, and
   windows met twice (or of regions that occur twice) are marked;
5. marked windows go back to every copy of their region, and the bytes they
   cover are cut out.

An anchor that very many distinct regions share (the edge of a passage that a
third of all documents hold) does not make one large shard: its regions are cut
into pieces of ``PIECE`` windows, which share at least ``window - PIECE + 1``
bytes, and dealt by these bytes; pieces that are still too many in one place are
cut into single windows, which are equal or dealt apart.
"""

from __future__ import annotations

import hashlib
import shutil
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import hidden, position
from candlewick.llm.induced import sorted_suffixes, spill_folder
from candlewick.llm.workers import release_memory
from candlewick.session import cut_lineage, ship_package

WINDOW = 400
GRAM = 128  # a power of two of at least 8
STEP_BYTES = 1 << 20
SLICE_BYTES = 1 << 20  # of texts that a task works on at once
BLOCK_WINDOWS = 1 << 15  # whose hashes stay in a core's cache
PIECE = 16
HOT_REGIONS = 256
SHARD_BYTES = 2 << 20


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hashes of the ``gram`` bytes from each position on (fewer
    positions than bytes by gram - 1)."""
    if len(raw) < gram:
        return np.empty(0, np.uint64)
    padded = np.ascontiguousarray(raw)
    h = np.ndarray((len(raw) - 7,), "<u8", padded.data, strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    span = 8
    while span < gram:
        h = h[:-span] * np.uint64(0xBF58476D1CE4E5B9) + (h[span:] ^ (h[span:] >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
        span *= 2
    return h


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row."""
    n = len(values)
    blocks = -(-n // width)
    full = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    full[:n] = values
    rows = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors_of(raw: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the anchors of all windows of ``raw``."""
    n = len(raw) - window + 1
    hashes, places = np.empty(n, np.uint64), np.empty(n, np.int64)
    low = np.uint64(0xFFFFFF)
    for begin in range(0, n, BLOCK_WINDOWS):
        h = gram_hashes(raw[begin : begin + BLOCK_WINDOWS + window - 1], gram)
        least = sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), window - gram + 1)
        at = (least & low).astype(np.int64)
        hashes[begin : begin + len(at)] = h[at]
        places[begin : begin + len(at)] = at + begin
    return hashes, places


def regions_of(raw: np.ndarray, ends: np.ndarray, window: int, gram: int, step: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows with one anchor in texts laid end to end (``ends``: where
    each ends): anchor hashes and places, first and last window starts."""
    for begin in range(0, len(raw), step):
        chunk = raw[begin : begin + step + window - 1]
        if len(chunk) < window:
            return
        h, anchor = anchors_of(chunk, window, gram)
        n = len(chunk) - window + 1  # windows that start here
        valid = np.ones(n, bool)
        first = int(np.searchsorted(ends, begin, side="right"))
        for end in ends[first:].tolist():
            if end - begin - window + 1 > n:
                break
            valid[max(0, end - begin - window + 1) : max(0, end - begin)] = False
        at = np.flatnonzero(valid)
        if not len(at):
            continue
        cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(anchor[at]) != 0))
        low, high = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]
        yield h[low], anchor[low] + begin, low + begin, high + begin


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary array."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """``batches`` cut where ``column`` (string or binary) passes ``SLICE_BYTES``; a row stays whole."""
    for batch in batches:
        ends = _binary(batch.column(column))[1][1:]
        at = 0
        while at < batch.num_rows:
            begin = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, begin + SLICE_BYTES, side="right")))
            yield batch.slice(at, to - at)
            at = to


def list_regions(texts: DataFrame, window: int, gram: int, step: int) -> DataFrame:
    """``key, low, high, at, anchor, region, copies`` of ``texts`` (``key, text``):
    each document's distinct regions (first and last window start, the anchor's
    distance from the first, hashes of the anchor and of the whole region, how
    often the document holds it); and rows without a region: windows that
    repeat within their document."""
    ship_package(texts.sparkSession)
    names = ["key", "low", "high", "at", "anchor", "region", "copies"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raw, offsets = _binary(batch.column("text"))
            keys = batch.column("key").to_pylist()
            memory = memoryview(np.ascontiguousarray(raw))
            parts = list(regions_of(raw, offsets[1:], window, gram, step))
            if not parts:
                continue
            anchor, place, low, high = (np.concatenate(c) for c in zip(*parts))
            doc = np.searchsorted(offsets[1:], low, side="right")
            hashes = [hashlib.blake2b(memory[a : b + window], digest_size=8).digest() for a, b in zip(low.tolist(), high.tolist())]
            digest = np.frombuffer(b"".join(hashes), "<i8")
            order = np.lexsort((low, digest, anchor, doc))
            same = np.zeros(len(order), bool)
            same[1:] = np.logical_and.reduce([c[order][1:] == c[order][:-1] for c in (doc, anchor, digest)])
            first = np.flatnonzero(~same)
            copies = np.diff(np.append(first, len(order)))
            one = order[first]
            # windows known to repeat, joined where they touch
            again = np.sort(order[np.repeat(copies, copies) > 1])
            joined = np.zeros(len(again), bool)
            joined[1:] = (low[again[1:]] == high[again[:-1]] + 1) & (doc[again[1:]] == doc[again[:-1]])
            head = np.flatnonzero(~joined)
            known_low, known_high = low[again[head]], high[again[np.append(head[1:], len(again)) - 1]] if len(head) else low[again]
            of = np.append(doc[one], doc[again[head]])
            begin, none = offsets[of], np.zeros(len(head), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[i] for i in of.tolist()], pa.binary()),
                    pa.array((np.append(low[one], known_low) - begin).astype(np.int32)),
                    pa.array((np.append(high[one], known_high) - begin).astype(np.int32)),
                    pa.array(np.append(place[one] - low[one], none).astype(np.int32)),
                    pa.array(np.append(anchor[one].view(np.int64), none)),
                    pa.array(np.append(digest[one], none), mask=np.arange(len(of)) >= len(one)),
                    pa.array(np.append(copies, none)),
                ],
                names=names,
            )

    return texts.mapInArrow(run, "key binary, low int, high int, at int, anchor long, region long, copies long")


def cut_regions(found: DataFrame, window: int, piece: int) -> DataFrame:
    """Texts of regions. ``found``: ``text, regions`` (with ``low, high, anchor,
    region, copies, at, hot``). Returns ``place, anchor, region, copies, off, at,
    body`` (``at``: the anchor's place in the body): a whole region is dealt by its anchor; one of a hot anchor in pieces, by
    the bytes that the windows of a piece share. ``at`` is the anchor's offset
    from ``low``: pieces are cut at fixed distances from it, so that equal
    windows of different regions lie in pieces of equal shared bytes."""
    ship_package(found.sparkSession)
    names = ["place", "anchor", "region", "copies", "off", "at", "body"]

    def parts(r: dict, raw: memoryview) -> Iterator[tuple[int, int, int]]:
        """Place, first and last window (from ``low``) of each piece."""
        n = r["high"] - r["low"] + 1
        if not r["hot"]:
            yield r["anchor"], 0, n - 1
            return
        off = 0
        while off < n:
            slot = (r["at"] - off) // piece  # the windows' distance to the anchor, in pieces
            near = r["at"] - slot * piece  # the nearest window that a full piece may have; the farthest is near - piece + 1
            core = raw[r["low"] + near : r["low"] + near - piece + 1 + window]
            salted = hashlib.blake2b(core, digest_size=8, salt=slot.to_bytes(8, "little"))
            yield int.from_bytes(salted.digest(), "little", signed=True), off, min(n - 1, near)
            off = near + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for batch in slices(batches, "text"):
            for text, regions in zip(batch.column("text"), batch.column("regions")):
                raw = memoryview(text.as_buffer())
                for r in regions.as_py():
                    for place, off, last in parts(r, raw):
                        body = bytes(raw[r["low"] + off : r["low"] + last + window])
                        out.append((place, r["anchor"], r["region"], r["copies"], off, r["at"] - off, body))
                        size += len(body)
                        if size >= STEP_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                            out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return found.mapInArrow(run, "place long, anchor long, region long, copies long, off int, at int, body binary")


def sharing(bodies: list[bytes], at: list[int], window: int, gram: int) -> np.ndarray:
    """Which bodies may share a window with another. A window reaches over its
    anchor by half of the other bytes at least, to the left or to the right, and
    equal windows hold equal anchors at equal offsets: so bodies that share one
    share the anchor with that many bytes before it, or behind it."""
    side = -(-(window - gram) // 2)
    left = [b[a - side : a + gram] if a >= side else b"" for b, a in zip(bodies, at)]
    right = [b[a : a + gram + side] for b, a in zip(bodies, at)]  # shorter at the body's end: no window there needs it
    found = np.zeros(len(bodies), bool)
    for ends, least in ((left, gram + side), (right, gram + side)):
        times = Counter(ends)
        found |= np.array([len(e) == least and times[e] > 1 for e in ends], bool)
    return found


def repeated_starts(bodies: list[bytes], copies: list[int], window: int, folder: str, **limits) -> list[np.ndarray]:
    """Per body the starts of its windows that occur twice in the bodies (or
    once in a body that stands for several copies), by sorted suffixes."""
    size = np.array([len(b) for b in bodies], np.int64)
    text = np.zeros(int(size.sum()) + len(bodies) + 1, np.uint16)
    starts = np.cumsum(np.append(0, size[:-1] + 1))
    for at, body in zip(starts.tolist(), bodies):
        text[at : at + len(body)] = np.frombuffer(body, np.uint8)
        text[at : at + len(body)] += 2
        text[at + len(body)] = 1  # end of a body; the text's own end is 0
    marked = np.zeros(len(text), bool)
    last = -1
    for pos, lcp in sorted_suffixes(text, window, folder, **limits):
        near = np.flatnonzero(lcp >= window)
        marked[pos[near]] = True
        marked[pos[near[near > 0] - 1]] = True
        if len(near) and near[0] == 0:
            marked[last] = True
        last = int(pos[-1])
    out = []
    for at, n, c in zip(starts.tolist(), size.tolist(), copies):
        windows = n - window + 1
        out.append(np.arange(windows) if c > 1 else np.flatnonzero(marked[at : at + windows]))
    return out


def _runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)]


def mark_shards(pieces: DataFrame, window: int, gram: int, shards: int, **limits) -> DataFrame:
    """``anchor, region, low, high``: runs of repeated windows (starts within
    their region) of ``pieces``, dealt to ``shards`` by place. Only bodies that
    may share a window with another (``sharing``) are sorted."""
    names = ["anchor", "region", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = {name: [] for name in ("anchor", "region", "copies", "off", "at", "body")}
        for batch in batches:
            for name, column in rows.items():
                column.extend(batch.column(name).to_pylist())
        if not rows["body"]:
            return
        bodies, copies = rows["body"], rows["copies"]
        some = np.flatnonzero(sharing(bodies, rows["at"], window, gram)).tolist()
        found = [np.arange(len(b) - window + 1 if c > 1 else 0) for b, c in zip(bodies, copies)]
        folder = spill_folder()
        try:
            if some:
                for i, starts in zip(some, repeated_starts([bodies[i] for i in some], [copies[i] for i in some], window, folder, **limits)):
                    found[i] = starts
        finally:
            shutil.rmtree(folder)
            release_memory()
        out = [[], [], [], []]
        for i, starts in enumerate(found):
            if len(starts):
                low, high = _runs(starts)
                for column, values in zip(out, ([rows["anchor"][i]] * len(low), [rows["region"][i]] * len(low), low + rows["off"][i], high + rows["off"][i])):
                    column.extend(values)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    return pieces.repartition(shards, "place").mapInArrow(run, "anchor long, region long, low int, high int")


def count_windows(pieces: DataFrame, window: int) -> DataFrame:
    """``anchor, region, low, high`` of repeated windows of pieces that are too
    many in one place: each window is one row of 16 bytes, equal ones are counted."""
    names = ["digest", "anchor", "region", "copies", "low"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                out = []
                some = batch.slice(begin, 256)
                for anchor, region, copies, off, body in zip(*(some.column(c).to_pylist() for c in ("anchor", "region", "copies", "off", "body"))):
                    memory = memoryview(body)
                    for k in range(len(body) - window + 1):
                        out.append((hashlib.blake2b(memory[k : k + window], digest_size=16).digest(), anchor, region, copies, off + k))
                types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    windows = pieces.mapInArrow(run, "digest binary, anchor long, region long, copies long, low int")
    windows = cut_lineage(windows, "suffix-windows")
    many = windows.groupBy("digest").agg(F.sum("copies").alias("n")).where("n > 1").select("digest")
    return windows.join(many, "digest").select("anchor", "region", "low", F.col("low").alias("high"))


def document_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that tell documents of another id or text apart."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("\0"), text)))


def repeated_windows(
    texts: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    hot_regions: int = HOT_REGIONS,
    piece: int = PIECE,
    shard_bytes: int = SHARD_BYTES,
    step_bytes: int = STEP_BYTES,
    **limits,
) -> DataFrame:
    """``key, low, high``: first and last starts of runs of windows of ``texts``
    (``key, text``; equal keys hold equal texts) that also start elsewhere."""
    spark = texts.sparkSession
    listed = cut_lineage(list_regions(texts, window, gram, step_bytes), "suffix-regions")
    known = listed.where("region IS NULL").select("key", "low", "high")
    listed = listed.where("region IS NOT NULL")
    often = listed.groupBy("anchor").agg(F.sum("copies").alias("n")).where("n > 1").select("anchor")
    some = cut_lineage(listed.join(often, "anchor", "left_semi"), "suffix-candidates")
    one = some.groupBy("anchor", "region").agg(F.sum("copies").alias("copies"), F.min(F.struct("key", "low", "high", "at")).alias("one"))
    one = cut_lineage(one.select("anchor", "region", "copies", "one.*"), "suffix-distinct")
    anchors = one.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("region", "low", "high")).alias("one"))
    anchors = cut_lineage(anchors.where((F.col("n") == 1) | (F.col("n") > hot_regions)).select("anchor", "n", "one.*"), "suffix-anchors")
    # the only region of its anchor occurs more than once: its windows all repeat, and none starts elsewhere
    alone = anchors.where("n = 1")
    # written, so its size is known: at most one row per hot_regions rows
    hot = cut_lineage(anchors.where(F.col("n") > hot_regions).select("anchor"), "suffix-hot")
    rest = one.join(alone.select("anchor", "region"), ["anchor", "region"], "left_anti")
    flagged = rest.join(hot.withColumn("hot", F.lit(True)), "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    by_text = flagged.groupBy("key").agg(F.collect_list(F.struct("low", "high", "at", "anchor", "region", "copies", "hot")).alias("regions"))
    whole = texts.join(by_text.select("key"), "key", "left_semi").dropDuplicates(["key"])
    found = whole.select("key", F.col("text").cast("binary").alias("text")).join(by_text, "key").select("text", "regions")
    pieces = cut_lineage(cut_regions(found, window, piece), "suffix-pieces")
    per_place = pieces.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("body")).alias("bytes"))
    crowded = per_place.where(F.col("n") > hot_regions)
    total = per_place.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    crowd = cut_lineage(crowded.select("place"), "suffix-crowded")
    marks = mark_shards(pieces.join(crowd, "place", "left_anti"), window, gram, shards, **limits)
    if not crowd.isEmpty():
        marks = marks.unionByName(count_windows(pieces.join(crowd, "place", "left_semi"), window))
    marks = marks.unionByName(alone.select("anchor", "region", F.lit(0).alias("low"), (F.col("high") - F.col("low")).alias("high")))
    marks = cut_lineage(marks.withColumnsRenamed({"low": "from", "high": "to"}), "suffix-marks")
    back = some.select("key", "low", "anchor", "region").join(marks, ["anchor", "region"])
    return back.select("key", (F.col("low") + F.col("from")).alias("low"), (F.col("low") + F.col("to")).alias("high")).unionByName(known)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, carry: list[str] | None = None, **limits
) -> DataFrame:
    """All rows of ``docs`` with the columns ``carry`` (default: all), renamed by
    position (``_in0``, ...), and ``n_bytes``, ``n_removed``, ``n_spans`` (maximal
    removed runs) and ``kept`` (the remaining bytes).

    A null text counts as empty; texts shorter than ``window`` bytes stay whole.
    Repeated rows repeat each other's windows, also under one id or none. Very
    long texts are read in steps, windows across them included. An empty table
    gives an empty result. Extra columns are passed through, whatever their names.
    """
    raw, names = hidden(docs)
    key_col, body = F.col(position(names, id_col)), F.coalesce(F.col(position(names, text_col)), F.lit(""))
    keyed = raw.withColumn("_key", document_key(key_col, body))
    texts = keyed.select(F.col("_key").alias("key"), body.alias("text")).where(F.octet_length("text") >= window)
    windows = repeated_windows(texts, window, **limits)
    spans = windows.groupBy("key").agg(F.collect_set(F.struct("low", "high")).alias("_spans")).withColumnRenamed("key", "_key")
    columns = raw.columns if carry is None else [position(names, c) for c in carry]
    joined = keyed.join(spans, "_key", "left").select(*columns, body.cast("binary").alias("_body"), "_spans")
    extra = "n_bytes long, n_removed long, n_spans long, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_body"):
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for body, spans in zip(batch.column("_body").to_pylist(), batch.column("_spans").to_pylist()):
                runs: list[list[int]] = []
                for span in sorted((s["low"], s["high"] + window) for s in spans or []):
                    if runs and span[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], span[1])
                    else:
                        runs.append(list(span))
                edges = [0, *(e for r in runs for e in r), len(body)]
                left = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
                n_bytes.append(len(body)), n_removed.append(len(body) - len(left)), n_spans.append(len(runs)), kept.append(left)
            arrays = [batch.column(c) for c in columns]
            arrays += [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "n_bytes", "n_removed", "n_spans", "kept"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in raw.select(*columns).schema.fields)
    return joined.mapInArrow(run, f"{fields}, {extra}")
