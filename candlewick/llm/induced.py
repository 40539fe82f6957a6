"""External induced sorting of suffixes with their common prefixes.

A text (array of symbols, the last one unique and smallest) is split by the
types of its suffixes: L (larger than the next suffix) and S (smaller); S*
suffixes are S after an L. Substrings between S* positions are sorted and
named, the names' suffixes are sorted by the same method one level deeper (in
memory once they fit), and that order induces all others: going through
suffixes from the smallest up places each L suffix when its successor is met,
going from the largest down places each S suffix.

What is still to come waits in a priority queue of tuples (symbol, order of
insertion, position, common prefix with the tuple before it). The queue keeps
sorted runs, in memory up to a budget and on disk beyond it, and gives them
back in blocks, so a block of tuples is handled by array operations. A tuple's
common prefix is one more than the smallest common prefix met since the last
tuple of the same symbol was inserted.

Common prefixes are counted up to ``cap``, and suffixes that agree on ``cap``
symbols may come in any order.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np

MEMORY_ROWS = 4 << 20
BASE_SYMBOLS = 1 << 20
BLOCK_ROWS = 1 << 18


def spill_folder() -> str:
    """A fresh folder on the disk that the cluster gives tasks to spill to."""
    top = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return tempfile.mkdtemp(prefix="induced-", dir=top if top and os.path.isdir(top) else None)


def stable_order(values: np.ndarray) -> np.ndarray:
    """Stable order of values that are not negative; they are sorted together
    with their places while both fit one integer, which is faster."""
    bits = len(values).bit_length()
    if len(values) and int(values.max()) >> (63 - bits) == 0:
        return np.sort((values << bits) | np.arange(len(values))) & ((1 << bits) - 1)
    return np.argsort(values, kind="stable")


class Run:
    """Sorted tuples: columns key, position, common prefix; ``at`` is the first not taken."""

    def __init__(self, columns: list[np.ndarray], on_disk: bool = False):
        self.columns, self.at, self.on_disk = columns, 0, on_disk

    def __len__(self) -> int:
        return len(self.columns[0]) - self.at


class TupleQueue:
    """Priority queue of suffix tuples by (key, order of insertion)."""

    def __init__(self, folder: str, memory_rows: int = MEMORY_ROWS):
        self.folder, self.memory_rows = folder, memory_rows
        self.runs: list[Run] = []  # oldest first: equal keys come out in this order
        self.spilled = 0

    def push(self, key: np.ndarray, pos: np.ndarray, lcp: np.ndarray) -> None:
        """Insert a batch; equal keys in the order given."""
        if not len(key):
            return
        order = np.argsort(key, kind="stable")
        self.push_sorted(key[order], pos[order], lcp[order])

    def push_sorted(self, key: np.ndarray, pos: np.ndarray, lcp: np.ndarray, on_disk: bool = False) -> None:
        self.runs.append(Run([key, pos, lcp], on_disk))
        while len(self.runs) > 1 and not self.runs[-1].on_disk and not self.runs[-2].on_disk and len(self.runs[-2]) <= 2 * len(self.runs[-1]):
            self._merge_last()
        if sum(len(r) for r in self.runs if not r.on_disk) > self.memory_rows:
            self._spill()

    def _merge_last(self) -> None:
        new, old = self.runs.pop(), self.runs.pop()
        columns = [np.concatenate((a[old.at :], b[new.at :])) for a, b in zip(old.columns, new.columns)]
        order = np.argsort(columns[0], kind="stable")
        self.runs.append(Run([c[order] for c in columns]))

    def _spill(self) -> None:
        """Merge the runs in memory (they follow all runs on disk) and write them as one."""
        while len(self.runs) > 1 and not self.runs[-2].on_disk:
            self._merge_last()
        run, columns = self.runs.pop(), []
        for name, column in zip(("key", "pos", "lcp"), run.columns):
            path = os.path.join(self.folder, f"{self.spilled}.{name}")
            column[run.at :].tofile(path)
            columns.append(np.memmap(path, column.dtype, "r"))
        self.spilled += 1
        self.runs.append(Run(columns, on_disk=True))

    def peek(self, limit: int) -> tuple[list[np.ndarray], np.ndarray]:
        """The smallest tuples (about ``limit`` a run at most, at least one if any
        are left), and the run each comes from."""
        self.runs = [r for r in self.runs if len(r)]
        heads = [r.columns[0][r.at : r.at + limit] for r in self.runs]
        unseen = [int(h[-1]) for h, r in zip(heads, self.runs) if len(r) > len(h)]
        if unseen:
            bound = min(unseen)  # tuples of this key may follow unseen
            ends = [int(np.searchsorted(h, bound)) for h in heads]
            if not any(ends):
                oldest = next(i for i, h in enumerate(heads) if h[0] == bound)
                ends = [0] * len(heads)
                ends[oldest] = int(np.searchsorted(heads[oldest], bound, side="right"))
        else:
            ends = [len(h) for h in heads]
        parts = [[c[r.at : r.at + e] for c in r.columns] for r, e in zip(self.runs, ends)]
        source = np.repeat(np.arange(len(ends)), ends)
        columns = [np.concatenate([np.asarray(p[i]) for p in parts]) for i in range(3)]
        if sum(e > 0 for e in ends) > 1:
            order = np.argsort(columns[0], kind="stable")
            columns, source = [c[order] for c in columns], source[order]
        return columns, source

    def take(self, source: np.ndarray) -> None:
        """Remove the tuples of a peek whose runs are ``source``."""
        for i, n in enumerate(np.bincount(source, minlength=len(self.runs)).tolist()):
            self.runs[i].at += n


class Spool:
    """Columns that grow by blocks, on disk beyond ``memory_rows``."""

    def __init__(self, folder: str, name: str, memory_rows: int):
        self.folder, self.name, self.memory_rows = folder, name, memory_rows
        self.blocks: list[tuple[np.ndarray, ...]] = []
        self.rows = 0  # in memory
        self.files: list | None = None
        self.types: list = []

    def add(self, *columns: np.ndarray) -> None:
        self.blocks.append(columns)
        self.rows += len(columns[0])
        if self.rows > self.memory_rows:
            self._flush()

    def _flush(self) -> None:
        if self.files is None:
            self.types = [c.dtype for c in self.blocks[0]]
            self.files = [open(os.path.join(self.folder, f"{self.name}.{i}"), "wb") for i in range(len(self.types))]
        for block in self.blocks:
            for f, c in zip(self.files, block):
                c.tofile(f)
        self.blocks, self.rows = [], 0

    def columns(self) -> list[np.ndarray]:
        if self.files is None:
            return [np.concatenate(c) for c in zip(*self.blocks)] if self.blocks else []
        self._flush()
        for f in self.files:
            f.close()
        return [np.memmap(f.name, t, "r") for f, t in zip(self.files, self.types)]


class RangeMin:
    """Minimum of ``values[a..b]`` for many ranges."""

    def __init__(self, values: np.ndarray, longest: int):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= longest:
            low, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(low[:-half], low[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        level = np.frexp((b - a + 1).astype(float))[1] - 1
        out = np.empty(len(a), self.levels[0].dtype)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.levels[k][a[at]], self.levels[k][b[at] + 1 - (1 << k)])
        return out


def induce(text: np.ndarray, flip: int | None, change: np.ndarray, queue: TupleQueue, cap: int, block_rows: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Go through the queue's seeds (odd keys) and the tuples they induce (even
    keys): yields blocks of positions, common prefixes with the tuple before,
    and whether a tuple was induced. ``flip``: mirror symbols by this, to go
    from the largest down. ``change[i]``: last position of i's run of equal symbols."""
    kinds = int(text.max()) + 1
    seen_block, seen_tail = np.full(kinds, -1, np.int32), np.zeros(kinds, np.uint16)
    between = np.zeros(64, np.uint16)  # least common prefix of the blocks after each block
    block, limit = 0, 1024
    last_key, last_pos = -1, -1
    while True:
        if not any(len(r) for r in queue.runs):
            return
        (key, pos, lcp), source = queue.peek(limit)
        ahead = pos > 0
        before = text[np.maximum(pos - 1, 0)].astype(np.int64)
        before = before if flip is None else flip - before
        own, seed = key >> 1, (key & 1).astype(bool)
        moves = ahead & ((before > own) | ((before == own) & ~seed))
        target = np.where(moves, 2 * before, np.iinfo(np.int64).max)
        # a tuple is due only if nothing inserted before it comes first
        due = np.ones(len(key), bool)
        due[1:] = key[1:] <= np.minimum.accumulate(target)[:-1]
        n = len(due) if due.all() else int(due.argmin())
        limit = min(block_rows, limit * 2) if n == len(due) else max(256, min(limit, 2 * n))
        queue.take(source[:n])
        key, pos, lcp, own, moves, before = key[:n], pos[:n], lcp[:n].copy(), own[:n], moves[:n], before[:n]
        # common prefixes where the key changes: runs of one symbol, or nothing
        first = np.flatnonzero(np.diff(key, prepend=last_key))
        prior_key = np.where(first > 0, key[first - 1], last_key)
        prior_pos = np.where(first > 0, pos[first - 1], last_pos)
        same = (prior_key >> 1) == own[first]
        a, b = pos[first], np.maximum(prior_pos, 0)
        runs = np.minimum(change[a] - a, change[b] - b) + 1
        lcp[first] = np.where(same & (prior_pos >= 0), np.minimum(runs, cap), 0).astype(np.uint16)
        last_key, last_pos = int(key[-1]), int(pos[-1])
        yield pos, lcp, (key & 1) == 0
        # insert the suffixes one symbol longer
        at = np.flatnonzero(moves)
        if len(at):
            to = before[at]
            order = np.argsort(to.astype(np.uint16) if kinds <= 1 << 16 else to, kind="stable")
            at, to = at[order], to[order]
            again = np.zeros(len(at), bool)
            again[1:] = to[1:] == to[:-1]
            least = np.empty(len(at), np.uint16)
            rep = np.flatnonzero(again)
            if len(rep):
                low, high = at[rep - 1] + 1, at[rep]
                least[rep] = RangeMin(lcp, int((high - low).max()) + 1)(low, high)
            new = np.flatnonzero(~again)
            upto = np.minimum.accumulate(lcp)
            known = seen_block[to[new]]
            carried = np.minimum(seen_tail[to[new]], between[known])
            least[new] = np.minimum(carried, upto[at[new]])
            prefix = np.minimum(least.astype(np.int32) + 1, cap)
            prefix[new[known < 0]] = 0
            queue.push_sorted(2 * to, pos[at] - 1, prefix.astype(np.uint16))
            ends = np.append(new[1:], len(at)) - 1
            tail = np.append(np.minimum.accumulate(lcp[::-1])[::-1], cap).astype(np.uint16)
            seen_tail[to[ends]] = tail[at[ends] + 1]
        if block >= len(between):
            between = np.append(between, np.zeros(len(between), np.uint16))
        between[:block] = np.minimum(between[:block], lcp.min())
        between[block] = cap
        if len(at):
            seen_block[to[ends]] = block
        block += 1


def name_pieces(text: np.ndarray, s_type: np.ndarray, star: np.ndarray) -> np.ndarray:
    """Ranks of the substrings from each S* position to the next (both included)."""
    bits = (2 * int(text.max()) + 1).bit_length()
    pack = max(1, 63 // bits)
    length = np.append(np.diff(star) + 1, 1)
    name = np.zeros(len(star), np.int64)
    open_ = np.arange(len(star))
    at = 0
    top = len(text) - 1
    while len(open_):
        word = np.zeros(len(open_), np.int64)
        for k in range(at, at + pack):
            where = np.minimum(star[open_] + k, top)
            symbol = (text[where].astype(np.int64) << 1) | s_type[where]
            word = (word << bits) | np.where(k < length[open_], symbol, 0)
        at += pack
        order = np.lexsort((word, name[open_])) if at > pack else np.argsort(word)  # at first all names are equal
        rows = open_[order]
        group, word = name[rows], word[order]
        starts = np.ones(len(rows), bool)
        starts[1:] = group[1:] != group[:-1]
        differs = starts.copy()
        differs[1:] |= word[1:] != word[:-1]
        # a group keeps the numbers from its own on: its name plus the place of the first equal piece in it
        begin = np.maximum.accumulate(np.where(starts, np.arange(len(rows)), 0))
        first = np.maximum.accumulate(np.where(differs, np.arange(len(rows)), 0))
        name[rows] = group + first - begin
        size = np.diff(np.append(np.flatnonzero(differs), len(rows)))
        alone = np.repeat(size, size) == 1
        open_ = rows[~alone & (length[rows] > at)]
    used = np.zeros(len(star), bool)
    used[name] = True
    return (np.cumsum(used) - 1)[name]


def doubling(names: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of ``names`` and common prefixes, in memory."""
    rank = names.astype(np.int64)
    levels = [rank]
    while (1 << (len(levels) - 1)) < cap and int(rank.max()) + 1 < len(rank):
        step = 1 << (len(levels) - 1)
        later = np.zeros(len(rank), np.int64)
        later[:-step] = rank[step:] + 1
        pair = rank * (int(rank.max()) + 2) + later
        order = stable_order(pair)
        new = np.empty(len(rank), np.int64)
        new[order] = np.concatenate(([0], np.cumsum(np.diff(pair[order]) != 0)))
        rank = new
        levels.append(rank)
    order = stable_order(rank)
    i, j, lcp = order[:-1].copy(), order[1:].copy(), np.zeros(len(order), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level = np.append(levels[k], -1)
        step = np.where(level[np.minimum(i, len(rank))] == level[np.minimum(j, len(rank))], 1 << k, 0)
        i, j = i + step, j + step
        lcp[1:] += step
    return order, np.minimum(lcp, cap)


def sorted_suffixes(
    text: np.ndarray, cap: int, folder: str, memory_rows: int = MEMORY_ROWS, base_symbols: int = BASE_SYMBOLS, block_rows: int = BLOCK_ROWS, depth: int = 0
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of suffix positions from the largest down, each with the common
    prefix (up to ``cap``) with the suffix before it in this order. The last
    symbol of ``text`` must be its only smallest one. Files go to ``folder``."""
    n = len(text)
    if n == 1:
        yield np.zeros(1, np.int64), np.zeros(1, np.uint16)
        return
    here = os.path.join(folder, f"level{depth}")
    os.makedirs(here)
    step = np.sign(np.diff(text.astype(np.int64))).astype(np.int8)
    change = np.where(step != 0, np.arange(n - 1), n - 1)
    change = np.append(np.minimum.accumulate(change[::-1])[::-1], n - 1)
    s_type = np.append(step, np.int8(1))[change] > 0
    star = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    names = name_pieces(text, s_type, star)
    if int(names.max()) + 1 == len(names) or len(names) <= base_symbols:
        order, common = doubling(names, cap)
    else:
        spool = Spool(here, "deeper", memory_rows)
        for pos, lcp in sorted_suffixes(names, cap, folder, memory_rows, base_symbols, block_rows, depth + 1):
            spool.add(pos, lcp)
        down, between = spool.columns()
        order, common = down[::-1], np.append(0, between[:0:-1])  # from the smallest up
    # common prefixes of neighbouring S* suffixes: equal pieces, then symbol by symbol
    seeds = star[order]
    i, j = order[:-1], order[1:]
    lcp = np.minimum(star[i + common[1:]] - star[i], cap)
    open_ = np.flatnonzero(lcp < cap)
    while len(open_):
        a, b = seeds[open_] + lcp[open_], seeds[open_ + 1] + lcp[open_]
        open_ = open_[text[np.minimum(a, n - 1)] == text[np.minimum(b, n - 1)]]
        lcp[open_] += 1
        open_ = open_[lcp[open_] < cap]
    lcp = np.append(0, lcp).astype(np.uint16)

    # up: L suffixes from S*
    queue = TupleQueue(os.path.join(here, "up"), memory_rows)
    os.makedirs(queue.folder)
    queue.push_sorted(2 * text[seeds].astype(np.int64) + 1, seeds, lcp)
    spool, waiting = Spool(here, "larger", memory_rows), cap
    for pos, lcp, induced in induce(text, None, change, queue, cap, block_rows):
        at = np.flatnonzero(induced)
        if not len(at):
            waiting = min(waiting, int(lcp.min()))
            continue
        low = np.minimum.reduceat(lcp[: at[-1] + 1], np.append(0, at[:-1] + 1))  # over the seeds between
        low[0] = min(int(low[0]), waiting)
        waiting = int(lcp[at[-1] + 1 :].min(initial=cap))
        spool.add(pos[at], low)
    # down: S suffixes from L
    larger, common = spool.columns()
    flip = int(text.max())
    queue = TupleQueue(os.path.join(here, "down"), memory_rows)
    os.makedirs(queue.folder)
    keys = np.concatenate([2 * (flip - text[np.asarray(larger[k : k + block_rows])].astype(np.int64)) + 1 for k in range(0, len(larger), block_rows)])
    queue.push_sorted(keys[::-1], larger[::-1], np.append(np.uint16(0), common[:0:-1]))
    for pos, lcp, _ in induce(text, flip, change, queue, cap, block_rows):
        yield pos, lcp
    yield np.array([n - 1]), np.zeros(1, np.uint16)
    shutil.rmtree(here)
