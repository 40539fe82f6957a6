"""Plain Python versions of the corpus operators, for small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections import Counter, defaultdict


def words(text):
    return (text or "").encode().lower().split()


def fold(doc_id, modulus):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def simhash(text, n=3):
    import xxhash

    toks = words(text)
    if not toks:
        return 0
    shingles = [b" ".join(toks[i : i + n]) for i in range(len(toks) - n + 1)] or [b" ".join(toks)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(rows, n=3, bits=2):
    """rows: (doc_id, text) -> component id per row."""
    fps = [simhash(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            best[r] = min(d, best.get(r, d))
    return fps, [best.get(find(i)) for i in range(len(rows))]


class SequentialTree:
    """Context-tree weighting as published: nodes updated bit by bit."""

    def __init__(self, depth):
        self.depth, self.nodes = depth, defaultdict(lambda: [0, 0, 0.0, 0.0])  # zeros, ones, log estimate, log weighted

    def _path(self, context, node):
        return [(context[len(context) - d :], node) for d in range(self.depth + 1)]

    def predict(self, context, node, bit):
        p = None
        for d in range(self.depth, -1, -1):
            key = (context[len(context) - d :], node)
            z, o, est, wei = self.nodes.get(key, (0, 0, 0.0, 0.0))[:4]
            kt = ((o if bit else z) + 0.5) / (z + o + 1)
            if p is None:
                p = kt
            else:
                own = math.exp(est - math.log(2) - wei) if key in self.nodes else 0.5
                p = own * kt + (1 - own) * p
        return p

    def learn(self, context, node, bit):
        change = 0.0
        for d in range(self.depth, -1, -1):
            at = self.nodes[(context[len(context) - d :], node)]
            at[2] += math.log((at[bit] + 0.5) / (at[0] + at[1] + 1))
            at[bit] += 1
            if d == self.depth:
                new = at[2]
            else:
                at.append(0.0) if len(at) == 4 else None
                at[4] += change  # sum of the children's log weights
                new = max(at[2], at[4]) + math.log1p(math.exp(-abs(at[2] - at[4]))) - math.log(2)
            change = new - at[3]
            at[3] = new

    def steps(self, text):
        stream = b"\n" * self.depth + b" ".join(words(text)) + b"\n"
        for i in range(self.depth, len(stream)):
            context, node = stream[i - self.depth : i], 1
            for k in range(7, -1, -1):
                bit = stream[i] >> k & 1
                yield context, node, bit
                node = node * 2 + bit


def ctw_scores(rows, depth, folds=7, held=2):
    tree, counts, out = SequentialTree(depth), Counter(), []
    for d, t in rows:
        if fold(d, folds) != held:
            counts.update(words(t) + [b"\n"])
            for step in tree.steps(t):
                tree.learn(*step)
    n, v = sum(counts.values()), len(counts)
    for d, t in rows:
        toks = words(t) + [b"\n"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in toks)
        score = sum(math.log10(tree.predict(*step)) for step in tree.steps(t))
        out.append((d, fold(d, folds) == held, len(toks), sum(counts[w] > 0 for w in toks), n, base, score))
    return out


def profile_grams(text):
    import unicodedata

    clean = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text.lower()).split()
    found = Counter()
    for w in clean:
        padded = f" {w} "
        found.update(w)
        found.update(padded[i : i + 2] for i in range(len(padded) - 1))
        found.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return found


def code(gram):
    n = 0
    for c in gram:
        n = n << 21 | ord(c)
    return n


def rank_order(rows, top=300, folds=4, held=2):
    """rows: (doc_id, text, lang) -> (lang, score) per row."""
    sums = defaultdict(Counter)
    for d, t, lang in rows:
        if fold(d, folds) != held and lang is not None and t is not None:
            sums[lang].update(profile_grams(t))
    ranked = lambda c: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], code(x[0])))[:top]]
    profiles = {lang: {g: r for r, g in enumerate(ranked(c))} for lang, c in sums.items() if c}
    out = []
    for _, t, _ in rows:
        mine = ranked(profile_grams(t or ""))
        if not mine or not profiles:
            out.append(("und", 0.0))
            continue
        dist = {lang: sum(abs(p[g] - r) if g in p else top for r, g in enumerate(mine)) for lang, p in profiles.items()}
        best = min(sorted(dist, key=lambda s: s.encode()), key=dist.get)
        out.append((best, 1 - dist[best] / (top * len(mine))))
    return out


def targets(sizes, weights=(5, 2, 1), share=1.5):
    """sizes: source -> words. Shares the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        left = total - sum(full.values())
        w = sum(weight[s] for s in open_)
        goal = {s: left * weight[s] / w for s in open_} if open_ else {}
        over = [s for s in open_ if goal[s] > 2 * sizes[s]]
        if not over:
            return {**full, **goal}
        full |= {s: 2.0 * sizes[s] for s in over}


def mix_copies(rows, seed="mix"):
    """rows: (doc_id, text, source) -> (size, source size, target, copies)."""
    size = [len(words(t)) for _, t, _ in rows]
    per = Counter()
    for (_, _, s), n in zip(rows, size):
        per[s] += n
    goal = targets(per)
    h = [int(hashlib.md5(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:15], 16) for d, _, _ in rows]
    copies = [0] * len(rows)
    for s in per:
        mine = [i for i, r in enumerate(rows) if r[2] == s]
        for budget in (min(goal[s], per[s]), goal[s] - per[s]):
            if budget <= 0:
                continue
            if budget >= per[s]:
                for i in mine:
                    copies[i] += 1
                continue
            done = 0
            for value in sorted({h[i] for i in mine}):
                tied = [i for i in mine if h[i] == value]
                n = sum(size[i] for i in tied)
                if done >= budget or (done + n >= budget and 2 * (budget - done) < n):
                    break
                for i in tied:
                    copies[i] += 1
                done += n
    return [(n, per[r[2]], goal[r[2]], c) for n, r, c in zip(size, rows, copies)]


def bpe():
    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe_row(tool, text):
    ids = tool.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def pipeline(rows):
    """rows: (doc_id, text, lang, source)."""
    langs = rank_order([(d, t, lang) for d, t, lang, _ in rows])
    unseen = sorted(score for r, (lang, score) in zip(rows, langs) if fold(r[0], 4) == 2 and lang == r[2])
    bar = 0.75 * unseen[max(0, math.ceil(0.001 * len(unseen)) - 1)] if unseen else 0.0
    rows = [r for r, (lang, score) in zip(rows, langs) if lang != "und" and score >= bar]
    top = {}
    for d, t, *_ in rows:
        top[t or ""] = max(d, top.get(t or "", d))
    rows = [r for r in rows if r[0] == top[r[1] or ""]]
    _, comp = near_components([(d, t) for d, t, *_ in rows])
    rows = [r for r, c in zip(rows, comp) if r[0] == c]
    mixed = mix_copies([(d, t, s) for d, t, _, s in rows])
    tool = bpe()
    return sorted((r[0], *bpe_row(tool, r[1])) for r, m in zip(rows, mixed) for _ in range(m[3]))
