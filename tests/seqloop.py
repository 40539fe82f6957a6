"""The three rules stated one by one over plain lists (test oracle).

Every row looks back over its symbol's list by index; nothing is carried from
row to row. No Spark, no chunks, no code shared with the library.
"""


def _of_symbol(trades, symbol):
    return sorted((t for t in trades if t[0] == symbol), key=lambda t: (t[4], t[1]))


def wash(rows, frame, warm, swing_min, size_min):
    for i, (_, tid, _, quantity, _) in enumerate(rows):
        last = rows[max(0, i + 1 - frame) : i + 1]
        if len(last) < warm:
            continue
        low, high, total = min(t[2] for t in last), max(t[2] for t in last), 0.0
        for t in last:  # oldest first, as a window sums
            total += t[3]
        mean = total / len(last)
        if low > 0 and mean > 0 and (high - low) / low * 100 >= swing_min and quantity / mean >= size_min:
            yield tid


def spikes(rows, window, frame, warm, times_min, cool):
    times = [t[4] for t in rows]
    seen = [sum(times[i] - t <= window for t in times[: i + 1]) for i in range(len(rows))]
    able = []
    for i in range(warm - 1, len(rows)):
        base = seen[max(0, i + 1 - frame) : i + 1]
        if seen[i] / (sum(base) / len(base)) >= times_min:
            able.append(i)
    after = 0
    while any(times[i] > after + cool for i in able):
        i = next(i for i in able if times[i] > after + cool)
        after = times[i]
        yield rows[i][1]


def pumps(rows, rise_min, drop_min, timeout):
    """From baseline to baseline (prices in tests are positive)."""

    def ends(b, i):
        peak = max(t[2] for t in rows[b : i + 1])
        late = rows[i][4] - rows[b][4] > timeout
        dump = (peak - rows[b][2]) / rows[b][2] * 100 >= rise_min and (peak - rows[i][2]) / peak * 100 >= drop_min
        return "late" if late else "dump" if dump else None

    b = 0
    while b < len(rows):
        i = next((i for i in range(b + 1, len(rows)) if ends(b, i)), None)
        if i is None:
            return
        if ends(b, i) == "dump":
            yield rows[i][1]
        b = i + 1


def run(trades, frame=60, warm=20, swing_min=0.3, vol_min=1.5, win=10_000, hist=60, hist_min=6, spike_min=2.0,
        cool=30_000, rise_min=0.4, drop_min=0.3, timeout=240_000):
    """trades: iterable of (symbol, trade_id, price, quantity, ms). Returns a
    set of (symbol, pattern, trade_id)."""
    trades, out = list(trades), set()
    for symbol in {t[0] for t in trades}:
        rows = _of_symbol(trades, symbol)
        out |= {(symbol, "WASH_TRADE", i) for i in wash(rows, frame, warm, swing_min, vol_min)}
        out |= {(symbol, "VOLUME_SPIKE", i) for i in spikes(rows, win, hist, hist_min, spike_min, cool)}
        out |= {(symbol, "PUMP_AND_DUMP", i) for i in pumps(rows, rise_min, drop_min, timeout)}
    return out
