"""Random trade sequences: chunk-parallel Spark batch == sequential loop."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from candlewick.functions.exprs import ms_to_ts
from candlewick.operators import detect as D
from candlewick.params import Params
from seqloop import run

T0 = 1_704_110_400_000


@st.composite
def sequences(draw):
    n = draw(st.integers(min_value=30, max_value=400))
    syms = draw(st.lists(st.sampled_from(["A", "B", "C"]), min_size=n, max_size=n))
    gaps = draw(st.lists(st.sampled_from([0, 0, 5, 300, 1_000, 4_000, 9_000, 40_000, 250_000]), min_size=n, max_size=n))
    moves = draw(st.lists(st.integers(min_value=-40, max_value=40), min_size=n, max_size=n))
    qtys = draw(st.lists(st.integers(min_value=1, max_value=30), min_size=n, max_size=n))
    rows, ms, price = [], T0, {s: 100.0 for s in "ABC"}
    for i in range(n):
        ms += gaps[i]
        s = syms[i]
        price[s] = max(1.0, round(price[s] + moves[i] / 100.0, 2))
        rows.append((s, i + 1, price[s], float(qtys[i]), ms))
    chunk_rows = draw(st.sampled_from([3, 11, 50, 2_000_000]))
    halo = draw(st.sampled_from([0, 30_000, 600_000]))
    # hour-long grains make every grain "hot", so chunks split at milliseconds
    grain = draw(st.sampled_from([1_000, 60_000, 3_600_000]))
    return rows, Params(chunk_rows=chunk_rows, seq_halo_ms=halo, grain_ms=grain, seq_halo_rows=draw(st.sampled_from([5, 50_000])))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(sequences())
def test_batch_detectors_equal_sequential_loop(spark, case):
    rows, p = case
    df = spark.createDataFrame(rows, "symbol string, trade_id long, price double, quantity double, trade_time_ms long")
    df = df.withColumn("event_ts", ms_to_ts("trade_time_ms"))
    got = {(r.symbol, r.pattern_type, r.trade_id) for r in D.anomaly_events(df, p).collect()}
    assert got == run(rows)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False),
            st.integers(min_value=-10**6, max_value=10**6).map(lambda k: k / 8),  # exact binary ties
            st.integers(min_value=0, max_value=10**5).map(lambda k: k / 1000 + 100),
        ),
        min_size=20,
        max_size=200,
    )
)
def test_render_matches_python_format(spark, values):
    from candlewick.functions.exprs import render

    template = "a={x:.2f} b={x:.1f} c={x:.0f} d={x:>12,.2f} e={x:<14.6f}|"
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r.t for r in df.select(render(template, x="x").alias("t")).collect()]
    assert got == [template.format(x=float(v)) for v in values]
