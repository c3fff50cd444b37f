"""Bucketed two-level scans equal their naive sequential definitions for any bucket width."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelson.plans import ordered

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 60), st.sampled_from([-1.0, 0.0, 1.0, 2.0, 5.0])),
    min_size=1, max_size=80, unique_by=lambda r: (r[0], r[1]))
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _df(spark, rows):
    return spark.createDataFrame(rows, "k string, seq long, v double")


def _by_key(rows):
    out = {}
    for k, s, v in sorted(rows):
        out.setdefault(k, []).append((s, v))
    return out


@SETTINGS
@given(rows=rows_strategy, bw=st.sampled_from([1, 3, 8, 1000]), direction=st.sampled_from([1, -1]))
def test_shift(spark, rows, bw, direction):
    got = {(r.k, r.seq): (r.p_seq, r.p_v) for r in
           ordered.shift(_df(spark, rows), ["k"], "seq", ["v"], direction, "p_", bw).collect()}
    for k, seq_vals in _by_key(rows).items():
        for i, (s, _) in enumerate(seq_vals):
            j = i - direction
            exp = seq_vals[j] if 0 <= j < len(seq_vals) else (None, None)
            assert got[(k, s)] == exp


@SETTINGS
@given(rows=rows_strategy, bw=st.sampled_from([1, 2, 5, 1000]), inclusive=st.booleans())
def test_running_sum(spark, rows, bw, inclusive):
    df = ordered.running_sum(_df(spark, rows), ["k"], "seq", {"n": F.lit(1), "s": F.col("v")}, inclusive, bw)
    got = {(r.k, r.seq): (r.n, r.s) for r in df.collect()}
    for k, seq_vals in _by_key(rows).items():
        n = s_ = 0
        for s, v in seq_vals:
            if inclusive:
                n, s_ = n + 1, s_ + v
            assert got[(k, s)] == (n, s_)
            if not inclusive:
                n, s_ = n + 1, s_ + v


@SETTINGS
@given(rows=rows_strategy, bw=st.sampled_from([1, 4, 1000]), keyed=st.booleans())
def test_change_count_matches_fold(spark, rows, bw, keyed):
    keys = ["k"] if keyed else []
    if not keyed:  # one sequence: make seq unique across keys
        rows = [(k, s * 3 + "abc".index(k), v) for k, s, v in rows]
    df = ordered.change_count(_df(spark, rows), keys, "seq", "v", lambda p, c: c < p, "idx",
                              first_prev=F.lit(0.0), start_col="st", bucket_width=bw)
    got = {(r.k, r.seq): (r.idx, r.st) for r in df.collect()}
    groups = _by_key(rows) if keyed else {None: sorted((s, v) for _, s, v in rows)}
    lookup = {s: k for k, s, _ in rows}
    for key, seq_vals in groups.items():
        idx, last = 0, 0.0
        for s, v in seq_vals:
            changed = v < last
            idx += changed
            last = v
            assert got[(key if keyed else lookup[s], s)] == (idx, changed)


@SETTINGS
@given(rows=rows_strategy, bw=st.sampled_from([1, 4, 1000]))
def test_change_count_runs(spark, rows, bw):
    df = ordered.change_count(_df(spark, rows), ["k"], "seq", "v", lambda p, c: c != p, "run",
                              first_prev=None, start_col="st", bucket_width=bw)
    got = {(r.k, r.seq): (r.run, r.st) for r in df.collect()}
    for k, seq_vals in _by_key(rows).items():
        run, last = 0, None
        for s, v in seq_vals:
            start = last is None or v != last
            run += start
            last = v
            assert got[(k, s)] == (run, start)
