"""SCD2 (K1) against a plain-Python model on random snapshot sequences.

Invariants checked on every example: the rows equal the model's; exactly
one open row per symbol; versions run 1..n without gaps; each closed row
ends the day before the next version starts; surrogate keys are unique.
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ticklake.operators import dims

SCHEMA = "symbol bigint, company_name string, sector string, industry string, exchange string"
START = dt.date(2024, 1, 1)

attrs = st.tuples(st.sampled_from(["A", "B"]), st.sampled_from(["S1", "S2", None]),
                  st.sampled_from(["I1", "I2"]), st.just("X"))
snapshot = st.dictionaries(st.integers(1, 4), attrs, max_size=4)


def model(snapshots):
    """symbol -> list of [attrs, version, is_current, effective_from, effective_to]."""
    out: dict[int, list] = {}
    for i, snap in enumerate(snapshots):
        as_of = START + dt.timedelta(days=30 * i)
        for sym, a in snap.items():
            rows = out.setdefault(sym, [])
            if not rows:
                rows.append([a, 1, True, as_of, None])
            elif rows[-1][0] != a:      # tuple equality: None == None, as <=> does
                rows[-1][2], rows[-1][4] = False, as_of - dt.timedelta(days=1)
                rows.append([a, rows[-1][1] + 1, True, as_of, None])
    return sorted(((s, *a, v, cur, f, t) for s, rows in out.items() for a, v, cur, f, t in rows), key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(snapshot, min_size=1, max_size=4))
def test_scd2_matches_model(spark, snapshots):
    d = dims.empty_dim(spark)
    for i, snap in enumerate(snapshots):
        rows = [(s, *a) for s, a in snap.items()]
        d = dims.scd2_upsert(d, spark.createDataFrame(rows, SCHEMA), START + dt.timedelta(days=30 * i))
    got = d.collect()
    cols = ("symbol", "company_name", "sector", "industry", "exchange", "version", "is_current",
            "effective_from", "effective_to")
    assert sorted((tuple(r[c] for c in cols) for r in got), key=repr) == model(snapshots)

    by_symbol: dict[int, list] = {}
    for r in got:
        by_symbol.setdefault(r["symbol"], []).append(r)
    for rows in by_symbol.values():
        rows.sort(key=lambda r: r["version"])
        assert [r["version"] for r in rows] == list(range(1, len(rows) + 1))
        assert sum(r["is_current"] for r in rows) == 1 and rows[-1]["is_current"]
        for a, b in zip(rows, rows[1:]):
            assert a["effective_to"] == b["effective_from"] - dt.timedelta(days=1)
    keys = [r["company_key"] for r in got]
    assert len(keys) == len(set(keys))
