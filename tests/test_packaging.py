"""The package's Python functions reach executors without an install, and
cheap derived inputs equal what they stand in for."""

import os
import subprocess
import sys

SF_SMALL = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_grouped_map_functions_pickle_by_value():
    from pyspark import cloudpickle

    from ticklake.operators import indicators, vectors
    for mod in (indicators, vectors):
        assert cloudpickle.cloudpickle._is_registered_pickle_by_value(mod)


def test_bar_dates_are_the_bars_dates(spark):
    from ticklake.sources import fixtures as fx
    bars = {r[0] for r in fx.bars(spark, SF_SMALL).select("trade_date").distinct().collect()}
    ship = {r[0] for r in fx.bar_dates(spark, SF_SMALL).distinct().collect()}
    assert bars == ship


def test_grouped_map_runs_from_another_working_directory(tmp_path):
    """A driver outside the repository (workers cannot import ``ticklake``
    from their working directory) still runs the Arrow grouped map."""
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from ticklake.session import build_session\n"
        "from ticklake.plans.catalog import REGISTRY\n"
        "s = build_session('local[2]', shuffle_partitions=2)\n"
        "s.sparkContext.setLogLevel('ERROR')\n"
        "print('ROWS', REGISTRY['enriched_prices'](s, %r).count())\n"
    ) % (REPO, SF_SMALL)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "ROWS " in out.stdout


def test_recent_clean_dates_equal_the_full_calendar(spark):
    """Candidate path (n small) and fallback path (n above the number of
    dates) both give the n newest dates of the clean bars."""
    from pyspark.sql import functions as F

    from ticklake.plans import catalog
    full = [r[0] for r in catalog.clean_bars(spark, SF_SMALL).select("trade_date").distinct()
            .orderBy(F.desc("trade_date")).collect()]
    for n in (5, 20, len(full) + 7):
        got = catalog.recent_clean_dates(spark, SF_SMALL, n)
        dates = sorted((r[0] for r in got.select("trade_date").distinct().collect()), reverse=True)
        assert dates[:n] == full[:n]
