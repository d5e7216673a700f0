import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from finseries.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", 8)
    yield s


BAR_SCHEMA = ("symbol string, name string, date date, open double, high double, low double, "
              "close double, volume double")


@pytest.fixture
def bars(spark):
    """Build a bar table from (symbol, 'YYYY-MM-DD', close[, open]) tuples."""
    import datetime as dt

    def make(rows):
        out = []
        for r in rows:
            sym, day, close = r[0], r[1], r[2]
            opn = r[3] if len(r) > 3 else close
            out.append((sym, f"Name {sym}", dt.date.fromisoformat(day), opn, close, close, close, 1.0))
        return spark.createDataFrame(out, BAR_SCHEMA)
    return make
