import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cumulus.session import get_session
    s = get_session("local[4]", 4)
    yield s


def rows(df, cols=None, digits=6):
    """Sorted rows with doubles rounded, for order-insensitive comparison."""
    import math
    cols = cols or df.columns
    out = []
    for r in df.select(*cols).collect():
        t = []
        for v in r:
            if isinstance(v, float):
                v = None if math.isnan(v) else round(v, digits) + 0.0
            t.append(v)
        out.append(tuple(t))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
