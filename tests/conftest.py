import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import CONF, get_session

    s = get_session("tests", "local[4]", **{"spark__sql__shuffle__partitions": "4", "spark__driver__memory": "4g"} | {k.replace(".", "__"): v for k, v in CONF.items()})
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def sf():
    d = "/root/testdata/sf0.001"
    if not Path(d).exists():
        pytest.skip("no test tables")
    return d


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)
