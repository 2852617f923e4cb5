import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pricelens.session import get_spark
    s = get_spark("local[4]", app="pricelens-tests", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="pricelens-test-ckpt-")})
    yield s
    s.stop()


def rows(df, order=None):
    d = df.toPandas()
    if order:
        d = d.sort_values(order).reset_index(drop=True)
    return d
