import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from meterflow.session import get_session, shared_dir
    s = get_session("local[4]", app="meterflow-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="meterflow-wh-")})
    shared_dir(s)  # sets a scratch checkpoint dir when the session has none
    yield s
    s.stop()
