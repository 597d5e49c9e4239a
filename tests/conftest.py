import os
import sys
from pathlib import Path

# One thread, as in Spark's workers, set before numpy is loaded: after the fork that starts Spark's JVM, a call
# that OpenBLAS deals out to its threads may wait for ever.
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")

import pytest  # noqa: E402

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from terrier.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
