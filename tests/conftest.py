from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from brisa import build_session

    s = build_session("tests", "local[4]", 4, "4g", **{"spark.ui.enabled": "false",
                                                       "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
