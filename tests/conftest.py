from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def make_session():
    from fareway.session import create_session

    scratch = tempfile.mkdtemp(prefix="fareway-test-")
    spark = create_session(
        "fareway-tests",
        spark__master="local[8]",
        spark__driver__memory="8g",
        spark__driver__host="127.0.0.1",
        spark__driver__bindAddress="127.0.0.1",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=f"{scratch}/warehouse",
        spark__checkpoint__dir=f"{scratch}/shared",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
