"""One local session for all tests, and the tiny tables they share."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chorale.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests",
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def songs(spark):
    return spark.createDataFrame(
        [
            (1, "Hey Jude", "The Beatles"),
            (2, "Lose Yourself", "Eminem"),
            (3, "Old Town Road", "Lil Nas X"),
            (4, "Beyoncé Song", "Beyoncé"),
        ],
        "id int, title string, artist string",
    )


@pytest.fixture(scope="session")
def tracks(spark):
    return spark.createDataFrame(
        [
            (11, "Hey Jude - Remastered 2009", "The Beatles"),
            (12, "Lose Yourself - From '8 Mile' Soundtrack", "Eminem"),
            (13, "Old Town Road", "Lil Nas X; Billy Ray Cyrus"),
            (14, "Drunk in Love", "Beyonce, Jay-Z"),
        ],
        "id int, track_name string, artists string",
    )
