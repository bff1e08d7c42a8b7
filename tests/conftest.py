import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hitledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def lines(spark):
    def make(*texts):
        return spark.createDataFrame([(t,) for t in texts], "line string")

    return make


def request_line(
    ip="1.2.3.4", host="example.com", time="01/Oct/2025:05:41:30 +0000", request="GET /a HTTP/2.0",
    status="200", size="512", referrer="-", agent="GPTBot/1.0", tail=" | TLSv1.3 | 0.027 0.030 0.031 MISS 0 NC:000000 UP:-",
):
    return f'{ip} {host} - [{time}] "{request}" {status} {size} "{referrer}" "{agent}"{tail}'


@pytest.fixture
def line():
    return request_line
