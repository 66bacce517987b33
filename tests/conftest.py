from __future__ import annotations

import os

os.environ.setdefault("SPARK_DRIVER_MEMORY", "4g")

import pytest

from riskpanel.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", cores=4, scratch=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()
