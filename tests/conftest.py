import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from meterline.session import local_session

    session = local_session("8", partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def few(monkeypatch):
    """A small draw of the grid of series models, so that searches are quick."""
    from meterline import config
    from meterline.operators.series_models import Kind

    draw = Kind.candidates
    monkeypatch.setattr(Kind, "candidates", lambda self, budget=12, seed=config.SEED: draw(self, min(budget, 12), seed))
