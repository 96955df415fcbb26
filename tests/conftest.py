import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from boxloom.session import build

    session = build("local[4]", partitions=4, memory="4g")
    yield session
    session.stop()
