import os
import subprocess
import sys

import pytest

from tests.conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args: str) -> str:
    out = subprocess.run(
        [sys.executable, "-m", "tillroll", "--master", "local[2]", *args],
        cwd=ROOT, capture_output=True, text=True, timeout=600, check=True,
    )
    return out.stdout


def test_list_names_every_query():
    from tillroll import registry

    assert set(_run("list").split()) == set(registry.QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")
def test_query_command_prints_rows():
    out = _run("query", "segment_stats", "--tables", SF_SMALL)
    assert "Champions" in out and "montant_total" in out
