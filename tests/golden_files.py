"""Where the test data lies."""

import os
import re

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMALL = "/root/testdata/sf0.001"


def fixture_file(column: str) -> str:
    """Path of the fixture with that column, as FIXTURES.md lists it."""
    text = open(f"{ROOT}/FIXTURES.md", encoding="utf-8").read()
    base = re.search(r"Paths under `([^`]+)`", text).group(1)
    row = next(line for line in text.splitlines() if line.startswith("|") and column in line.split("|")[3])
    path = os.path.join(base, row.split("|")[1].strip())
    if not os.path.exists(path):
        pytest.skip("fixture files are not here")
    return path
