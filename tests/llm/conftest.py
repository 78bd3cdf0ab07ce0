import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def file_of(name):
    public = pytest.importorskip("public_tokenizers")
    return public.path(name)


@pytest.fixture(scope="session")
def vocabulary():
    return file_of
