import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent)]


@pytest.fixture(scope="session")
def corpus(tmp_path_factory):
    import fixture_corpus

    return fixture_corpus.write(tmp_path_factory.mktemp("corpus"))


@pytest.fixture(scope="session")
def rows():
    """doc_id and text of the corpus."""
    import fixture_corpus

    return [(r["doc_id"], r["text"]) for r in fixture_corpus.documents()]
