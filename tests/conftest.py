import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.config import ensure_checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="*", shuffle_partitions=8, app="strata-tests")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture
def scratch():
    """A fresh scratch folder per test (never reused, never wiped)."""
    return tempfile.mkdtemp(prefix="strata-test-")


def articles_df(spark, texts):
    """Articles ``(doc_id, title, text)`` from texts, titles "1", "2", ..."""
    from strata.sources.memory import articles
    return articles(spark, [(str(i + 1), t) for i, t in enumerate(texts)])
