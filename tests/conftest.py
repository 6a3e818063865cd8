import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tessera.session import local_session
    yield local_session(cores=8, shuffle_partitions=8, app="tessera-tests",
                        checkpoint_dir=str(tmp_path_factory.mktemp("checkpoints")))


SF_SMALL = "/root/testdata/sf0.001"
