import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)).rsplit("/", 1)[0])

# Golden-value inputs (the clinical data files the published numbers were
# computed from) are given by path through the environment; tests that need
# them are skipped when a path is unset or missing:
#   TABFORGE_RAW_CSV          raw 14-column table with '?' gaps
#   TABFORGE_CLEANED_CSV      the published cleaned table
#   TABFORGE_ASSIGNMENTS_CSV  published cluster assignments (sample_id, true_label, kmeans_cluster, hierarchical_cluster)
#   TABFORGE_HISTORY_JSON     published prediction history (JSON array)
GOLDEN = {k: os.environ.get(f"TABFORGE_{k}", "") for k in ("RAW_CSV", "CLEANED_CSV", "ASSIGNMENTS_CSV", "HISTORY_JSON")}
SF_SMALL = "/root/testdata/sf0.001"


def golden(name: str) -> str:
    return GOLDEN[name]


def needs(*names):
    missing = [n for n in names if not (GOLDEN[n] and os.path.exists(GOLDEN[n]))]
    return pytest.mark.skipif(bool(missing), reason=f"golden inputs not given: {missing}")


@pytest.fixture(scope="session")
def spark():
    from tabforge.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()
