import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from labelfold.session import build_session, remove_scratch, shared_dir
    s = build_session("local[*]", app="labelfold-tests", shuffle_partitions=8)
    shared_dir(s)  # local master: a private scratch folder when none is configured
    yield s
    remove_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def micro(spark):
    """The hand-made frame of FIXTURES.md section 3 (labels a, b, c)."""
    from labelfold.functions.dictionary import make_dictionary
    from labelfold.operators.frame import EvalFrame
    rows = [
        (0, [1, 0, 0], [0.9, 0.2, 0.1]),
        (1, [1, 1, 0], [0.8, 0.5, 0.1]),
        (2, [0, 1, 0], [0.4, 0.7, 0.1]),
        (3, [0, 0, 0], [0.4, 0.3, 0.6]),
        (4, [0, 1, 0], [0.6, 0.2, 0.2]),
        (5, [0, 0, 0], [0.1, 0.1, 0.1]),
    ]
    df = spark.createDataFrame(rows, "row_id long, y_true array<int>, score array<double>")
    return EvalFrame(df, ("row_id",), make_dictionary(["a", "b", "c"]))


SF_SMALL = "/root/testdata/sf0.001"
