import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests import golden  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from veridq.session import local_session, work_dir

    s = local_session(cpus="*", shuffle_partitions=8)
    work_dir(s)  # private scratch folder when spark.checkpoint.dir is unset
    yield s


@pytest.fixture(scope="session")
def raw_csv_path():
    d = tempfile.mkdtemp(prefix="veridq-golden-")
    p = os.path.join(d, "customers_raw.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write(golden.RAW_CSV.lstrip("\n"))
    return p


@pytest.fixture(scope="session")
def raw(spark, raw_csv_path):
    from veridq.sources.csv import read_strings
    from veridq.sources.rownum import with_row_num

    df = read_strings(spark, raw_csv_path).drop("_corrupt_record")
    return with_row_num(df).cache()


SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
