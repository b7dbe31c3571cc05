import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from rollbook.session import configure

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "4g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rollbook-test-ckpt-"))
    configure(s)
    yield s


def rows_of(df, cols=None):
    """Sorted list of tuples for order-insensitive comparison."""
    pdf = df.toPandas() if hasattr(df, "toPandas") else df
    if cols is not None:
        pdf = pdf[cols]
    out = []
    for rec in pdf.itertuples(index=False):
        out.append(tuple(None if (v is None or (isinstance(v, float) and v != v)) else
                         (v.to_pydatetime() if hasattr(v, "to_pydatetime") else v) for v in rec))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
