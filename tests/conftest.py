import itertools
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace import build_session  # noqa: E402
from millrace.sinks.tables import FactTable  # noqa: E402
from millrace.streaming.runner import run_once  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def stream_of(spark, tmp_path):
    """Write tables file by file and read them back as one stream, one file per micro-batch."""
    numbers = itertools.count()

    def make(*parts):
        folder = tmp_path / f"in{next(numbers)}"
        for i, part in enumerate(parts):
            part.coalesce(1).write.mode("append").parquet(str(folder))
            newest = max(folder.glob("*.parquet"), key=os.path.getmtime)
            os.utime(newest, (1_700_000_000 + i, 1_700_000_000 + i))
        return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(str(folder))

    return make


@pytest.fixture
def drain(spark, tmp_path):
    """Run a stream to the end of its input; the rows and the finished query."""
    numbers = itertools.count()

    def run(df, mode="append", name=None):
        name = name or f"out{next(numbers)}"
        sink = FactTable(str(tmp_path / name / "rows"))
        query = run_once(df, sink.append, str(tmp_path / name / "checkpoint"), mode)
        return sink.read(spark), query

    return run


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
