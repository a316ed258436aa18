import os
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from roadledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", master=f"local[{os.environ.get('TEST_CPUS', '8')}]",
        spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false",
        spark__driver__extraJavaOptions="-XX:TieredStopAtLevel=1",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=repr) if not order else [
        tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture
def telemetry_of(spark):
    """Canonical telemetry from a few values per row; the rest is NULL."""
    from pyspark.sql import functions as F

    from roadledger.schemas import TELEMETRY

    def make(*records, **defaults):
        full = [{**defaults, **r} for r in records]
        names = sorted({k for r in full for k in r})
        types = {f.name: f.dataType.simpleString() for f in TELEMETRY}
        types["event_ts"] = types["date"] = "string"
        # An Arrow table becomes a local relation, which needs no Python worker.
        schema = to_arrow_schema(StructType.fromDDL(", ".join(f"{n} {types[n]}" for n in names)))
        df = spark.createDataFrame(pa.Table.from_pylist([{n: r.get(n) for n in names} for r in full], schema))
        if "event_ts" in names and "date" not in names:
            df = df.withColumn("date", F.col("event_ts").cast("timestamp").cast("date"))
        return df.select(*[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TELEMETRY
        ])

    return make
