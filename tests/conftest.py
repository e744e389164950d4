import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pressloom.policy import Policy  # noqa: E402
from pressloom.schemas import REGISTRY_DEFAULTS, REGISTRY_ENTRY, STORE  # noqa: E402
from pressloom.session import local_session  # noqa: E402

NOW = dt.datetime(2026, 9, 23, 3, 0, 0)
UTC = dt.timezone.utc


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4)
    # Fixtures are tiny: compiling each plan would take longer than running it.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()


def stamp(text):
    return dt.datetime.fromisoformat(text.replace("Z", "+00:00"))


def frame(spark, schema, rows):
    """Rows given as dicts; absent fields are null."""
    return spark.createDataFrame([tuple(row.get(f.name) for f in schema.fields) for row in rows], schema)


def news(ident="a", source_id="news", seq=0, **fields):
    row = {
        "source_id": source_id, "title": f"电影测试 {ident}", "summary": "电影发布海报",
        "published": "2026-09-23T03:00:00+00:00", "url": f"https://example.com/article?id={ident}",
        "image_url": "", "video_url": "", "arrival_seq": seq,
        "first_seen_at": stamp("2026-09-23T03:00:00Z"), "last_seen_at": stamp("2026-09-23T03:00:00Z"),
    }
    return {**row, **fields}


def store_frame(spark, rows):
    return frame(spark, STORE, [{**row, "arrival_seq": row.get("arrival_seq") or i} for i, row in enumerate(rows)])


def source(ident="news", **fields):
    base = {**REGISTRY_DEFAULTS, "id": ident, "name": "测试来源", "enabled": True, "type": "rss", "market": "m-cn",
            "source_class": "trade_media", "language": "zh"}
    return {**base, **fields}


def registry_frame(spark, sources):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    schema = T.StructType(REGISTRY_ENTRY.fields + [T.StructField("source_order", T.IntegerType())])
    rows = [{**row, "source_order": i} for i, row in enumerate(sources)]
    return frame(spark, schema, rows).withColumnRenamed("id", "source_id")


POLICY = Policy(required_markets=("m-cn", "m-hmt"), max_age_hours=120, allow_carry_forward=False)
