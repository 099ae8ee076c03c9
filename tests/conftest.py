import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from dossierflow.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch"))})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def texts(spark):
    """Evaluate a column function on literal texts."""

    def run(fn, values, ddl="string"):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {ddl}")
        return [r.out for r in rows.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]

    return run


@pytest.fixture
def parse(spark):
    """Payload and processed record of one page's body."""

    def run(body, wrap=True, **options):
        from dossierflow.plans.payloads import build_payloads
        from dossierflow.plans.processed import assemble_processed

        html = f"<html><body><div id='resume_1'>{body}</div></body></html>" if wrap else body
        page = spark.createDataFrame([("https://x/resumes/1/", html)], "source_url string, html string")
        made = build_payloads(page, as_of="2026-01-01 00:00:00", **options)
        both = assemble_processed(made, as_of="2026-01-01", keys=tuple(made.columns))
        return both.first()

    return run
