import json
import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from transitlens.session import build_session  # noqa: E402
from transitlens.sources import parse_reports, read_report_lines  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[4]", shuffle_partitions=8)
    # tests only: a private shared folder when the session names none
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield s


def report(id, t, seq=None, bearing=0, delay=0, ltype=3, inactive="false", stop="S"):
    """One report document as JSON text."""
    return json.dumps(
        {
            "attributes": {
                "id": str(id),
                "bearing": bearing,
                "isinactive": inactive,
                "ltype": ltype,
                "delay": delay,
                "lastupdate": t,
                "laststopid": stop,
            }
        },
        separators=(",", ":"),
    )


@pytest.fixture
def landing(tmp_path):
    """Write documents as files of a landing directory; returns its path."""

    def make(docs_per_file, name=None):
        d = tmp_path / (name or f"landing-{uuid.uuid4().hex[:6]}")
        d.mkdir()
        base = 1_600_000_000
        for i, docs in enumerate(docs_per_file):
            f = d / f"part-{i:04d}.json"
            f.write_text("\n".join(docs) + "\n")
            # a stream takes files oldest first: make the landing order explicit
            os.utime(f, (base + 10 * i, base + 10 * i))
        return str(d)

    return make


@pytest.fixture
def reports_of(spark, landing):
    """Reports DataFrame from a list of JSON documents (one file, seq = order)."""

    def make(docs):
        path = landing([docs])
        return parse_reports(read_report_lines(spark, path))

    return make
