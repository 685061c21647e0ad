from datetime import date

import pytest

from hoptrail.jobs import compact, ingest
from hoptrail.operators.upkeep import REPORT_DDL, Selection

ROOTS = ["--landing", "l", "--history", "h"]


def test_compact_options():
    def chosen(*args):
        return compact.selection(compact.parse([*ROOTS, *args]))

    assert chosen() == Selection()
    assert chosen("--date", "2024-01-31") == Selection(day=date(2024, 1, 31))
    assert chosen("--recent", "6") == Selection(recent_hours=6)
    assert chosen("--yesterday") == Selection.yesterday()
    with pytest.raises(SystemExit):
        chosen("--recent", "6", "--yesterday")
    with pytest.raises(ValueError):
        chosen("--recent", "0")


def test_ingest_needs_all_options():
    with pytest.raises(SystemExit):
        ingest.parse(["--zone", "zone1"])


def test_summary_of_a_compaction(spark):
    rows = [("z", 2024, 1, 1, h, "compact", 3, 1, 10) for h in (1, 2)] + [("z", 2024, 1, 1, 3, "up_to_date", 1, None, None)]
    got = {r.action: r for r in compact.summary(spark.createDataFrame(rows, REPORT_DDL)).collect()}
    assert tuple(got["compact"]) == ("compact", 2, 6, 2, 20)
    assert got["up_to_date"].rows is None
