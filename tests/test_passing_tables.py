"""A job's tables go with it, not when the driver ends, and the files of its shuffles as each action ends."""

from __future__ import annotations

from pathlib import Path

import pytest

from jobs import common, sample_report
from psmlake.operators import lineage
from psmlake.queries import features


@pytest.fixture
def folder(tmp_path, monkeypatch):
    monkeypatch.setattr(lineage, "shared_folder", lambda spark: f"file://{tmp_path}")
    return Path(tmp_path)


def test_blocks_within_blocks(spark, folder):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with lineage.passing(spark):
        with lineage.passing(spark) as kept:
            first = lineage.cut(spark.range(5))
            second = kept(first.groupBy("id").count())
            assert spark.conf.get(key) == "true"
        assert second.count() == 5 and len(list(folder.glob("table-*"))) == 1
    assert not list(folder.glob("table-*")) and spark.conf.get(key, None) == before
    with pytest.raises(ZeroDivisionError), lineage.passing(spark):
        lineage.cut(spark.range(5))
        raise ZeroDivisionError
    assert not list(folder.glob("table-*"))


def test_a_report_leaves_its_reports_only(spark, folder):
    settings = common.config(sample_report.CONFIG, sample_report.DEFAULTS)
    rows = [sorted(map(tuple, sample_report.run(spark, "/root/testdata/sf0.001/lineitem.parquet", f"file://{folder}/out", settings).collect())) for _ in range(2)]
    assert rows[0] == rows[1] and not list(folder.glob("table-*"))


def test_learned_peptides_leave_their_result_only(spark, folder):
    got = features.learned_peptides(spark, "/root/testdata/sf0.001")
    assert got.count() == 14 and len(list(folder.glob("table-*"))) == 1
