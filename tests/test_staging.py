"""Write, check, then publish: nothing that failed a check is ever read."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import testbed
from conftest import SMALL
from millrace.operators.quality import QualityError
from millrace.plans import pipeline
from millrace.sources import staging
from millrace.sources.layers import Layout, read_layer, write_layer
from millrace.sources.staging import Folders, change_over, forget, publish_checked, recover, staged

KEYS = {"a": "id"}


def rows(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "id long")


def ids(spark, layout, table="a"):
    return sorted(r.id for r in read_layer(spark, layout, "gold", table).collect())


def test_a_failed_check_leaves_the_old_rows(spark, layout):
    assert publish_checked(spark, {"a": rows(spark, 1, 2)}, layout, "gold", KEYS) == {"a": 2}
    with pytest.raises(QualityError, match="not unique"):
        publish_checked(spark, {"a": rows(spark, 3, 3), "b": rows(spark, 1)}, layout, "gold", KEYS)
    assert ids(spark, layout) == [1, 2]
    # Tables of a run come together or not at all; what was refused can be looked at.
    folders = Folders(spark, layout.root)
    assert not folders.exists(layout.path("gold", "b"))
    assert len(folders.names(f"{layout.root}/_staging")) >= 1
    with pytest.raises(QualityError, match="1 rows after 2"):
        publish_checked(spark, {"a": rows(spark, 4)}, layout, "gold", KEYS, least_share=0.9)
    assert ids(spark, layout) == [1, 2]
    publish_checked(spark, {"a": rows(spark, 5, 6, 7)}, layout, "gold", KEYS, least_share=0.9)
    assert ids(spark, layout) == [5, 6, 7]


def test_an_error_in_the_block_publishes_nothing(spark, layout):
    with pytest.raises(ZeroDivisionError):
        with staged(spark, layout) as stage:
            write_layer(rows(spark, 1), stage, "gold", "a")
            raise ZeroDivisionError
    assert not Folders(spark, layout.root).exists(layout.path("gold", "a"))


class Breaking(Folders):
    """Fails, or dies, at one move: the one after ``left`` others."""

    left, error = 0, OSError

    def move(self, source, target):
        Breaking.left -= 1
        if Breaking.left == -1:
            raise Breaking.error("lost")
        super().move(source, target)


@pytest.mark.parametrize("moves", range(6))
def test_a_failed_move_takes_all_tables_back(spark, layout, monkeypatch, moves):
    publish_checked(spark, {"a": rows(spark, 1), "b": rows(spark, 2)}, layout, "gold", {})
    frames = {"a": rows(spark, 11), "b": rows(spark, 12), "c": rows(spark, 13)}
    # Five moves bring the tables, one finishes. A driver that dies (not an Exception) takes nothing back itself.
    for error in (OSError, KeyboardInterrupt):
        with monkeypatch.context() as patch:
            patch.setattr(staging, "Folders", Breaking)
            Breaking.left, Breaking.error = moves, error
            with pytest.raises(error):
                with staged(spark, layout) as stage:
                    for t, df in frames.items():
                        write_layer(df, stage, "gold", t)
                    patch.setattr(Breaking, "left", moves)
        runs = recover(spark, layout)
        assert len(runs) == (1 if moves == 5 or error is KeyboardInterrupt and moves else 0)
        assert (ids(spark, layout), ids(spark, layout, "b")) == ([1], [2])
        assert not Folders(spark, layout.root).exists(layout.path("gold", "c"))
        assert recover(spark, layout) == []
    publish_checked(spark, frames, layout, "gold", {})
    assert (ids(spark, layout), ids(spark, layout, "b"), ids(spark, layout, "c")) == ([11], [12], [13])


def test_replaced_versions_go_when_told(spark, layout):
    for n in (1, 2, 3):
        publish_checked(spark, {"a": rows(spark, n)}, layout, "gold", KEYS)
    assert len(forget(spark, layout)) == 3 and forget(spark, layout) == []
    assert ids(spark, layout) == [3]


def test_nothing_staged_is_no_change(spark, layout):
    with staged(spark, layout):
        pass
    change_over(spark, layout, "unknown")
    assert recover(spark, layout) == [] and forget(spark, layout) == []


def test_a_broken_gold_run_keeps_the_last_model(spark, tmp_path):
    layout = Layout(str(tmp_path))
    pipeline.run_batch(spark, layout, testbed.GivenTables(SMALL), tie_breaks=testbed.TIE_BREAKS)
    before = {t: read_layer(spark, layout, "gold", t).count() for t in ("dim_workshops", "fact_alerts")}
    workshops = read_layer(spark, layout, "silver", "workshops")
    publish_checked(spark, {"workshops": workshops.union(workshops)}, layout, "silver", {})
    with pytest.raises(QualityError, match="dim_workshops.workshop_id"):
        pipeline.run_gold(spark, layout)
    assert {t: read_layer(spark, layout, "gold", t).count() for t in before} == before


def test_too_many_orphans_stop_silver(spark, tmp_path):
    layout = Layout(str(tmp_path))
    pipeline.run_bronze(spark, layout, testbed.GivenTables(SMALL))
    pipeline.run_silver(spark, layout, testbed.TIE_BREAKS, orphan_limit=1.0)
    report = entry.queries()["dq_orphans"](spark, SMALL).collect()
    assert any(r.n for r in report)
    seen = read_layer(spark, layout, "silver", "alerts").count()
    with pytest.raises(QualityError, match="without a parent"):
        pipeline.run_silver(spark, layout, testbed.TIE_BREAKS, orphan_limit=0.0)
    assert read_layer(spark, layout, "silver", "alerts").count() == seen


def test_a_shrunken_store_does_not_replace_bronze(spark, tmp_path):
    layout, whole = Layout(str(tmp_path)), testbed.GivenTables(SMALL)
    counts = pipeline.run_bronze(spark, layout, whole, least_share=0.5)

    class Shrunk:
        system = whole.system

        def read(self, spark, table):
            return whole.read(spark, table).limit(1 if table == "alerts" else 10**9)

    with pytest.raises(QualityError, match="alerts: 1 rows"):
        pipeline.run_bronze(spark, layout, Shrunk(), least_share=0.5)
    assert read_layer(spark, layout, "bronze", "alerts").count() == counts["alerts"]
