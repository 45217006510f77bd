from __future__ import annotations

import pytest

from siltworks.workspace import scratch_dir, side_by_side


class _Session:
    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, name, default):
        return self.settings.get(name, default)


def test_scratch_is_below_the_shared_folder_and_new():
    session = _Session(**{"spark.checkpoint.dir": "hdfs:///shared/", "spark.master": "yarn"})
    first, second = scratch_dir(session, "a"), scratch_dir(session, "a")
    assert first.startswith("hdfs:///shared/siltworks/a-") and first != second


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(_Session(**{"spark.master": "yarn"}), "a")
    assert scratch_dir(_Session(**{"spark.master": "local[8]"}), "a")


def test_side_by_side_keeps_order_and_tries_everything(spark):
    done = []

    def job(n):
        done.append(spark.range(n).count())
        if n == 2:
            raise ValueError("two")
        return n

    assert side_by_side(spark, job, [3, 1, 5]) == [3, 1, 5]
    with pytest.raises(ValueError, match="two"):
        side_by_side(spark, job, [2, 7, 8, 9, 10, 11])
    assert {7, 8, 9, 10, 11} <= set(done)
