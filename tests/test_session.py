"""Session settings and the shared folder."""

import pytest

from landfall.session import SHUFFLE_PARTITION_BYTES, shuffle_partitions, workspace


class Conf:
    def __init__(self, **values):
        self.values = values

    def get(self, name, default=None):
        return self.values.get(name, default)


class Session:
    def __init__(self, **values):
        self.conf = Conf(**values)


def test_workspace_is_new_each_time_and_in_the_named_folder(spark):
    first, second = workspace(spark), workspace(spark)
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace(Session(**{"spark.master": "yarn"}))


def test_local_master_may_use_a_temporary_folder():
    assert "landfall-" in workspace(Session(**{"spark.master": "local[2]"}))


@pytest.mark.parametrize("size, partitions", [(0, 200), (SHUFFLE_PARTITION_BYTES * 200 + 1, 201), (10**14, 745_059)])
def test_partitions_grow_with_the_shuffle(size, partitions):
    assert shuffle_partitions(size) == partitions
