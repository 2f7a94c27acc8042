from types import SimpleNamespace

import pytest

from tablewright.session import fresh_path, partitions_for, shared_folder


class Conf(dict):
    def set(self, key, value):
        self[key] = value


def session(master, **conf):
    return SimpleNamespace(conf=Conf(conf), sparkContext=SimpleNamespace(master=master))


def test_the_folder_named_by_the_session_is_used():
    spark = session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared_folder(spark) == "hdfs:///shared"
    assert fresh_path(spark, "x").startswith("hdfs:///shared/x-") and fresh_path(spark, "x") != fresh_path(spark, "x")


def test_only_a_local_master_gets_a_temporary_folder():
    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local) != shared_folder(session("local[2]"))
    with pytest.raises(ValueError):
        shared_folder(session("spark://host:7077"))


def test_shuffle_partitions_follow_the_input():
    assert partitions_for(0) == 200 and partitions_for(100 << 40) == 819_200
