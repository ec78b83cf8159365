"""Where staged files go."""

import pytest

from changeflow.session import drop_staged, materialise, own_conf, shared_dir


class Conf:
    def __init__(self, **values):
        self.values = {f"spark.{k.replace('_', '.')}": v for k, v in values.items()}

    @property
    def conf(self):
        return self

    def get(self, key, *default):
        return self.values.get(key, *default) if default else self.values[key]


@pytest.mark.parametrize(
    "master, warehouse, refused",
    [
        ("local", "file:/w", False), ("local[8]", "/w", False), ("local[4,2]", "/w", False), ("local-cluster[3,2,1000]", "/w", True),
        ("yarn", "file:/w", True), ("yarn", "hdfs://n/w", False), ("spark://h:7077", "/w", True),
    ],
)
def test_no_local_folder_on_a_cluster(master, warehouse, refused):
    spark = Conf(master=master, sql_warehouse_dir=warehouse)
    if refused:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(spark, "x")
    else:
        assert shared_dir(spark, "x").startswith(f"{warehouse}/_staged/x-")


def test_checkpoint_dir_comes_first():
    spark = Conf(master="yarn", sql_warehouse_dir="/w", checkpoint_dir="hdfs://n/c/")
    assert shared_dir(spark, "x").startswith("hdfs://n/c/x-") and shared_dir(spark, "x") != shared_dir(spark, "x")


def test_own_conf_is_taken_back(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    with pytest.raises(ValueError), own_conf(spark, {"spark.sql.shuffle.partitions": "3", "spark.changeflow.x": "1"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3" and spark.conf.get("spark.changeflow.x") == "1"
        raise ValueError
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8" and spark.conf.get("spark.changeflow.x", None) is None


def test_staged_frames_are_dropped_alone(spark):
    one, two = (materialise(spark.range(5), "one"), materialise(spark.range(7).where("id > 9"), "two"))
    drop_staged(one.where("id > 2"))
    drop_staged(two)
    three = materialise(spark.range(3), "three")
    assert three.count() == 3
    with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_EXIST"):
        one.count()
