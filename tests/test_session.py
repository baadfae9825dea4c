"""Shuffle sizing for the target scale (no session needed)."""

from loanscope.session import MB, sizing_conf


def test_sizing_for_100tb_on_1000_executors():
    conf = sizing_conf(100 * (1 << 40), total_cores=8000)
    n = int(conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"])
    assert n == 100_000                                  # 25 TB / 256 MB = 102,400, capped
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 * MB)


def test_sizing_for_1tb():
    conf = sizing_conf(1 << 40, total_cores=400)
    assert conf["spark.sql.shuffle.partitions"] == str((1 << 40) // 4 // (256 * MB))   # 1,024


def test_sizing_floor_for_small_inputs():
    assert sizing_conf(50 * MB, total_cores=8)["spark.sql.shuffle.partitions"] == "200"
