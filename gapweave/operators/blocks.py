"""Every block of one side beside every block of the other, for searches that compare all with all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def beside(left: DataFrame, left_block: str, left_blocks: int, right: DataFrame, right_block: str, right_blocks: int) -> DataFrame:
    """Each row of `left` with each row of `right`; both hold few rows, each a block of many packed ones, numbered from 0.

    A side is shuffled once, one block to a partition, and a task reads the two partitions of its pair. So nothing is
    copied on disk, sent to the driver or broadcast, whatever the number of blocks of the other side.
    """
    dealt = left.repartitionById(left_blocks, F.col(left_block).cast("int"))
    return dealt.crossJoin(right.repartitionById(right_blocks, F.col(right_block).cast("int")).hint("shuffle_replicate_nl"))
