"""Exact duplicates with a heavy-hitter split; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lower_ascii, written


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = 1e-3) -> DataFrame:
    """For each row of ``docs``: the row of its group of equal texts that stays.

    Texts are equal when identical after lower-casing A-Z; the largest id of a group stays. A Misra-Gries
    summary (``freqItems``) names at most ``1 / support`` digests and misses none that holds more than
    ``support`` of the rows. The named digests are counted exactly, and those results, at most
    ``1 / support`` rows, are broadcast: rows of a hot group never meet in one task. All other digests take an
    ordinary shuffle: they are counted after partial sums on the map side and joined back by a plain
    equi-join, which adaptive execution can split where a group below the share is still large.

    Returns doc_id, keep_id, group_size, kept, text_sha256. Null and empty texts form one group. A null id
    never outranks another; rows that repeat both id and text are all kept if their id is. Other columns,
    whatever their names, are ignored. An empty table gives an empty result.
    """
    digests = written(
        docs.select(F.col(id_col).alias("doc_id"), F.sha2(lower_ascii(F.col(text_col)).cast("binary"), 256).alias("text_sha256")), "digests"
    )
    named = digests.stat.freqItems(["text_sha256"], support).select(F.explode("text_sha256_freqItems").alias("text_sha256"))
    heavy = written(
        digests.join(F.broadcast(named), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter(F.col("group_size") > 1),
        "heavy",
    )
    split = digests.join(F.broadcast(heavy), "text_sha256", "left")
    hot = split.filter(F.col("group_size").isNotNull())
    rest = split.filter(F.col("group_size").isNull()).select("doc_id", "text_sha256")
    counted = rest.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    rest = rest.join(counted, "text_sha256")
    return hot.unionByName(rest).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
