"""Exact distinct counts that roll up: of days into months and years, without the lines.

Ids are numbered densely, and the ids of a day are a bitmap over their numbers, cut into buckets of
32,768. Bitmaps of days are put together bit by bit, so a month's count needs the days' bitmaps and
nothing else, and so does that of any other set of days. Numbers are given in the order in which
ids first occur, so a day's orders lie in few buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.ranking import with_position
from orderloom.session import staged


def numbered(firsts: DataFrame, id_name: str, known: DataFrame | None = None) -> DataFrame:
    """(id, number) of every id of `firsts` (id, first), from 1 in the order of `first`, then id.

    With `known`, an earlier result, ids that are in it keep their numbers and new ones get the
    next, so bitmaps made before stay good. Null ids have no number.
    """
    ids = firsts.where(F.col(id_name).isNotNull())
    last = 0
    if known is not None:
        ids = ids.join(known.select(id_name), id_name, "left_anti")
        last = known.agg(F.max("number")).first()[0] or 0
    placed = with_position(ids, F.asc("first"), F.asc(id_name))
    new = placed.select(id_name, (F.col("position") + 1 + last).alias("number"))
    return staged(new if known is None else known.select(id_name, "number").unionByName(new), f"{id_name}-numbers")


def first_days(fact: DataFrame, id_name: str) -> DataFrame:
    return fact.groupBy(id_name).agg(F.min(F.to_date("order_date")).alias("first"))


def id_bitmaps(fact: DataFrame, numbers: DataFrame, id_name: str, *key: str) -> DataFrame:
    """(key, bucket, ids): which ids of each bucket occur in each group."""
    pairs = fact.where(F.col(id_name).isNotNull()).select(*key, id_name).distinct()
    placed = pairs.join(numbers, id_name)
    number = F.col("number")
    return placed.groupBy(*key, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("ids")
    )


def rolled_up(bitmaps: DataFrame, *key: str) -> DataFrame:
    """Bitmaps of a coarser key, of which the finer one is made."""
    return bitmaps.groupBy(*key, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))


def counted(bitmaps: DataFrame, name: str, *key: str) -> DataFrame:
    return bitmaps.groupBy(*key).agg(F.sum(F.bitmap_count("ids")).alias(name))
