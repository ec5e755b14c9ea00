"""Links inside lists of very uneven length, in tiles of bounded weight.

A list is a group of nodes of which any two may be linked, such as all that share a token. Short
lists share a tile; a long one is cut into tiles by node. What comes out are not all links, of
which a list may hold the square of its length, but some that connect the same nodes:

1. every tile by itself gives a spanning forest;
2. one node of each tree of a long list is dealt again, until these fit a tile or get no fewer;
3. what then is in several components of a list is compared across tiles: nodes outside the
   list's largest component against all of the list, in pairs of tiles.

So a list whose nodes hang together, of whatever length, costs in proportion to it; only nodes
that share a list and are not connected are compared one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import ship
from orderloom.llm.components import components
from orderloom.session import sized, staged

# One against some of a tile's rows: which of `others` (places) the row at a place is linked with.
Compare = Callable[[int, np.ndarray], np.ndarray]
# Makes the comparison of a tile from the table of its rows.
Prepare = Callable[[pa.Table], Compare]

FOUND = "list long, a long, b long"


def linked(lists: DataFrame, payload: DataFrame, prepare: Prepare, limit: int) -> DataFrame:
    """Links (a, b) that connect all nodes linked inside some list.

    `lists` has (list, node), each pair once; `payload` has (node, weight, ...), a row for each
    node, with what the comparison reads. A tile holds rows of about `limit` weight, or one
    heavier row. Both should be written tables.
    """
    tree = _Tiles(payload, prepare, limit)
    rows = lists.count()
    sizes = staged(_sizes(lists, payload, limit, rows), "list-sizes")
    found = tree.forest(lists, sizes)
    links = found.where("a <> b").select("a", "b")
    long_lists = sizes.where("tiles > 1")
    heads, before = found.where("list IS NOT NULL AND a = b"), long_lists.agg(F.sum("tiles")).first()[0]
    if before is None:
        return links
    reps = heads.select("list", F.col("a").alias("node"))
    while True:
        fewer = staged(_sizes(reps, payload, limit, rows), "list-sizes")
        tiles = fewer.agg(F.sum("tiles")).first()[0] or 0
        if not tiles or tiles >= before:
            break
        before, found = tiles, tree.forest(reps, fewer)
        links = links.unionByName(found.where("a <> b").select("a", "b"))
        reps = found.where("list IS NOT NULL AND a = b").select("list", F.col("a").alias("node"))
    links = staged(sized(links.distinct(), rows), "links")
    return links.unionByName(tree.across(lists.join(long_lists.select("list", "tiles"), "list"), links, rows))


def _sizes(lists: DataFrame, payload: DataFrame, limit: int, rows: int) -> DataFrame:
    """(list, nodes, weight, tiles) of the lists of two nodes or more, of at most `rows` rows."""
    weights = sized(lists.join(payload.select("node", "weight"), "node"), rows)
    sizes = weights.groupBy("list").agg(F.count(F.lit(1)).alias("nodes"), F.sum("weight").alias("weight"))
    sizes = sized(sizes, rows)
    tiles = F.ceil(F.col("weight") / F.lit(limit)).cast("long")
    return sizes.where("nodes > 1").withColumn("tiles", F.least(tiles, "nodes"))


class _Tiles:
    def __init__(self, payload: DataFrame, prepare: Prepare, limit: int):
        self.payload, self.prepare, self.limit = payload, prepare, limit

    def forest(self, lists: DataFrame, sizes: DataFrame) -> DataFrame:
        """Links of a spanning forest per tile, and for each tree of a list that has several
        tiles a row (list, node, node)."""
        total = sizes.where("tiles = 1").agg(F.sum("weight")).first()[0] or 0
        shared = max(1, -(-total // self.limit))
        tile = F.when(F.col("tiles") > 1, F.xxhash64("list", F.pmod(F.xxhash64("node"), F.col("tiles")))).otherwise(
            F.pmod(F.xxhash64("list"), F.lit(shared))
        )
        rows = lists.join(sizes.select("list", "tiles"), "list").join(self.payload, "node")
        dealt = rows.select(tile.alias("tile"), "list", (F.col("tiles") > 1).alias("several"), *self.payload.columns)
        return self._run(dealt, _forests)

    def across(self, lists: DataFrame, links: DataFrame, rows: int) -> DataFrame:
        """Links between components of one list, of `lists` (list, node, tiles) with at most
        `rows` rows."""
        roots = components(links)
        named = lists.join(roots, "node", "left").select("list", "node", "tiles", F.coalesce("root", "node").alias("root"))
        named = staged(sized(named, rows), "list-components")
        parts = sized(named.groupBy("list", "root").agg(F.count(F.lit(1)).alias("n")), rows)
        main = parts.groupBy("list").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("parts"))
        main = staged(sized(main.where("parts > 1"), rows), "main-components")
        if main.isEmpty():
            return links.limit(0)
        open_lists = named.join(main, "list").withColumn("rest", F.col("root") != F.col("main"))
        weights = open_lists.where("rest").join(self.payload.select("node", "weight"), "node")
        rests = weights.groupBy("list").agg(F.ceil(F.sum("weight") / F.lit(self.limit)).cast("long").alias("rows"))
        both = open_lists.join(staged(sized(rests, rows), "rests"), "list")
        mine = F.pmod(F.xxhash64("node"), F.col("tiles"))
        here = F.pmod(F.xxhash64("node"), F.col("rows"))
        # A node of the rest is in all tiles of its row, any node in all of its column.
        cells = both.select(
            "list", "node", "root", "rest", "rows", mine.alias("column"), here.alias("row"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.greatest("rows", "tiles") - 1)).alias("k"), "tiles",
        )
        column = cells.where("k < rows").select("list", "node", "root", F.lit(False).alias("first"), F.col("k").alias("i"), F.col("column").alias("j"))
        row = cells.where("rest AND k < tiles").select("list", "node", "root", F.lit(True).alias("first"), F.col("row").alias("i"), F.col("k").alias("j"))
        dealt = column.unionByName(row).join(self.payload, "node")
        tile = F.xxhash64("list", "i", "j")
        found = self._run(dealt.select(tile.alias("tile"), "list", "root", "first", *self.payload.columns), _bridges)
        return found.select("a", "b")

    def _run(self, dealt: DataFrame, work: Callable[[pa.Table, Prepare], Iterator[tuple[int | None, int, int]]]) -> DataFrame:
        ship(dealt.sparkSession)
        prepare = self.prepare

        def run(table: pa.Table) -> pa.Table:
            rows = list(work(table.combine_chunks(), prepare))
            columns = list(zip(*rows)) if rows else [(), (), ()]
            return pa.table({name: pa.array(values, pa.int64()) for name, values in zip(("list", "a", "b"), columns)})

        return staged(dealt.groupBy("tile").applyInArrow(run, FOUND), "found")


def _forests(table: pa.Table, prepare: Prepare) -> Iterator[tuple[int | None, int, int]]:
    lists, nodes = (table[name].to_numpy() for name in ("list", "node"))
    several = table["several"].to_numpy(zero_copy_only=False)
    compare = prepare(table)
    order = np.argsort(lists, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(lists[order])) + 1):
        label = np.arange(len(places))
        for one, other in _join(places, label, compare):
            yield None, nodes[one], nodes[other]
        if several[places[0]]:
            for tree in np.unique(label, return_index=True)[1]:
                yield lists[places[0]], nodes[places[tree]], nodes[places[tree]]


def _join(places: np.ndarray, label: np.ndarray, compare: Compare) -> Iterator[tuple[int, int]]:
    """Links among some places until no two trees can be joined; `label` becomes their tree."""
    for k in range(len(places) - 1):
        apart = k + 1 + np.flatnonzero(label[k + 1 :] != label[k])
        if not len(apart):
            if (label == label[k]).all():
                return
            continue
        hits = apart[compare(places[k], places[apart])]
        for tree, first in zip(*np.unique(label[hits], return_index=True)):
            yield places[k], places[hits[first]]
            label[label == tree] = label[k]


def _bridges(table: pa.Table, prepare: Prepare) -> Iterator[tuple[int | None, int, int]]:
    nodes, roots = (table[name].to_numpy() for name in ("node", "root"))
    first = table["first"].to_numpy(zero_copy_only=False)
    compare = prepare(table)
    label = np.unique(roots, return_inverse=True)[1]
    others = np.flatnonzero(~first)
    for place in np.flatnonzero(first):
        apart = others[label[others] != label[place]]
        hits = apart[compare(place, apart)] if len(apart) else apart
        for tree, at in zip(*np.unique(label[hits], return_index=True)):
            yield None, nodes[place], nodes[hits[at]]
            label[label == tree] = label[place]
