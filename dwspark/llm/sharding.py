"""Sharding by balanced label propagation.

Documents are tied together by shared link keys. Each link key is a hub, so a
group of n documents costs n rows, never n^2 pairs. A hub larger than a shard
gets as many shards as it fills before anything else is placed, its rows are
put into them in runs and stay there; all other rows start in the room that is
left. A round counts, for each hub, its members by shard, and lets each
document vote for the shard where its hubs have most members; all documents
that want to move do so. Shards then shed what exceeds their quota, unlinked
and small documents first, and what they shed fills the shards that have room,
the members of a hub next to each other. Rounds go on as long as they lower
the cut, the members that lie outside their hub's main shard. The last passes
shed to the exact mean, largest documents first to stay, so that only the
smallest decide how even the shards are.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_cells, running_sum, stored

GAIN = 0.02                       # a round that lowers the cut by a smaller share is the last
FINISH = 2


def _shares(placed: DataFrame, links: DataFrame) -> DataFrame:
    """link -> all its members, and the shard (target) that holds most of them."""
    hubs = (links.join(placed.select("row", "shard"), "row")
            .groupBy("link", "shard").agg(F.count("*").alias("members"))
            .groupBy("link").agg(F.max(F.struct("members", -F.col("shard"))).alias("best"), F.sum("members").alias("all"))
            .select("link", (-F.col("best.col2")).alias("target"), F.col("best.members").alias("members"), "all"))
    # stored: both sides of the join in _votes are then dealt anew, and a hub with many members can be split
    return stored(hubs, "hubs")


def _votes(hubs: DataFrame, links: DataFrame) -> DataFrame:
    """row -> the shard where most fellow members of its hubs are."""
    return (links.join(hubs, "link")
            .groupBy("row", "target").agg(F.sum("members").alias("weight"))
            .groupBy("row").agg(F.max(F.struct("weight", -F.col("target"))).alias("vote"))
            .select("row", (-F.col("vote.col2")).alias("target")))


def _pinned(rows: DataFrame, large: list, mean: float, n_shards: int, cells: int) -> DataFrame:
    """row -> shard, for the rows of the hubs in ``large`` (fewer than there are shards): each hub
    evenly over as many shards as it fills; where these are more than there are, all hubs in one sequence."""
    need = {r.hub: ceil(r.load / mean) for r in large}
    spread, at, runs = sum(need.values()) <= n_shards, 0, []
    for r in large:
        per = r.load / need[r.hub] if spread else mean
        runs.append((r.hub, float(at * per if spread else at), float(per), at + need[r.hub] - 1 if spread else n_shards - 1))
        at += need[r.hub] if spread else r.load
    runs = rows.sparkSession.createDataFrame(runs, "hub long, start double, per double, top int")
    own = stored(rows.filter("linked = 1").join(F.broadcast(runs), "hub")                # fewer rows than shards
                 .withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(cells))), "pinned")
    own = running_sum(own, ["hub"], ["salt"], ["row"], "size", "before")
    middle = F.col("start") + F.col("before") + F.col("size") / 2
    return own.select("row", F.least(F.floor(middle / F.col("per")), F.col("top")).cast("int").alias("pin"))


def _into(position: Column, room: list[tuple[int, float]]) -> Column:
    """The shard at ``position`` in a sequence of (shard, room)."""
    ends, at = [], 0.0
    for shard, gap in room:
        at += gap
        ends.append((shard, at))
    into = F.lit(ends[-1][0])
    for shard, end in reversed(ends[:-1]):
        into = F.when(position < end, F.lit(shard)).otherwise(into)
    return into.cast("int")


def _loads(placed: DataFrame) -> dict[int, int]:
    """Bytes by shard: one row per shard comes to the driver."""
    return {r.shard: r.load for r in placed.groupBy("shard").agg(F.sum("size").alias("load")).collect()}


def _level(placed: DataFrame, load: dict[int, int], n_shards: int, cells: int, room: float) -> DataFrame:
    """Shards shed what lies beyond ``room`` times the mean, pinned, then linked
    and large rows being the last to go; the shed rows fill shards below the
    mean, in one sequence."""
    mean = sum(load.values()) / n_shards
    quota = mean * room
    if max(load.values(), default=0) <= quota:
        return placed
    cell = F.pmod(F.xxhash64("row"), F.lit(cells))
    full = [s for s, x in load.items() if x > quota]
    # rows in the order in which they stay; cells go by size class, then by hash, so none grows with a hot group
    big = (placed.filter(F.col("shard").isin(full))
           .withColumn("first", F.when(F.col("pinned") == 1, 0).otherwise(2 - F.col("linked")))
           .withColumn("rank", (-F.floor(F.log2("size") * 8)).cast("long")).withColumn("salt", cell))
    ranked = running_sum(big, ["shard"], ["first", "rank", "salt"], ["row"], "size", "before")
    # a pinned row that crosses the quota stays: elsewhere it would lie in one more shard than its hub fills
    shed = stored(ranked.filter(F.when(F.col("pinned") == 1, F.col("before") >= quota)
                                .otherwise(F.col("before") + F.col("size") > quota))
                  .select("row", "size", "hub", "linked", "shard"), "shed")
    lost = {r.shard: r.load for r in shed.groupBy("shard").agg(F.sum("size").alias("load")).collect()}
    room = [(s, mean - (load.get(s, 0) - lost.get(s, 0))) for s in range(n_shards)]
    room = [(s, gap) for s, gap in room if gap > 0]
    # one sequence over all shed rows: linked first, members of a hub side by side. Lanes are put in
    # sequence first, cells inside their lane next, rows inside their cell last
    seq = (shed.withColumn("first", 1 - F.col("linked"))
           .withColumn("lane", F.when(F.col("linked") == 1, F.pmod(F.xxhash64("hub"), F.lit(cells))).otherwise(F.lit(0)))
           .withColumn("salt", cell))
    lanes = (seq.groupBy("first", "lane").agg(F.sum("size").alias("sum"))
             .select("first", "lane", F.coalesce(F.sum("sum").over(
                 Window.orderBy("first", "lane").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead")))
    seq = (running_sum(seq, ["first", "lane"], ["salt"], ["hub", "row"], "size", "start")
           .join(F.broadcast(lanes), ["first", "lane"]))                                 # cells + 1 rows at most
    scale = sum(gap for _, gap in room) / max(1, sum(lost.values()))
    moved = seq.select("row", _into((F.col("ahead") + F.col("start") + F.col("size") / 2) * scale, room).alias("into"))
    return (placed.join(moved, "row", "left")
            .withColumn("shard", F.coalesce("into", "shard")).drop("into"))


def shard_balanced(docs: DataFrame, links: DataFrame, n_shards: int = 24, slack: float = 0.0,
                   gain: float = GAIN) -> DataFrame:
    """Columns of ``docs`` (row long: unique, not null; size long: above 0; all
    others are carried along as they are, but for columns named shard and slot,
    which the result replaces) plus shard int and slot long (gapless from 0 in
    a shard).

    ``links`` has (row, link): rows that share a link value should share a
    shard. A link of one row has no effect, nor has a null link; repeated
    (row, link) pairs weigh more. Ties between shards go to the lower one,
    between rows to the lower row. Sizes of the shards come out near equal, but
    a row larger than the mean fills a shard by itself; ``slack`` lets shards
    exceed the mean by that share while labels move. Rounds end when one lowers
    the cut by less than the share ``gain``. Texts are not read. Empty input
    gives an empty result.
    """
    rows, total = docs.agg(F.count("*"), F.sum("size")).first()
    mean, cells = (total or 0) / n_shards, n_cells(rows, n_shards)
    links = stored(links.select("row", "link").filter("link IS NOT NULL").join(docs.select("row", "size"), "row"), "all-links")
    links = stored(links.join(links.groupBy("link").agg(F.count("*").alias("n"), F.sum("size").alias("load")).filter("n > 1"), "link")
                   .select("row", "link", F.xxhash64("link").alias("hub"), "load"), "links")
    # a row's hub is the largest of its links, so a large link keeps its rows
    hub = links.groupBy("row").agg(F.max(F.struct("load", "hub")).alias("most")).select("row", F.col("most.hub").alias("hub"))
    placed = stored(docs.select("row", "size").join(hub, "row", "left")
                    .withColumn("linked", F.col("hub").isNotNull().cast("int"))
                    .withColumn("hub", F.coalesce("hub", F.xxhash64("row"))), "placed")
    large = (placed.filter("linked = 1").groupBy("hub").agg(F.sum("size").alias("load"))
             .filter(F.col("load") > mean).orderBy(F.desc("load"), "hub").collect())      # fewer than n_shards
    if large:
        placed = stored(placed.join(_pinned(placed, large, mean, n_shards, cells), "row", "left"), "pins")
        links = links.filter(~F.col("hub").isin([r.hub for r in large]))
    else:
        placed = placed.withColumn("pin", F.lit(None).cast("int"))
    taken = {r.pin: r.load for r in placed.filter("pin IS NOT NULL").groupBy("pin").agg(F.sum("size").alias("load")).collect()}
    room = [(s, max(0.0, mean - taken.get(s, 0))) for s in range(n_shards)]
    spot = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(2**30)) * (sum(gap for _, gap in room) / 2**30)
    placed = stored(placed.withColumn("pinned", F.col("pin").isNotNull().cast("int"))
                    .withColumn("shard", F.coalesce("pin", _into(spot, room))).drop("pin"), "placed")

    cut, last = None, None
    while True:
        hubs = _shares(placed, links)
        now = hubs.agg(F.sum(F.col("all") - F.col("members"))).first()[0] or 0
        if cut is not None and now >= cut:
            placed = last
            break
        if not now or (cut is not None and now > cut * (1 - gain)):
            break
        cut, last = now, placed
        moves = stored(placed.join(_votes(hubs, links), "row", "left")
                       .withColumn("shard", F.when((F.col("pinned") == 0) & F.col("target").isNotNull(), F.col("target"))
                                   .otherwise(F.col("shard")).cast("int")).drop("target"), "moves")
        placed = stored(_level(moves, _loads(moves), n_shards, cells, 1 + slack), "placed")
    for _ in range(FINISH):
        placed = stored(_level(placed, _loads(placed), n_shards, cells, 1.0), "placed")
    slots = placed.select("row", "shard", F.pmod(F.xxhash64("row"), F.lit(cells)).alias("cell"), F.lit(1).alias("one"))
    slots = running_sum(slots, ["shard"], ["cell"], ["row"], "one", "slot").select("row", "shard", "slot")
    return docs.drop("shard", "slot").join(slots, "row")


def cut_links(sharded: DataFrame, links: DataFrame) -> DataFrame:
    """By link: members, shards they lie in, and the shards needed at least if one shard could hold the largest part."""
    return (links.join(sharded.select("row", "shard"), "row")
            .groupBy("link", "shard").agg(F.count("*").alias("n"))
            .groupBy("link").agg(F.sum("n").alias("members"), F.count("*").alias("shards")))
