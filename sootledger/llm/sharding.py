"""Sharding by balanced label propagation: linked documents gather in shards of equal counts."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sootledger.llm.shared import cut, documents, numbered, renamed, running_start

SHARES = 1024


def _admitted(demand: dict, room: list[int]) -> list[int]:
    """For each shard the last share of its movers that still finds room, -1 for none. Takes them out of the room."""
    last, closed = [-1] * len(room), [False] * len(room)
    for (shard, share), n in sorted(demand.items()):
        if not closed[shard] and n <= room[shard]:
            room[shard] -= n
            last[shard] = share
        else:
            closed[shard] = True
    return last


def propagate(linked: DataFrame, shards: int, capacity: list[int], rounds: int = 12) -> DataFrame:
    """Move documents (hub, members, tie) to the shards where most of their hub's documents are.

    A hub links its documents. In each round it names the shard with most of its documents, or as
    many shards as it needs if it is larger than one; documents elsewhere ask to move there, and a
    shard admits as many as it has room for, by hash of hub, or of document for large hubs. Large hubs
    go first, and small ones leave a shard that is above its count or for which large ones wait. What reaches the driver is counts
    per shard and share of the hash space.
    """
    size = max(1, min(capacity))
    state = linked.withColumn("large", F.col("members") * 8 > size)
    state = cut(state.withColumn("shard", F.pmod(F.xxhash64("tie", F.lit(5)), F.lit(shards)).cast("int")))
    # An eighth of slack, since documents choose among the named shards by hash.
    needs = F.when(F.col("members") <= size, 1).otherwise(F.ceil(F.col("members") * 9 / (8 * size))).cast("int")
    full = [False] * shards
    for turn in range(rounds):
        open_ = [s for s in range(shards) if not full[s]] or list(range(shards))
        is_full, others = F.array(*map(F.lit, full)), F.array(*map(F.lit, open_))
        votes = state.groupBy("hub", "members", "large", "shard").agg(F.count(F.lit(1)).alias("n"))
        vote = F.struct((F.col("large") | ~F.get(is_full, F.col("shard"))).alias("fits"), "n",
                        F.xxhash64("hub", "shard").alias("h"), "shard")
        named = (
            votes.groupBy("hub", "members").agg(F.sort_array(F.collect_list(vote), asc=False).alias("ranked"))
            .withColumn("named", F.slice("ranked", 1, needs).getField("shard"))
            .withColumn("named", F.when(F.get("ranked", F.lit(0)).getField("fits"), F.col("named")).otherwise(
                F.array(F.get(others, F.pmod(F.xxhash64("hub", F.lit(turn)), F.lit(len(open_))).cast("int")))))
            .select("hub", "named")
        )
        pick = F.get("named", F.pmod(F.xxhash64("tie"), F.size("named")).cast("int"))
        want = F.when(F.array_contains("named", F.col("shard")), F.col("shard")).otherwise(pick)
        share = F.pmod(F.xxhash64("hub", F.when(F.col("large"), F.col("tie"))), F.lit(SHARES)).cast("int")
        asked = cut(state.join(named, "hub").withColumns({"want": want, "share": share}).drop("named"))
        moves = asked.groupBy("large", "shard", "want", F.when(F.col("want") != F.col("shard"), F.col("share")).alias("share"))
        room, last, demands = list(capacity), {}, {}
        found = moves.count().collect()
        for large in (True, False):
            demand: dict = {}
            for r in (r for r in found if r["large"] == large):
                if r["share"] is None:
                    room[r["shard"]] -= r["count"]
                else:
                    demand[r["want"], r["share"]] = demand.get((r["want"], r["share"]), 0) + r["count"]
            demands[large] = demand
            last[large] = _admitted(demand, room)
        admitted = {large: F.get(F.array(*map(F.lit, last[large])), F.col("want")) for large in last}
        enters = F.col("share") <= F.when(F.col("large"), admitted[True]).otherwise(admitted[False])
        state = asked.withColumn("shard", F.when(enters, F.col("want")).otherwise(F.col("shard"))).drop("want", "share")
        load = [0] * shards
        for r in found:
            enters_now = r["share"] is not None and r["share"] <= last[r["large"]][r["want"]]
            load[r["want"] if enters_now else r["shard"]] += r["count"]
        # Small hubs also leave where large ones still wait for room.
        waits = {want for want, share in demands[True] if share > last[True][want]}
        full = [n > c or s in waits for s, (n, c) in enumerate(zip(load, capacity))]
        if not any(demands.values()) or (max(last[True] + last[False]) < 0 and not any(full)):
            break
    return state.drop("large")


def _place(number, limits: list[int]):
    """How many of the limits lie at or below a number."""
    return sum(((number >= F.lit(x)).cast("int") for x in limits), F.lit(0))


def shard_evenly(docs: DataFrame, shards: int = 24, rounds: int = 12) -> DataFrame:
    """Add shard and slot to rows (..., hub, tie): counts of shards differ by one at most.

    Rows that share a hub are linked and gather by label propagation, NULL hubs link nothing. What is
    above a shard's count after the last round, then the rows without links, fill the free slots of
    all shards in order. `tie` is a hash that orders rows. `shard` and `slot` come in place of columns of these
    names; all others stay as they were, whatever their names.
    """
    given = docs.drop("shard", "slot").columns
    others = docs.drop("hub", "tie", "shard", "slot").columns
    rows = cut(docs.select(*numbered(others), "hub", "tie"))
    columns = rows.columns
    sizes = rows.where(F.col("hub").isNotNull()).groupBy("hub").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    total = rows.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    known = cut(rows.join(sizes, "hub", "left"))
    settled = propagate(known.where("members > 1"), shards, capacity, rounds)
    first = running_start(settled.withColumn("_one", F.lit(1).cast("long")), ["shard", "hub", "tie"], "_one", "_at")
    first = cut(first)
    load = {r[0]: r[1] for r in first.groupBy("shard").count().collect()}
    begin = [0, *accumulate(load.get(s, 0) for s in range(shards))]
    slot = F.col("_at") - F.get(F.array(*map(F.lit, begin)), F.col("shard"))
    first = first.withColumn("slot", slot)
    fits = F.col("slot") < F.get(F.array(*map(F.lit, capacity)), F.col("shard"))
    rest = first.where(~fits).select(*columns, F.lit(0).alias("_free"), "_one").unionByName(
        known.where("members IS NULL").select(*columns, F.lit(1).alias("_free"), F.lit(1).cast("long").alias("_one"))
    )
    rest = running_start(rest, ["_free", "hub", "tie"], "_one", "_at")
    held = [min(load.get(s, 0), capacity[s]) for s in range(shards)]
    holes = [0, *accumulate(c - h for c, h in zip(capacity, held))]
    chosen = _place(F.col("_at"), holes[1:])
    rest = rest.withColumn("shard", chosen.cast("int"))
    shift = F.array(*(F.lit(h - b) for h, b in zip(held, holes)))
    rest = rest.withColumn("slot", F.col("_at") + F.get(shift, F.col("shard")))
    placed = first.where(fits).select(*columns, "shard", "slot").unionByName(rest.select(*columns, "shard", "slot"))
    own = dict(zip(others, renamed(others)))
    return placed.select(*(own.get(c, c) for c in given), "shard", "slot")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal counts; equal texts are linked. NULL texts have size 8, crc32 0 and no links."""
    text = F.col("text")
    docs = documents(spark, sf_dir).select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("hub"),
        F.xxhash64("doc_id", "text").alias("tie"),
    )
    return shard_evenly(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
