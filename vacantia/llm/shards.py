"""Shards by balanced label propagation, with DataFrame functions only.

Documents with equal texts are linked to each other. A group of linked documents is one row
with the number of its documents on each shard, so its links are never written out, however
large it is. Each round every group moves documents to the shard that has most of its
neighbours and room left, under a quota of room per shard and hash bucket; the new loads (one
number per shard) set the next round's quotas. At last documents without links, and what is
over a shard's size, fill up the shards to exact sizes: row counts differ by one at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.llm.common import discard, stored

#: Hash buckets that share a quota or a shard's numbering, and the room each has of a quota at least.
BUCKETS = 64
BUCKET_ROOM = 2_000
SALTS = 256


def _array(values: list[int]) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def _running(values: list[int]) -> list[int]:
    out, total = [], 0
    for v in values:
        total += v
        out.append(total)
    return out


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, n: a + n)


def _numbered(df: DataFrame, group: list[str], salt: Column, order: list[str], out: str) -> DataFrame:
    """Gapless numbers from 0 within *group*, salted: a hot group is numbered in many tasks."""
    salted = df.withColumn("_salt", salt)
    counts = salted.groupBy(*group, "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy(*group, "_salt").orderBy(*order)
    return (
        salted.join(offsets, [*group, "_salt"])
        .withColumn(out, F.row_number().over(own) - 1 + F.col("_before"))
        .drop("_salt", "_before")
    )


def propagated(groups: DataFrame, shards: int, room: int, rounds: int) -> DataFrame:
    """*groups* (h1, h2, counts: one number per shard) after label propagation.

    *room* is how many linked documents a shard takes. Every round is a stored table.
    """
    state = stored(groups)
    for _ in range(rounds):
        load = [0] * shards
        wants_in, wants_out = [0] * shards, [0] * shards
        each = state.select(F.posexplode("counts").alias("shard", "n")).groupBy("shard").agg(F.sum("n").alias("n"))
        for r in each.collect():  # one row per shard
            load[r.shard] = r.n
        open_ = _array([1 if load[s] < room else 0 for s in range(shards)])
        # The shard with most neighbours among those with room, or wherever all of them are.
        ranked = F.transform(
            "counts",
            lambda n, i: F.struct(
                F.when((F.get(open_, i) == 1) | (n == F.col("total")), n).otherwise(F.lit(-1).cast("long")).alias("n"),
                (-i).alias("i"),
            ),
        )
        best = F.array_max(ranked)
        asked = (
            state.withColumn("total", _total(F.col("counts")))
            .withColumn("best", best)
            .filter(F.col("best.n") >= 0)
            .select("h1", "h2", "counts", (-F.col("best.i")).alias("to"), (F.col("total") - F.col("best.n")).alias("move"))
            .filter("move > 0")
        )
        flows = asked.select(
            "to", F.posexplode("counts").alias("shard", "n")
        ).groupBy("shard").agg(
            F.sum(F.when(F.col("shard") == F.col("to"), 0).otherwise(F.col("n"))).alias("out"),
        )
        for r in flows.collect():
            wants_out[r.shard] = r.out
        for r in asked.groupBy("to").agg(F.sum("move").alias("n")).collect():
            wants_in[r.to] = r.n
        if not any(wants_in):
            break
        # Room, and what asks to leave: shards that are full can still exchange. Where less leaves
        # than has asked, the shard is over its room and takes nothing in the next rounds.
        quota = [max(0, room - load[s] + min(wants_in[s], wants_out[s])) for s in range(shards)]
        if not any(q and w for q, w in zip(quota, wants_in, strict=True)):
            break
        buckets = min(BUCKETS, 1 + room // BUCKET_ROOM)
        bucket = F.pmod(F.xxhash64("h1", "h2"), F.lit(buckets))
        # A group that fits in a bucket's room moves whole or not at all; larger ones come last
        # and take what is left, in part.
        large = _total(F.col("counts")) > max(1, room // buckets // 2)
        order = Window.partitionBy("to", "bucket").orderBy("large", F.desc("move"), "h1", "h2")
        share = F.floor(F.get(_array(quota), F.col("to")) / buckets)
        rest = share - F.coalesce(F.sum("move").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        granted = (
            asked.withColumn("bucket", bucket)
            .withColumn("large", large)
            .withColumn("rest", F.greatest(F.lit(0).cast("long"), rest))
            .withColumn("grant", F.when(F.col("large"), F.least("move", "rest")).when(F.col("move") <= F.col("rest"), F.col("move")).otherwise(0))
            .filter("grant > 0")
            .select("h1", "h2", "to", "grant")
        )
        def before(i: Column) -> Column:  # documents on other shards up to i
            return _total(F.transform(F.slice("counts", F.lit(1), i), lambda n, k: F.when(k == F.col("to"), 0).otherwise(n)))

        taken = F.transform(
            "counts",
            lambda n, i: F.when(i == F.col("to"), n + F.col("grant")).otherwise(
                n - F.greatest(F.lit(0).cast("long"), F.least(n, F.col("grant") - before(i)))
            ),
        )
        moved = state.join(granted, ["h1", "h2"], "left").select(
            "h1", "h2", F.when(F.col("grant").isNull(), F.col("counts")).otherwise(taken).alias("counts")
        )
        after = stored(moved)
        discard(state)
        state = after
    return state


def sharded(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text", rounds: int = 10) -> DataFrame:
    """(key, size, text_crc32, shard, slot) per row of *docs*.

    The law is ``rows``: shards hold equally many rows, or one more on the first of them.
    *slot* numbers the rows of a shard from 0 without gaps. *size* is the UTF-8 bytes of the
    text plus 16. Equal texts are linked; a null text is linked to nothing and has 0 bytes.
    A group stays on one shard while that shard has room; a larger one takes several.
    Repeated rows and null keys are rows like any other. Other columns are not read.
    """
    body = F.col(text)
    rows = stored(
        docs.select(
            F.col(key).alias("key"),
            (F.coalesce(F.octet_length(body), F.lit(0)) + 16).cast("long").alias("size"),
            F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
            F.when(body.isNotNull(), F.xxhash64(body)).alias("h1"),
            F.when(body.isNotNull(), F.xxhash64(F.lit(1), body)).alias("h2"),
        )
    )
    number = rows.count()
    quota = [number // shards + (s < number % shards) for s in range(shards)]
    start = F.pmod(F.xxhash64("key", F.lit("start")), F.lit(shards)).cast("int")
    spread = rows.filter("h1 is not null").groupBy("h1", "h2", start.alias("shard")).agg(F.count("*").alias("n"))
    groups = (
        spread.groupBy("h1", "h2")
        .agg(F.sum("n").alias("total"), F.collect_list(F.struct("shard", "n")).alias("held"))  # a row per shard at most
        .filter("total > 1")
        .withColumn("held", F.map_from_entries("held"))
        .select("h1", "h2", F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.coalesce(F.try_element_at("held", s), F.lit(0).cast("long"))).alias("counts"))
    )
    state = propagated(groups, shards, number // shards, rounds)
    # Documents of a group take its shards in the order of their numbers.
    ends = state.select(
        "h1", "h2", F.transform("counts", lambda n, i: _total(F.slice("counts", F.lit(1), i + 1))).alias("ends")
    )
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")
    salted = rows.withColumn("salt", salt)
    parts = salted.filter("h1 is not null").groupBy("h1", "h2", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("h1", "h2").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    places = parts.join(ends, ["h1", "h2"]).select(
        "h1", "h2", "salt", "ends", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("h1", "h2", "salt").orderBy("key")
    assigned = (
        salted.join(places, ["h1", "h2", "salt"], "left")
        .withColumn("at", F.when(F.col("ends").isNotNull(), F.row_number().over(within) - 1 + F.col("before")))
        .select(
            *rows.columns,
            F.when(F.col("at").isNotNull(), F.size(F.filter("ends", lambda e: e <= F.col("at")))).alias("shard"),
        )
    )
    assigned = stored(assigned)
    bucket = F.pmod(F.xxhash64("key", "h1", F.lit("slot")), F.lit(BUCKETS)).cast("int")
    order = ["key", "h1", "h2"]
    placed = stored(_numbered(assigned.filter("shard is not null"), ["shard"], bucket, order, "slot"))
    limit = F.get(_array(quota), F.col("shard"))
    stays = placed.filter(F.col("slot") < limit)
    used = [0] * shards
    for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect():  # one row per shard
        used[r.shard] = min(r.n, quota[r.shard])
    pool = placed.filter(F.col("slot") >= limit).drop("slot").unionByName(assigned.filter("shard is null")).drop("shard")
    wide = F.pmod(F.xxhash64("key", "h1", F.lit("pool")), F.lit(BUCKETS * shards)).cast("int")
    ranked = _numbered(pool.withColumn("all", F.lit(0)), ["all"], wide, order, "at")
    gaps = _running([q - u for q, u in zip(quota, used, strict=True)])
    shard = F.size(F.filter(_array(gaps), lambda e: e <= F.col("at")))
    filled = ranked.withColumn("shard", shard).withColumn(
        "slot", F.col("at") - F.get(_array([0, *gaps]), F.col("shard")) + F.get(_array(used), F.col("shard"))
    )
    columns = ["key", "size", "text_crc32", "shard", "slot"]
    out = reduce(DataFrame.unionByName, [stays.select(columns), filled.select(columns)])
    return out.withColumn("slot", F.col("slot").cast("long")).withColumnRenamed("key", key)
