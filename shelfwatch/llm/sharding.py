"""Even shards in which equal texts stay together, by label propagation under quotas.

Documents of one text form a group; a group is a hub its documents are linked with, so links grow with the documents
and not with their pairs. Documents begin in a shard by hash. In every round a join gives each document the shard in
which its group is strongest; moves between two shards are requested, the quotas grant as many as both sides allow, and
the documents of the least hash go. Documents without a partner are free and fill what is left at the end, so granting
a move never needs a counterpart. A group larger than a shard is dealt into as few parts as fit beforehand.

What the driver sees is a count per pair of shards. Ranks that decide who moves and who gets which slot are formed in
two steps, within buckets of bounded size and over the buckets' counts, so no group, shard or move is ever ordered in
one task.

Law `rows`: counts differ by one at most. Defined results: null texts are no group, empty ones are; rows that repeat an
id and a text are documents of the same group; a null id is kept; columns other than the id and the text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.llm.tables import saved

ROUNDS = 8
ROWS_PER_BUCKET = 5_000
ROW_BYTES = 16
# How full a shard a part of a large group may make.
FILL = 0.9


def ranked(df: DataFrame, keys: list[str], lead: Column, n_rows: int, name: str = "rank") -> DataFrame:
    """Adds a gapless rank from 0 within `keys`. Rows of one `lead` (a hash of their group) are next to each other.

    Rows go to buckets by `lead`, those of a group too large for a bucket to several. Each bucket is ranked on its own;
    how many rows lie in earlier buckets of the same key is counted apart, one row per key and bucket.
    """
    buckets = max(1, -(-n_rows // ROWS_PER_BUCKET))
    parts = F.ceil(F.col("group_size") / ROWS_PER_BUCKET)
    part = F.when(parts > 1, F.pmod(F.xxhash64("row_key", F.lit(7)), parts) + 1).otherwise(0)
    df = df.withColumns({"_lead": lead, "_bucket": F.pmod(lead, F.lit(buckets)), "_part": part.cast("long")})
    bucket = [*keys, "_bucket", "_part"]
    before = Window.partitionBy(*keys).orderBy("_bucket", "_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*bucket).agg(F.count("*").alias("_n"))
    counts = saved(counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "buckets")
    inside = Window.partitionBy(*bucket).orderBy("_lead", "row_key")
    df = df.withColumn("_at", F.row_number().over(inside) - 1).join(counts, bucket)
    return df.withColumn(name, (F.col("_at") + F.col("_before")).cast("long")).drop("_lead", "_at", "_before", "_bucket", "_part")


def granted(requests: dict[tuple[int, int], int], load: list[int], quota: list[int]) -> dict[tuple[int, int], int]:
    """How many of the requested moves may go so that no shard is above its quota afterwards.

    First what two shards, or a cycle through a third, exchange one for one; then what finds room.
    """
    load, out = list(load), {}
    left = {k: n for k, n in requests.items() if n > 0}

    def grant(pair, n):
        out[pair] = out.get(pair, 0) + n
        left[pair] -= n
        load[pair[0]] -= n
        load[pair[1]] += n

    for a, b in sorted(left):
        if a < b and (n := min(left[a, b], left.get((b, a), 0))):
            grant((a, b), n)
            grant((b, a), n)
    moved = True
    while moved:
        moved = False
        for (a, b), n in sorted(left.items(), key=lambda x: (-x[1], x[0])):
            if take := min(n, quota[b] - load[b]):
                if take > 0:
                    grant((a, b), take)
                    moved = True
    return out


def quotas(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def _place(docs: DataFrame, shards: int, quota: list[int]) -> DataFrame:
    """The documents of groups, with the shard in which label propagation leaves them."""
    spark = docs.sparkSession
    linked = docs.filter("group_size > 1")
    # A group that no shard could hold is dealt into parts that one can; its rows know of them by their own hash.
    parts = F.ceil(F.col("group_size") / (FILL * max(1, min(quota)))).cast("long")
    linked = linked.withColumn("group_id", F.xxhash64("text_hash", F.pmod(F.xxhash64("row_key", F.lit(1)), parts)))
    state = saved(linked.withColumn("shard", F.pmod(F.xxhash64("row_key", F.lit(0)), F.lit(shards)).cast("int")), "state")
    for number in range(1, ROUNDS + 1):
        held = saved(state.groupBy("group_id", "shard").agg(F.count("*").alias("held")), "held")
        load = [0] * shards
        for r in held.groupBy("shard").agg(F.sum("held").cast("long").alias("n")).collect():  # a row per shard
            load[r.shard] = r.n
        room = spark.createDataFrame([(k, quota[k] - load[k]) for k in range(shards)], "shard int, room long")
        # The strongest shard, of those that have room for all of the group if there are any; equal ones are told
        # apart by hash, so groups don't all choose the same.
        whole = held.groupBy("group_id").agg(F.sum("held").alias("whole"))
        fits = held.join(whole, "group_id").join(F.broadcast(room), "shard").withColumn("fits", F.expr("held + room >= whole"))
        tie = F.xxhash64("group_id", "shard", F.lit(number))
        wanted = fits.groupBy("group_id").agg(F.max(F.struct("fits", "held", tie.alias("tie"), "shard")).alias("best"))
        wanted = saved(wanted.select("group_id", F.col("best.shard").alias("target")), "wanted")
        asked = held.join(wanted, "group_id").filter("shard != target")
        asked = asked.groupBy("shard", "target").agg(F.sum("held").cast("long").alias("n"))
        requests = {(r.shard, r.target): r.n for r in asked.collect()}  # a row per pair of shards
        if not requests:
            break
        limits = granted(requests, load, quota)
        allowed = spark.createDataFrame([(a, b, n) for (a, b), n in limits.items()], "shard int, target int, allowed long")
        moving = state.join(wanted, "group_id").filter("shard != target")
        # In the order of groups, so that a grant cuts through one group at most.
        moves = ranked(moving, ["shard", "target"], F.xxhash64("group_id", F.lit(number)), sum(requests.values()))
        moves = moves.join(F.broadcast(allowed), ["shard", "target"]).filter("rank < allowed")
        moves = saved(moves.select("row_key", F.col("target").alias("moved_to")).distinct(), "moves")
        state = state.join(moves, "row_key", "left").withColumn("shard", F.coalesce("moved_to", "shard")).drop("moved_to")
        state = saved(state, "state")
    return state


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Per document: doc_id, size, text_crc32, shard, slot (gapless from 0 in its shard), group_size, law, grown_shard."""
    text = F.encode("text", "UTF-8")
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.unhex(F.md5("text")).alias("text_hash"),
    )
    # A row of its own for each document, also where ids and texts repeat.
    # A row of its own for each document, also where ids and texts repeat.
    docs = docs.groupBy("doc_id", "size", "text_crc32", "text_hash").agg(F.count("*").alias("times"))
    docs = docs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times")
    docs = saved(docs.withColumn("row_key", F.xxhash64("doc_id", "text_hash", "copy")), "rows")
    groups = docs.filter("text_hash IS NOT NULL").groupBy("text_hash").agg(F.count("*").alias("group_size"))
    # Written, so that both sides of the join are plain shuffles and AQE can split a text that many rows have.
    docs = docs.join(saved(groups.filter("group_size > 1"), "groups"), "text_hash", "left")
    docs = saved(docs.withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("long"))), "documents")
    n_rows = docs.count()
    quota = quotas(n_rows, shards)
    spark = docs.sparkSession
    state = _place(docs, shards, quota)

    # Of a shard above its quota, the documents beyond it are free again; so are all without a group.
    limits = spark.createDataFrame(list(enumerate(quota)), "shard int, quota long")
    linked = ranked(state, ["shard"], F.xxhash64("group_id"), n_rows).join(F.broadcast(limits), "shard")
    linked = saved(linked.filter("rank < quota").drop("rank", "quota"), "linked")
    taken = {r.shard: r.n for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # a row per shard
    ends, end = [], 0
    for s, q in enumerate(quota):
        room = q - taken.get(s, 0)
        ends.append((s, end, end + room, taken.get(s, 0)))
        end += room
    room = spark.createDataFrame(ends, "shard int, low long, high long, taken long")
    free = docs.join(linked.select("row_key"), "row_key", "left_anti").withColumn("all", F.lit(0))
    # What was left over of a group stays together in the order, and so mostly in one shard.
    lead = F.when(F.col("group_size") > 1, F.xxhash64("text_hash")).otherwise(F.xxhash64("row_key"))
    free = ranked(free, ["all"], lead, n_rows)
    free = free.join(F.broadcast(room), (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    free = free.withColumn("slot", F.col("rank") - F.col("low") + F.col("taken"))
    linked = ranked(linked, ["shard"], F.xxhash64("group_id"), n_rows, "slot")
    columns = ["doc_id", "size", "text_crc32", "shard", "slot", "group_size"]
    return linked.select(columns).union(free.select(columns)).withColumns(
        {"law": F.lit("rows"), "slot": F.col("slot").cast("long"), "grown_shard": F.lit(None).cast("int")}
    )
