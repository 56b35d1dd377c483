"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

Every shard owns ``replicas`` points of a ring of ``CELLS`` cells. A row belongs to the first point at or after
the cell of its key. A shard takes its own rows up to its capacity, which is its share of all rows; the rows
beyond it continue clockwise, in ring order, to the next points whose shards still have room. Capacities add up to the
number of rows, so every row finds a place, shard sizes differ by at most one row, and only overflowing rows move.

Rows in the same place are told apart by counts, not by passing them through one task: the ring's arcs are cut into
``splits`` parts, the counts of all parts (a table bounded by points x splits) give each part its first rank, and a
window numbers the rows within a part. What is broadcast or gathered is bounded by the ring, not by the data.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

CELLS = 1 << 16


def ring_points(shards: int, replicas: int) -> list[tuple[int, int]]:
    """Sorted (cell, shard) of all virtual nodes; a shard's points do not depend on the other shards."""
    points = []
    for shard in range(shards):
        for replica in range(replicas):
            digest = hashlib.blake2b(f"{shard}/{replica}".encode(), digest_size=8).digest()
            points.append((int.from_bytes(digest, "big") % CELLS, shard))
    return sorted(points)


def key_cell(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(CELLS)).cast("int")


def _numbers(values) -> Column:
    """A constant array; written as one literal, since thousands of literals take seconds to pass to the JVM."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def _cells(spark: SparkSession, points: list[tuple[int, int]]) -> DataFrame:
    """(cell, arc) for each cell of the ring: ``CELLS`` rows."""
    bounds, start = [], 0
    for arc, (cell, _) in enumerate(points):
        if cell >= start:
            bounds.append((start, cell, arc))
            start = cell + 1
    if start < CELLS:
        bounds.append((start, CELLS - 1, 0))
    low, high, arc = (_numbers(column) for column in zip(*bounds))
    spans = spark.range(1).select(F.inline(F.arrays_zip(low.alias("low"), high.alias("high"), arc.alias("arc"))))
    return spans.select(F.explode(F.sequence("low", "high")).alias("cell"), "arc")


def _home(counts: DataFrame, points: list[tuple[int, int]], shards: int) -> DataFrame:
    """Per arc of the ring: rows, the rows its own shard takes, and where those start in the shard."""
    owners = _numbers(shard for _, shard in points)
    ring = counts.sparkSession.range(1).select(F.posexplode(owners).alias("arc", "shard"))
    arcs = ring.join(counts, "arc", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))
    total = F.sum("rows").over(Window.partitionBy(F.lit(0)))
    arcs = arcs.withColumn("capacity", F.floor(total / shards) + (F.col("shard") < total % shards).cast("long"))
    earlier = Window.partitionBy("shard").orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    arcs = arcs.withColumn("before", F.least("capacity", F.coalesce(F.sum("rows").over(earlier), F.lit(0))))
    return arcs.withColumn("kept", F.least(F.col("rows"), F.col("capacity") - F.col("before")))


def _walk(home: DataFrame, shards: int) -> DataFrame:
    """Overflow rows carried clockwise, twice around: (from_rank, shard, slot) of every take, in rank order.

    The fold is over points, with one number per shard as its state; overflowing rows keep their order.
    """
    room = F.col("capacity") - F.sum("kept").over(Window.partitionBy("shard"))
    entry = F.struct("arc", "shard", "capacity", (F.col("rows") - F.col("kept")).alias("over"), "room")
    around = home.withColumn("room", room).groupBy().agg(F.array_sort(F.collect_list(entry)).alias("arcs"))
    rooms = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.filter("arcs", lambda x: x["shard"] == s)[0]["room"])
    steps = F.concat("arcs", F.transform("arcs", lambda x: x.withField("over", F.lit(0).cast("long"))))
    zero = F.lit(0).cast("long")

    def step(state, arc):
        waiting = state["waiting"] + arc["over"]
        left = F.element_at(state["room"], arc["shard"] + 1)
        take = F.least(waiting, left)
        taken = F.struct(state["placed"].alias("from_rank"), arc["shard"].alias("shard"), (arc["capacity"] - left).alias("slot"))
        moved = F.struct(
            (waiting - take).alias("waiting"),
            F.transform(state["room"], lambda x, i: F.when(i == arc["shard"], x - take).otherwise(x)).alias("room"),
            (state["placed"] + take).alias("placed"),
            F.concat(state["takes"], F.array(taken)).alias("takes"),
        )
        passed = F.struct(waiting.alias("waiting"), state["room"].alias("room"), state["placed"].alias("placed"), state["takes"].alias("takes"))
        return F.when(take > 0, moved).otherwise(passed)

    none = F.expr("CAST(array() AS array<struct<from_rank: bigint, shard: int, slot: bigint>>)")
    start = F.struct(zero.alias("waiting"), rooms.alias("room"), zero.alias("placed"), none.alias("takes"))
    return around.select(F.inline(F.aggregate(steps, start, step)["takes"]))


def _pieces(home: DataFrame, takes: DataFrame) -> DataFrame:
    """Per arc, ranges of ranks with their shard and first slot: at most three times as many rows as points.

    Overflow rows form one line, in the order of arcs. It is cut where an arc begins (source) and where a take begins (target); every
    piece between two cuts has the arc and the take that began last.
    """
    rank = F.lit(0).cast("long")
    own = home.filter("kept > 0").select("arc", rank.alias("low"), F.col("kept").alias("high"), "shard", F.col("before").alias("slot"))

    over = home.filter("rows > kept").withColumn("size", F.col("rows") - F.col("kept"))
    line = Window.partitionBy(F.lit(0)).orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("size").over(line), F.lit(0))
    end = F.sum("size").over(Window.partitionBy(F.lit(0)))
    arcs = over.select("arc", "kept", at.alias("at"), end.alias("end"))

    none = F.lit(None)
    source = F.struct("arc", "at", "kept")
    target = F.struct(F.col("from_rank").alias("at"), "shard", "slot")
    no_source, no_target = none.cast("struct<arc: int, at: bigint, kept: bigint>"), none.cast("struct<at: bigint, shard: int, slot: bigint>")
    from_arcs = arcs.select("at", "end", source.alias("source"), no_target.alias("target"))
    from_takes = takes.select(F.col("from_rank").alias("at"), none.cast("bigint").alias("end"), no_source.alias("source"), target.alias("target"))
    upto = Window.partitionBy(F.lit(0)).orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    everywhere = Window.partitionBy(F.lit(0))
    cuts = from_arcs.unionByName(from_takes).select(
        "at",
        F.max("end").over(everywhere).alias("end"),
        F.max("source").over(upto).alias("source"),
        F.max("target").over(upto).alias("target"),
    )
    return own.unionByName(_between(cuts.distinct()))


def _between(cuts: DataFrame) -> DataFrame:
    following = Window.partitionBy(F.lit(0)).orderBy("at")
    pieces = cuts.withColumn("next", F.coalesce(F.lead("at").over(following), "end")).filter("next > at")
    into_arc = F.col("at") - F.col("source.at") + F.col("source.kept")
    return pieces.select(
        F.col("source.arc").alias("arc"),
        into_arc.alias("low"),
        (into_arc + F.col("next") - F.col("at")).alias("high"),
        F.col("target.shard").alias("shard"),
        (F.col("target.slot") + F.col("at") - F.col("target.at")).alias("slot"),
    )


def shard_rows(rows: DataFrame, key: str, order: list[str], shards: int, replicas: int = 64, splits: int = 16) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1), ``slot`` (from 0, without gaps) and ``home_shard`` (before overflow).

    ``key`` decides the place on the ring and ``order`` (key included) the rank of rows in one place. Rows equal in
    all of ``order`` are interchangeable. A null key is a key like any other; an empty table gives no rows. ``rows``
    must not have the columns added here: cell, arc, part, shard, slot, home_shard. It is read twice. Rows are dealt to parts by all of ``order``, so
    that rows which share a key, as a repeated id, are not all numbered by one task.
    """
    spark = rows.sparkSession
    points = ring_points(shards, replicas)
    cells = F.broadcast(_cells(spark, points))  # CELLS rows
    part = F.pmod(F.xxhash64(F.lit("part"), *order), F.lit(splits)).cast("int")

    def placed(df):
        return df.withColumn("cell", key_cell(F.col(key))).join(cells, "cell").drop("cell").withColumn("part", part)

    counts = placed(rows.select(*dict.fromkeys([key, *order]))).groupBy("arc", "part").agg(F.count("*").alias("rows"))
    by_arc = counts.groupBy("arc").agg(F.sum("rows").alias("rows"))
    home = _home(by_arc, points, shards)
    earlier = Window.partitionBy("arc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("arc", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first"))
    pieces = _pieces(home, _walk(home, shards))
    within = Window.partitionBy("arc", "part").orderBy(*order)
    ranked = placed(rows).withColumn("rank", F.row_number().over(within) - 1)
    ranked = ranked.join(F.broadcast(firsts), ["arc", "part"])  # points x splits rows
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("first")).drop("first", "part")
    found = ranked.join(
        F.broadcast(pieces.withColumnRenamed("arc", "piece_arc").withColumnRenamed("slot", "first_slot")),  # 3 x points rows
        (F.col("arc") == F.col("piece_arc")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    owner = F.element_at(_numbers(shard for _, shard in points), F.col("arc") + 1)
    return found.withColumns({"slot": F.col("first_slot") + F.col("rank") - F.col("low"), "home_shard": owner}).drop(
        "arc", "rank", "low", "high", "piece_arc", "first_slot"
    )


def shard_documents(docs: DataFrame, shards: int = 24, replicas: int = 64) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, home_shard.

    The law is ``rows``: shard sizes differ by at most one. ``size`` is the number of UTF-8 bytes (null: none) plus 8.
    Null and empty texts have the crc32 of no bytes, 0; a null doc_id is placed like any other key; repeated rows each get a
    slot. Only doc_id and text are read, so other columns and their names do not matter.
    """
    body = F.coalesce(docs["text"], F.lit("")).cast("binary")
    rows = docs.select(docs["doc_id"].alias("doc_id"), (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    rows = materialise(rows, "sizes")  # ids and numbers only: texts are read once
    placed = shard_rows(rows, "doc_id", ["doc_id", "text_crc32", "size"], shards, replicas)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home_shard"
    )
