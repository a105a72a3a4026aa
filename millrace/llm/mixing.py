"""Mixing sources to target weights by repeating documents.

Words are summed up per source, each source gets a target number of words, and target / size is the repetition
rate of its documents: every document is taken floor(rate) times, and once more if a number in [0, 1) that is
hashed from seed, id and text falls below the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import ROWS_A_FILE, WORD, checkpointed, columns_of, free_name, quoted

BROADCAST_BYTES = 16 << 20  # a table of sources above this is joined by a shuffle


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int, doc_id: Column, text: Column) -> Column:
    """52 bits of an MD5 as a number in [0, 1); the same on every run and in every engine."""
    said = F.concat(
        F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit(""))
    )
    return F.conv(F.substring(F.md5(said.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def source_key(source: Column) -> Column:
    """Never null, and in the order of code points with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def source_sizes(docs: DataFrame) -> DataFrame:
    """``source_key, source_size``: words per source, summed up before the shuffle."""
    sized = docs.select(source_key(quoted("source")).alias("source_key"), words(quoted("text")).alias("size"))
    return checkpointed(sized.groupBy("source_key").agg(F.sum("size").alias("source_size")))


def cyclic_weights(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Give sources in key order the weights in turn; ``weight`` is added.

    The order is found by ranges: each partition numbers its own sources, and only the partitions' row counts
    go to the driver.
    """
    parts = -(-sizes.count() // ROWS_A_FILE) or 1
    placed = checkpointed(sizes.repartitionByRange(parts, "source_key").withColumn("part", F.spark_partition_id()))
    before, offsets = 0, []
    for part, rows in sorted(map(tuple, placed.groupBy("part").count().collect())):
        offsets += [F.lit(part), F.lit(before)]
        before += rows
    if not offsets:
        return sizes.withColumn("weight", F.lit(1))
    own = F.row_number().over(Window.partitionBy("part").orderBy("source_key")) - 1
    place = (own + F.create_map(*offsets)[F.col("part")]) % len(weights)
    return placed.withColumn("weight", F.array(*map(F.lit, weights))[place.cast("int")]).drop("part")


def targets(weighted: DataFrame, share: float, most: float) -> DataFrame:
    """Share ``share`` times all words by weight; a source gets ``most`` times its size at most.

    What a full source leaves is shared again among the others by weight until none is above. The driver sees
    two sums a round. Adds ``target``; a source without words has target 0.
    """
    sources = weighted.count()
    weighted = checkpointed(weighted, sources)
    full = F.col("source_size") * F.lit(float(most))
    words_, weight = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    total, left, rest = share * (words_ or 0), share * (words_ or 0), float(weight or 0)
    while True:
        above = full * F.lit(rest) < F.col("weight") * F.lit(left)
        taken, open_weight = weighted.agg(
            F.sum(F.when(above, full)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        now = (total - (taken or 0.0), float(open_weight or 0))
        if now == (left, rest) or not now[1]:
            break
        left, rest = now
    open_target = F.col("weight") * F.lit(left) / F.lit(rest or 1.0)
    return weighted.withColumn("target", F.when(above, full).otherwise(open_target).cast("double"))


PLAN = ("size", "source_size", "target", "copies")


def mix_plan(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 17,
    names: tuple[str, str, str, str] = PLAN,
) -> DataFrame:
    """The documents with ``size, source_size, target, copies``: how often each is taken.

    Null texts have size 0, null is a source of its own (the last in order), and null ids draw by their text
    alone. Rows equal in id and text share a draw. A source without words has rate 0. Columns of ``docs`` with
    one of the added names (which ``names`` may change) are replaced. Empty tables give empty results.
    """
    size, source_size, target, copies = names
    rates = targets(cyclic_weights(source_sizes(columns_of(docs, "source", "text")), weights), share, most)
    rates = rates.select("source_key", "source_size", "target")
    bytes_ = rates.agg(F.sum(F.octet_length("source_key") + 64)).first()[0] or 0
    key = free_name([*docs.columns, *names], "source_key")
    rates = rates.select(*(F.col(c).alias(n) for c, n in zip(rates.columns, (key, source_size, target))))
    plain = docs.select(*(quoted(c) for c in docs.columns if c.lower() not in names))
    sized = plain.withColumn(key, source_key(quoted("source"))).withColumn(size, words(quoted("text")))
    joined = sized.join(F.broadcast(rates) if bytes_ <= BROADCAST_BYTES else rates, key).drop(key)
    rate = F.coalesce(F.col(target) / F.nullif(F.col(source_size), F.lit(0)), F.lit(0.0))
    more = (draw(seed, quoted("doc_id"), quoted("text")) < rate - F.floor(rate)).cast("long")
    return joined.withColumn(copies, F.floor(rate).cast("long") + more)


def mix(docs: DataFrame, copy_column: str = "copy", **settings) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, numbered from 1 in ``copy_column``.

    Columns are those of ``docs``, one named like ``copy_column`` replaced. Nulls and ties: see ``mix_plan``.
    """
    names = tuple(free_name([*docs.columns, copy_column], f"mix_{n}") for n in PLAN)
    planned = mix_plan(docs, names=names, **settings)
    times = F.when(F.col(names[3]) > 0, F.sequence(F.lit(1).cast("long"), F.col(names[3])))
    own = (quoted(c) for c in docs.columns if c.lower() != copy_column.lower())
    return planned.select(*own, F.explode(times).alias(copy_column))
