"""Sharding by vector bin packing: bytes, tokens and rows balanced together.

Documents with equal texts form a group that stays in one shard, unless it is heavier than a
shard's fair share. Groups are placed, heaviest first, where the dot product of the group's
vector (bytes, tokens, rows as shares of the total) with the shard's residual capacity is highest,
among the shards that have the room in bytes (the one with most, where none has): bytes come out
near equal, tokens and rows as even as that allows.

What is placed one by one is bounded by parameters, whatever the input's size: groups that weigh
more than ``1 / UNITS`` of the total in some dimension (so at most ``3 * UNITS``), and ``2 *
UNITS`` hash ranges of all lighter groups, of two widths, so that the last ones to be placed are
small. A group over a shard's fair share is cut, by a hash of the id, into parts that are not.

Slots number the rows of a shard from 0 without gaps: an offset per unit from the unit's counts,
and a row number within the unit; heavy groups are numbered in parts of about ``1 / UNITS``.

Handling of odd input: a NULL text counts as no bytes and no words and forms a group of its own,
apart from the empty text; an empty table gives no rows; rows that repeat, or have a NULL id, are
placed like others; ties are broken by text and id; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlab.llm.session import written

SHARDS = 16
UNITS = 4096
_CUTS = 4  # parts a shard's fair share of a group that must be cut is made of
_FINE = 16  # a narrow hash range is one sixteenth of a wide one


def place(weights: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unit; ``weights`` has one row per unit (bytes first) and sums to 1 in each column."""
    room = np.full((shards, weights.shape[1]), 1.0 / shards)
    out = np.empty(len(weights), np.int32)
    for i in np.argsort(-weights.max(axis=1), kind="stable"):
        fits = room[:, 0] >= weights[i, 0]
        out[i] = k = int(np.argmax(np.where(fits, room @ weights[i], -np.inf) if fits.any() else room[:, 0]))
        room[k] -= weights[i]
    return out


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Small columns per row; the text itself goes no further."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("null")).alias("text_key"),
    )


def shard(docs: DataFrame, shards: int = SHARDS, units: int = UNITS, text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    spark = docs.sparkSession
    rows = written(measured(docs, text), "measured")
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = rows.agg(*sums).first()
    if not total["rows"]:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    whole = np.maximum([total["size"], total["tokens"] or 0, total["rows"]], 1).astype(float)
    share = F.greatest(*(F.col(c) / float(w) for c, w in zip(("size", "tokens", "rows"), whole)))
    heavy = (
        rows.groupBy("text_key").agg(*sums).withColumn("share", share).where(F.col("share") > 1.0 / units)
        .select("text_key", F.when(F.col("share") > 1.0 / shards, F.ceil(F.col("share") * shards * _CUTS)).otherwise(1).cast("int").alias("cuts"), F.ceil(F.col("share") * units).cast("int").alias("parts"))
    )
    # a hash range is wide or narrow by its first draw; both kinds have `units` ranges
    draw = F.pmod(F.xxhash64("text_key"), F.lit(units * (_FINE + 1)))
    light = F.when(draw < units * _FINE, F.floor(draw / _FINE)).otherwise(draw - units * _FINE + units)
    by_id = F.xxhash64("doc_id", "text_key")
    # at most 3 * units rows
    cut = rows.join(F.broadcast(heavy), "text_key", "left").select(
        "doc_id", "size", "text_crc32", "tokens", "text_key",
        F.when(F.col("parts").isNull(), F.concat(F.lit("r"), light.cast("string")))
        .otherwise(F.concat_ws("/", F.lit("g"), "text_key", F.pmod(by_id, F.col("cuts")))).alias("unit"),
        F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.pmod(F.floor(by_id / 65536), F.col("parts")).cast("int")).alias("part"),
    )
    cut = written(cut, "units")
    # at most (3 + 2) * units units and 4 * units parts of heavy ones
    counts = cut.groupBy("unit", "part").agg(*sums).toPandas().sort_values(["unit", "part"], kind="stable", ignore_index=True)
    names, of = np.unique(counts["unit"].to_numpy(str), return_inverse=True)
    weights = np.stack([np.bincount(of, counts[c], len(names)) for c in ("size", "tokens", "rows")], axis=1) / whole
    counts["shard"] = place(weights, shards)[of]
    counts["first"] = counts.groupby("shard")["rows"].cumsum() - counts["rows"]
    places = spark.createDataFrame(counts[["unit", "part", "shard", "first"]], "unit string, part int, shard int, first long")
    within = F.row_number().over(Window.partitionBy("unit", "part").orderBy("text_key", "doc_id", "size"))
    return (
        cut.withColumn("place", within - 1).join(F.broadcast(places), ["unit", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("place")).alias("slot"))
    )
