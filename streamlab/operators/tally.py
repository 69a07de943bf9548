"""Keyed tallies: running counts, zero-filled totals, fixed-column pivots and winners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.functions import composite_key, versus
from streamlab.schemas import CANDIDATES


def running_count(df: DataFrame, keys: Sequence[str], name: str = "votos") -> DataFrame:
    """Rows per key; on a stream in update mode each batch emits the keys it touched."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def tally_documents(counts: DataFrame) -> DataFrame:
    """(estado, candidato, votos) -> keyed rows of the tally table."""
    return counts.select(
        composite_key("estado", "candidato").alias("_id"), "estado", "candidato", "votos"
    )


def fill_domain(
    df: DataFrame,
    key: str,
    domain: Sequence[str],
    measures: Sequence[str],
    keep_unknown: bool = True,
) -> DataFrame:
    """Sum ``measures`` per key with every domain value present, 0 where it has no row.

    The domain enters as zero rows ahead of the one aggregation, so no join is needed.
    Values outside the domain (NULL included) stay unless ``keep_unknown`` is off.
    """
    spark = df.sparkSession
    values = F.explode(F.array(*[F.lit(v) for v in domain]))
    zeros = spark.range(0, 1, 1, 1).select(
        values.alias(key), *[F.lit(0).cast(df.schema[m].dataType).alias(m) for m in measures]
    )
    rows = df.select(key, *measures)
    if not keep_unknown:
        rows = rows.where(F.col(key).isin(list(domain)))
    return (
        rows.unionByName(zeros)
        .groupBy(key)
        .agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    )


def national_total(tally: DataFrame, candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """Votes per candidate: the listed ones always, unknown ones when they have votes."""
    return fill_domain(tally, "candidato", candidates, ["votos"])


def leader(totals: DataFrame, candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """Who leads the partial national count; votes without a state count here too."""
    a, b = candidates
    sums = totals.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("candidato") == c, F.col("votos"))), F.lit(0)).alias(n)
            for c, n in ((a, "votos_a"), (b, "votos_b"))
        ]
    )
    return sums.withColumn("lider", versus("votos_a", "votos_b", a, b))


def ranked_total(tally: DataFrame) -> DataFrame:
    totals = tally.groupBy("candidato").agg(F.sum("votos").alias("votos"))
    return totals.orderBy(F.desc("votos"), F.asc("candidato"))


def pivot_sum(
    df: DataFrame, row: str, col: str, values: Sequence[str], measure: str
) -> DataFrame:
    """One row per ``row`` value, one column per listed ``col`` value, missing cells 0.

    Rows with a NULL in either key are left out; a row whose ``col`` values are all
    unlisted stays with zeros. Written as conditional sums: one shuffle, combined on the
    map side, where a two-step pivot would take two.
    """
    cells = [
        F.coalesce(F.sum(F.when(F.col(col) == v, F.col(measure))), F.lit(0)).alias(v)
        for v in values
    ]
    present = F.col(row).isNotNull() & F.col(col).isNotNull()
    return df.where(present).groupBy(row).agg(*cells)


def winners_by_state(tally: DataFrame, candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """State x candidate votes with the winner (or tie) of each state."""
    a, b = candidates
    board = pivot_sum(tally, "estado", "candidato", candidates, "votos")
    return board.withColumn("VENCEDOR", versus(F.col(f"`{a}`"), F.col(f"`{b}`"), a, b))


def states_won(board: DataFrame, candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """How many states each side won, and how many were tied."""
    a, b = candidates
    won = F.col("VENCEDOR")
    return board.agg(
        F.count_if(won == a).alias("estados_a"),
        F.count_if(won == b).alias("estados_b"),
        F.count_if(~won.isin(a, b)).alias("empates"),
    )


def champion(board: DataFrame, candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """Popular vote of the two sides and its winner."""
    a, b = candidates
    sums = board.agg(
        F.coalesce(F.sum(F.col(f"`{a}`")), F.lit(0)).alias("votos_a"),
        F.coalesce(F.sum(F.col(f"`{b}`")), F.lit(0)).alias("votos_b"),
    )
    return sums.withColumn("campeao", versus("votos_a", "votos_b", a, b))
