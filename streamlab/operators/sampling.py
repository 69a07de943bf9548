"""Seeded splits and chunks that are exact, also where a key repeats.

Order comes from an MD5 of key and seed: uniform, repeatable and the same in any engine. Rows that
share a key are ordered by the rest of their content, so the result does not depend on how the
rows are spread over partitions; only rows that are equal in every column are interchangeable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, MapType, StructField, StructType, VariantType

_DIGITS = 4  # hex digits by which a cut is refined in one pass: 65,536 ranges per class


def seeded_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def _content(df: DataFrame) -> Column:
    """All columns as one text; NULL differs from any text."""
    return F.to_json(F.struct(*df.columns))


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    classes: Sequence,
    test: float = 0.25,
    seed: int = 42,
    row: Column | None = None,
    copies_together: bool = False,
) -> DataFrame:
    """Add ``em_teste``: exactly round(test x class size) rows of each class are test rows.

    Every row has a hash: of key and seed, then of its content, then ``row``, a column that
    tells equal rows apart (such as file and row number of a written table). The class's cut is
    refined by four hex digits per pass over a histogram of at most 65,536 ranges, until one
    range holds a single row or is taken whole; one or two passes do for any usual size. The
    data is neither sorted nor shuffled, and each pass returns one row per listed class. Rows
    of unlisted classes stay in the training part.

    ``copies_together`` keeps rows that share a key on one side; the share then is the largest
    one not above the exact one. Equal rows stay together where ``row`` is not given.
    """
    h = seeded_hash(key, seed)
    if not copies_together:
        h = F.concat(h, F.md5(_content(df)), *([row.cast("string")] if row is not None else []))
    known = df.where(F.col(label).isin(list(classes))).select(F.col(label).alias("_label"), h.alias("_h"))
    cuts: dict = {}  # class -> (prefix of the cut, rows still wanted in it, rows in it)
    depth = 0
    while True:
        open_ = {c: p for c, (p, rest, n) in cuts.items() if 0 < rest < n} if depth else None
        if open_ is not None and not open_:
            break
        rows = known
        if open_ is not None:
            wanted = F.create_map(*(F.lit(x) for c in open_ for x in (c, open_[c])))
            rows = known.where(F.startswith("_h", F.try_element_at(wanted, F.col("_label"))))
        part = F.substring("_h", 1, depth + _DIGITS).alias("_p")
        found = _cuts(rows.groupBy("_label", part).agg(F.count(F.lit(1)).alias("_n")), test, cuts)
        finer = {r["_label"]: (r["_p"], r["_rest"], r["_n"]) for r in found.collect()}
        if depth and all(finer[c][0] == cuts[c][0] for c in finer):
            break  # equal hashes: they stay together
        cuts |= finer
        depth += _DIGITS
    taken = F.lit(False)
    for c, (prefix, rest, n) in cuts.items():
        head = F.substring("_h", 1, len(prefix))
        taken = F.when(F.col(label) == c, head <= prefix if rest == n else head < prefix).otherwise(taken)
    return df.withColumn("_h", h).withColumn("em_teste", F.coalesce(taken, F.lit(False))).drop("_h")


def _cuts(histogram: DataFrame, test: float, cuts: dict) -> DataFrame:
    """Per class the range in which the wanted number of rows is reached."""
    by_label = Window.partitionBy("_label")
    upto = by_label.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = F.floor(F.sum("_n").over(by_label) * F.lit(test) + 0.5)
    if cuts:
        rest = F.create_map(*(F.lit(x) for c in cuts for x in (c, cuts[c][1])))
        want = F.try_element_at(rest, F.col("_label"))
    return (
        histogram.withColumns({"_want": want.cast("long"), "_upto": F.sum("_n").over(upto)})
        .where((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.greatest("_want", F.lit(1))))
        .select("_label", "_p", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_rest"), "_n")
    )


def _orderable(t: DataType) -> bool:
    if isinstance(t, StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    if isinstance(t, ArrayType):
        return _orderable(t.elementType)
    return not isinstance(t, (MapType, VariantType))


def shuffled_rank(df: DataFrame, key: str, path: str, seed: int = 7, name: str = "posicao") -> DataFrame:
    """1-based position of every row in the seeded shuffle.

    Rows are dealt into ranges of (hash, content), sorted and written once under ``path``: the only
    exchange of the data. A position is the row's place in its file plus the rows of earlier files.
    Ranges are even whatever the keys: a key with most of the rows spans many of them, and equal
    rows are told apart by a running number.
    """
    spark = df.sparkSession
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    others = [c for c in df.columns if c != key]
    plain = [F.col(c) for c in others if _orderable(df.schema[c].dataType)]
    odd = [F.to_json(F.struct(c)) for c in others if not _orderable(df.schema[c].dataType)]
    tagged = df.withColumns({"_h": seeded_hash(key, seed), "_i": F.monotonically_increasing_id()})
    order = [F.col("_h"), F.col(key), *plain, *odd, F.col("_i")]
    dealt = tagged.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    dealt.select(*df.columns, F.spark_partition_id().alias("_faixa")).write.mode("overwrite").parquet(path)
    schema = StructType([*df.schema.fields, StructField("_faixa", IntegerType())])
    file, place = F.col("_metadata.file_name").alias("_arquivo"), F.col("_metadata.row_index").alias("_r")
    rows = spark.read.schema(schema).parquet(path).select("*", file, place)
    # one row per file; a task that wrote several numbered them in order
    files = rows.groupBy("_arquivo").agg(F.min("_faixa").alias("_faixa"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_faixa", "_arquivo").rowsBetween(Window.unboundedPreceding, -1)
    base = files.select("_arquivo", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    ranked = rows.join(F.broadcast(base), "_arquivo")
    return ranked.select(*df.columns, (F.col("_base") + F.col("_r") + 1).cast("long").alias(name))


def assign_minibatch(df: DataFrame, key: str, path: str, size: int = 30, seed: int = 7) -> DataFrame:
    """Seeded shuffle cut into chunks of exactly ``size`` rows (the last may be shorter)."""
    ranked = shuffled_rank(df, key, path, seed)
    return ranked.withColumn("lote", F.floor((F.col("posicao") - 1) / F.lit(size)).cast("long") + 1).drop("posicao")


def hash_minibatch(df: DataFrame, key: str, batches: int, seed: int = 7) -> DataFrame:
    """Shuffle-free variant: ``batches`` chunks of about equal size, numbered from 1."""
    number = F.conv(F.substring(seeded_hash(key, seed), 1, 8), 16, 10).cast("long")
    return df.withColumn("lote", number % batches + 1)
