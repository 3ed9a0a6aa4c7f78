"""Stored decks that are patched in place (UP-03 and UP-08 on files).

A stored deck is a parquet table in folders of index ranges; a folder is named
by the first index of its range, so the folders themselves tell where a row
belongs.  A patch finds the range of each of its rows, reads and merges those
ranges only, and replaces only their folders (dynamic partition overwrite);
all other files stay as they are.  The merged ranges are written to the
shared folder before they replace anything, so a lost executor or a failed
attempt never leaves a deck that was read while it changed, and a patch that
is applied again changes nothing.

Rows with a null index form a range of their own.  A range that has grown to
twice the rows it should hold is split when it is next touched.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scan import asof_join
from ..operators.window import number_rows
from ..session import cut_lineage

RANGE_ROWS = 1_000_000  # rows that a range should hold
_RANGE = "index_range"
_NULL = "null"


def _name(key) -> F.Column:
    """A range's folder: its first index after a letter, so that it is read
    as text whatever the index looks like."""
    return F.concat(F.lit("from "), F.col(key).cast("string") if isinstance(key, str) else key.cast("string"))


def create_store(deck: DataFrame, path: str, key: str, rows: int = RANGE_ROWS) -> None:
    """Write ``deck`` as a stored deck of ranges of ``rows`` rows."""
    _write(_cut(deck, key, rows), path)


def _cut(deck: DataFrame, key: str, rows: int) -> DataFrame:
    """Rows with the name of their range, ``rows`` to each; equal indices
    share a range."""
    numbered = number_rows(deck.where(F.col(key).isNotNull()), [], [key], "__nth").withColumn("__block", F.floor((F.col("__nth") - 1) / rows))
    # a block starts at its first index that no earlier block has
    firsts = numbered.groupBy(key).agg(F.min("__block").alias("__block"))
    starts = firsts.groupBy("__block").agg(F.min(key).alias("__from"))
    named = numbered.drop("__nth", "__block").join(firsts, key).join(starts, "__block").withColumn(_RANGE, _name("__from")).drop("__block", "__from")
    return named.select(*deck.columns, _RANGE).unionByName(deck.where(F.col(key).isNull()).withColumn(_RANGE, F.lit(_NULL)))


def _write(rows: DataFrame, path: str) -> None:
    # a task holds whole ranges, so a range is one file (or a few, if huge)
    dealt = rows.repartition(F.col(_RANGE))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_RANGE).parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(_RANGE)


def _ranged(rows: DataFrame, key: str, names: DataFrame) -> DataFrame:
    """``rows`` with the range of each: the last that starts at or before
    its index, the first for smaller ones."""
    kind = rows.schema[key].dataType
    starts = names.where(F.col(_RANGE) != _NULL).select(F.expr(f"substring({_RANGE}, 6)").cast(kind).alias(key), _RANGE)
    first = starts.agg(F.min_by(_RANGE, key).alias("x")).first()["x"]
    near = asof_join(rows, starts, key)
    own = F.coalesce(f"{_RANGE}_r", F.lit(first) if first else _name(key))
    return near.select(*rows.columns, F.when(F.col(key).isNull(), _NULL).otherwise(own).alias(_RANGE))


def upsert_store(spark: SparkSession, path: str, incoming: DataFrame, key: str, rows: int = RANGE_ROWS, insert: bool = True) -> list[str]:
    """Rows of ``incoming`` (one per index, with the deck's columns) replace
    the stored rows of their index; the others are added if ``insert``.
    Returns the names of the ranges that were rewritten."""
    stored = spark.read.parquet(path)
    cols = [c for c in stored.columns if c != _RANGE]
    # the folders are known without reading a file: one value per range
    names = stored.select(_RANGE).distinct()
    patch = cut_lineage(_ranged(incoming.select(*cols), key, names), "patch")
    touched = sorted(r[0] for r in patch.select(_RANGE).distinct().collect())  # at most one per range
    if not touched:
        return []
    base = stored.where(F.col(_RANGE).isin(touched))
    new = patch.select(F.col(key).alias("__key"), F.col(_RANGE).alias("__range"), F.lit(True).alias("__new"), *[F.col(c).alias(f"__n_{c}") for c in cols if c != key])
    j = base.join(new, F.col(key).eqNullSafe(F.col("__key")), "full" if insert else "left")
    pick = lambda c: F.when(F.col("__new"), F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c)
    merged = j.select(
        *[F.when(F.col("__new"), F.col("__key")).otherwise(F.col(key)).alias(key) if c == key else pick(c) for c in cols],
        F.coalesce(_RANGE, "__range").alias(_RANGE),
    )
    merged = cut_lineage(merged, "merged")
    large = [r[0] for r in merged.groupBy(_RANGE).count().where(F.col("count") > 2 * rows).collect() if r[0] != _NULL]
    if large:
        split = _cut(merged.where(F.col(_RANGE).isin(large)).drop(_RANGE), key, rows)
        # the first part keeps the name, so that the folder is replaced
        lowest = merged.where(F.col(_RANGE).isin(large)).groupBy(F.col(_RANGE).alias("__old")).agg(_name(F.min(key)).alias("__first"))
        split = split.join(lowest, F.col(_RANGE) == F.col("__first"), "left").withColumn(_RANGE, F.coalesce("__old", _RANGE)).drop("__old", "__first")
        merged = cut_lineage(merged.where(~F.col(_RANGE).isin(large)).unionByName(split), "split")
    _write(merged, path)
    return touched


def patch_store(spark: SparkSession, path: str, patch: DataFrame, key: str, rows: int = RANGE_ROWS) -> list[str]:
    """Only stored indices are overwritten."""
    return upsert_store(spark, path, patch, key, rows, insert=False)


def store_or_create(spark: SparkSession, path: str, deck: DataFrame, key: str, rows: int = RANGE_ROWS) -> None:
    """Upsert into the stored deck at ``path``, which is created where there
    is none."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        create_store(deck, path, key, rows)
        return
    upsert_store(spark, path, deck, key, rows)
