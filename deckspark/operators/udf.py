"""UDF surface (UDF-*): the slow path, offered for what built-ins cannot say.

Scalar and row functions run as Arrow-batched pandas UDFs (never
row-at-a-time pickling), group functions as ``applyInPandas``, table
functions as Arrow UDTFs; the comparator becomes a sort-key expression.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.index import deck_order_key


# UDF-01 -- a Python function per value; nulls are skipped (na_action="ignore")
def map_column(df: DataFrame, col: str, fn: Callable, out: str, return_type=T.StringType()) -> DataFrame:
    @F.pandas_udf(return_type)
    def _apply(s: pd.Series) -> pd.Series:
        return s.map(fn, na_action="ignore")

    return df.withColumn(out, _apply(F.col(col)))


# UDF-02 -- a Python function per row (receives a dict of the given columns)
def map_rows(df: DataFrame, cols: list[str], fn: Callable, out: str, return_type=T.StringType()) -> DataFrame:
    @F.pandas_udf(return_type)
    def _apply(rows: pd.DataFrame) -> pd.Series:
        return pd.Series([fn(r) for r in rows.to_dict("records")], index=rows.index)

    return df.withColumn(out, _apply(F.struct(*[F.col(c) for c in cols])))


# UDF-03 -- a pandas function per group
def apply_groups(df: DataFrame, key, fn: Callable[[pd.DataFrame], pd.DataFrame], schema, partial: Callable[[pd.DataFrame], pd.DataFrame] | None = None, partial_schema=None, many: bool = False) -> DataFrame:
    """``fn`` gets the whole group, which must be of bounded size.  With
    ``partial`` a group of any size will do: it makes few rows of the rows
    that a group has in one batch, before the shuffle, and ``fn`` gets those
    of all batches.

    A call costs more than a small group's work.  With ``many`` both functions
    get frames of many groups, each whole for ``fn``, and treat them group by
    group as pandas does; integers are ``Int64``, null where the row is."""
    keys = list(key) if isinstance(key, (list, tuple)) else [key]
    if many:
        if partial is not None:
            df = _map_frames(df, lambda frames: (partial(x) for x in frames), partial_schema)
        return _map_frames(df.repartition(*keys).sortWithinPartitions(*keys), lambda frames: (fn(x) for x in _whole_groups(frames, keys)), schema)
    if partial is not None:

        def run(batches):
            for pdf in batches:
                parts = [partial(g) for _, g in pdf.groupby(keys, dropna=False, sort=False)]
                if parts:
                    yield pd.concat(parts, ignore_index=True)

        df = df.mapInPandas(run, partial_schema)
    return df.groupBy(*keys).applyInPandas(fn, schema)


def _map_frames(df: DataFrame, fn: Callable[[Iterable[pd.DataFrame]], Iterable[pd.DataFrame]], schema: str) -> DataFrame:
    """``mapInPandas`` that keeps integers of columns with nulls exact."""
    kinds = {pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype()}

    def run(batches):
        frames = (b.to_pandas(types_mapper=kinds.get) for b in batches if b.num_rows)
        for out in fn(frames):
            yield from pa.Table.from_pandas(out, preserve_index=False).to_batches()

    return df.mapInArrow(run, schema)


def _whole_groups(frames: Iterable[pd.DataFrame], keys: list[str]) -> Iterable[pd.DataFrame]:
    """The rows of ``frames``, which come in order of ``keys``, in frames that
    end where a group does: a frame's last group waits for the next frame."""
    held = []
    for x in frames:
        codes = x.groupby(keys, dropna=False, sort=False).ngroup()
        if held:
            last = held[-1][keys].iloc[-1:]
            if pd.concat([last, x[keys].iloc[:1]]).duplicated().iloc[-1]:
                n = int((codes != codes.iloc[0]).to_numpy().argmax()) or len(x)
                held.append(x.iloc[:n])
                x, codes = x.iloc[n:], codes.iloc[n:]
            if len(x):
                yield pd.concat(held, ignore_index=True)
                held = []
        if len(x):
            n = int((codes == codes.iloc[-1]).to_numpy().argmax())
            if n:
                yield x.iloc[:n].reset_index(drop=True)
            held = [x.iloc[n:]]
    if held:
        yield pd.concat(held, ignore_index=True)


# UDF-04 -- the deck comparator as a sort key (see functions.index)
def order_by_key(idx: Column) -> list[Column]:
    return deck_order_key(idx)


# UDF-05 -- pluggable steps chained with DataFrame.transform
def apply_steps(df: DataFrame, steps: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    for step in steps:
        df = df.transform(step)
    return df


# UDF-07 -- table function: one row -> many (Arrow UDTF)
def explode_with(df: DataFrame, key: str, value: str, fn: Callable[[str], Iterable[str]], kind: str = "bigint", out: str = "line") -> DataFrame:
    """(key, i, out): what the Python generator ``fn`` makes of each value,
    numbered from 1; null values give nothing."""

    @F.udtf(returnType=f"key: {kind}, i: bigint, line: string", useArrow=True)
    class _Rows:
        def eval(self, k, t):
            if t is not None:
                for i, x in enumerate(fn(t), start=1):
                    yield k, i, x

    src = df.select(F.col(key).cast(kind).alias("k"), F.col(value).alias("t"))
    rows = src.lateralJoin(_Rows(F.col("k").outer(), F.col("t").outer()))
    return rows.select(F.col("key").alias(key), "i", F.col("line").alias(out))


def wrap_words(text: str, width: int) -> Iterable[str]:
    """Lines of at most ``width`` characters, filled greedily with the words
    between single spaces; a longer word has a line of its own."""
    line = None
    for word in text.split(" "):
        if line is not None and len(line) + 1 + len(word) <= width:
            line = f"{line} {word}"
        else:
            if line is not None:
                yield line
            line = word
    if line is not None:
        yield line


def without_accents(text: str) -> str:
    """Letters without their marks, in composed form."""
    bare = (c for c in unicodedata.normalize("NFD", text) if not unicodedata.category(c).startswith("M"))
    return unicodedata.normalize("NFC", "".join(bare))


def jaro(a: str, b: str) -> float:
    """Jaro's similarity: shared characters that are not far apart, less
    half of those out of order."""
    if not a or not b:
        return float(a == b)
    reach = max(len(a), len(b)) // 2 - 1
    used, mine = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                mine.append(c)
                break
    if not mine:
        return 0.0
    theirs = [c for c, u in zip(b, used) if u]
    m, moved = len(mine), sum(x != y for x, y in zip(mine, theirs)) // 2
    return (m / len(a) + m / len(b) + (m - moved) / m) / 3
