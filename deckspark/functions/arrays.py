"""Array, map and JSON column functions (ARR-*, MAP-*, JSN-*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_literal(c, sep: str) -> Column:
    """Split on a literal separator (Spark's split takes a regex)."""
    import re

    return F.split(_c(c), re.escape(sep))


# ARR-03 -- remove listed tokens, keeping duplicates and order
def drop_tokens(arr, tokens: list[str]) -> Column:
    lit = F.array(*[F.lit(t) for t in tokens])
    return F.filter(_c(arr), lambda x: ~F.array_contains(lit, x))


# ARR-07 -- Python zip: pairs up to the shorter array
def zip_shortest(a, b) -> Column:
    n = F.least(F.size(_c(a)), F.size(_c(b)))
    return F.slice(F.arrays_zip(_c(a), _c(b)), 1, n)


# ARR-08 -- n blanks at both ends
def pad_array(arr, n: int, blank: str = "") -> Column:
    pad = F.array_repeat(F.lit(blank), n)
    return F.concat(pad, _c(arr), pad)


# ARR-09 -- number of leading / trailing blank strings
def leading_blanks(arr) -> Column:
    a = _c(arr)
    first = F.array_position(F.transform(a, lambda x: F.trim(x) != ""), True)
    return F.when(first == 0, F.size(a)).otherwise(first - 1).cast("int")


def trailing_blanks(arr) -> Column:
    return leading_blanks(F.reverse(_c(arr)))


# ARR-10 -- replace element at 0-based position
def set_at(arr, i: int, value) -> Column:
    v = value if isinstance(value, Column) else F.lit(value)
    return F.transform(_c(arr), lambda x, j: F.when(j == i, v).otherwise(x))


# ARR-11 -- sum of element lengths (+ per-element extra)
def sum_lengths(arr, extra: int = 0) -> Column:
    return F.aggregate(_c(arr), F.lit(0).cast("bigint"), lambda acc, x: acc + F.char_length(x) + extra)


# ARR-13 -- 1..count as an array (explode to numbered rows)
def series(count, start: int = 1) -> Column:
    return F.sequence(F.lit(start), _c(count).cast("int"))


# MAP-01
def zip_map(keys, values) -> Column:
    return F.map_from_arrays(_c(keys), _c(values))


def map_merge(*maps) -> Column:
    """Merge maps left to right; on a duplicate key the right value wins.
    Keys of the right map are filtered out of the left one first, so no
    session-wide dedup policy is needed."""
    out = _c(maps[0])
    for m in maps[1:]:
        right = _c(m)
        left = F.map_filter(out, lambda k, v: ~F.array_contains(F.map_keys(right), k))
        out = F.map_concat(left, right)
    return out


# MAP-02
def map_get(m, key, default=None) -> Column:
    k = key if isinstance(key, Column) else F.lit(key)
    v = F.element_at(_c(m), k)
    return v if default is None else F.coalesce(v, F.lit(default))


# JN-16 -- f/m/n -> die/der/das; an unknown code gives null
def article_of(code) -> Column:
    from ..schema import ARTICLES_FULL, ARTICLES_SHORT

    m = F.create_map(*[x for pair in zip(ARTICLES_SHORT, ARTICLES_FULL) for x in (F.lit(pair[0]), F.lit(pair[1]))])
    return F.element_at(m, _c(code))


# ---- JSON ----------------------------------------------------------------

RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField(
            "choices",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "message",
                            T.StructType(
                                [
                                    T.StructField("role", T.StringType()),
                                    T.StructField("content", T.StringType()),
                                ]
                            ),
                        )
                    ]
                )
            ),
        )
    ]
)


# JSN-01 -- choices[0].message.content of a response object
def response_text(c) -> Column:
    parsed = F.from_json(_c(c), RESPONSE_SCHEMA, {"mode": "PERMISSIVE"})
    return F.try_element_at(parsed["choices"], F.lit(1))["message"]["content"]


# JSN-02 -- a response is valid when the required path is present
def is_valid_response(c) -> Column:
    return response_text(c).isNotNull()


# JSN-03 -- {"model": m, "messages": [the prompt, then the rows]}, both of
# the user's role
def to_request(prompt, payload, model: str) -> Column:
    said = lambda c: F.struct(F.lit("user").alias("role"), _c(c).alias("content"))
    return F.to_json(F.struct(F.lit(model).alias("model"), F.array(said(prompt), said(payload)).alias("messages")))


# JSN-04 -- [request, response] or [request, response, metadata]
def pack_result(request, response, metadata=None) -> Column:
    if metadata is None:
        return F.to_json(F.array(_c(request), _c(response)))
    md = _c(metadata)
    return F.when(md.isNull(), F.to_json(F.array(_c(request), _c(response)))).otherwise(
        F.to_json(F.array(_c(request), _c(response), md))
    )
