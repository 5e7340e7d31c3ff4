"""Joins on keys of which a few hold a large part of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Heavy:
    """What counts as heavy, and what may be broadcast.

    A key is heavy from one in ``share`` rows on; the summary tracks ``tracked`` values in
    each task, however many there are. Heavy keys' rows of the other side are broadcast up
    to ``broadcast_bytes``, else spread over ``salts`` tasks a key.
    """

    share: int = 200
    tracked: int = 10_000
    broadcast_bytes: int = 10 * 1024 * 1024
    salts: int = 32


def heavy_keys(df: DataFrame, key: str, h: Heavy = Heavy()) -> list[object]:
    """Values of ``key`` with about one in ``share`` rows or more, most frequent first.

    A frequent-items sketch of bounded size per task, merged on the way: the answer has at
    most ``share`` values, and misses none whose share is above the sketch's error (a few
    in ``tracked``). One pass over the key column; null is never heavy (it joins nothing).
    """
    top = F.expr(f"approx_top_k(`{key}`, {h.share}, {h.tracked})")
    found = df.where(F.col(f"`{key}`").isNotNull()).agg(F.count("*").alias("rows"), top.alias("top")).first()
    return [item["item"] for item in found["top"] or [] if item["count"] * h.share >= found["rows"]]


def estimated_bytes(df: DataFrame) -> Column:
    """Bytes of all rows, as an aggregate: lengths of texts, eight for any other value."""
    sizes = []
    for f in df.schema:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(column), F.lit(0)).cast("long") + 16)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(column.alias("v")))), F.lit(0)).cast("long") + 16)
        else:
            sizes.append(F.lit(8).cast("long"))
    return F.coalesce(F.sum(sum(sizes[1:], sizes[0])), F.lit(0))


def broadcast_if_small(df: DataFrame, limit: int) -> DataFrame:
    """``df`` with a broadcast hint if its rows, which are measured, take at most ``limit`` bytes."""
    size = df.agg(estimated_bytes(df)).first()[0]
    return F.broadcast(df) if size <= limit else df


def join_heavy(left: DataFrame, right: DataFrame, on: str, how: str = "left", h: Heavy = Heavy()) -> DataFrame:
    """``left`` joined with ``right`` on column ``on``, the heavy keys of ``left`` apart.

    ``how`` is ``left`` or ``inner``; the result is that of the plain join. Rows of the
    heavy keys do not meet by key: they stay where they are next to a broadcast of the
    matching rows if these are measured to be small; otherwise every row goes to one of
    ``salts`` parts of its key, and the matching rows to all of them. The other keys are
    joined as usual. Each side is read once to measure and once for each of the two joins.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    keys = heavy_keys(left, on, h)
    if not keys:
        return left.join(right, on, how)
    heavy = F.coalesce(F.col(f"`{on}`").isin(keys), F.lit(False))
    few, rest = right.where(heavy), right.where(~heavy)
    hot = left.where(heavy)
    size = few.agg(estimated_bytes(few)).first()[0]
    if size <= h.broadcast_bytes:
        apart = hot.join(F.broadcast(few), on, how)
    else:
        salt = "__salt"
        # Of the row and its place, so that masses of equal rows are spread too.
        row = F.xxhash64(*(F.col(f"`{c}`") for c, kind in hot.dtypes if not kind.startswith(("map", "variant"))), F.monotonically_increasing_id())
        salted = hot.withColumn(salt, F.pmod(row, F.lit(h.salts)).cast("int"))
        copies = few.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(h.salts - 1))))
        apart = salted.join(copies, [on, salt], how).drop(salt)
    return apart.unionByName(left.where(~heavy).join(rest, on, how))
