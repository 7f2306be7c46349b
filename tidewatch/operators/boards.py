"""Boards: a running total per member, and its ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.operators.numbering import number_rows


# A slice that reaches at most so far from an end of a board is selected without sorting all.
_SELECTED = 100_000


def running_totals(df: DataFrame, member: str, score: str) -> DataFrame:
    """All-time sum per member, on a batch or (``update`` or ``complete`` mode) a stream.

    State grows with the number of members and is never expired.
    """
    named = df.select(F.col(member).alias("member"), F.col(score).cast("double").alias("score"))
    return named.filter(F.col("member").isNotNull()).groupBy("member").agg(F.sum("score").alias("score"))


def running_counts(df: DataFrame, member: str) -> DataFrame:
    """All-time number of records per member, as a double."""
    named = df.select(F.col(member).alias("member")).filter(F.col("member").isNotNull())
    return named.groupBy("member").agg(F.count(F.lit(1)).cast("double").alias("score"))


def _ranking() -> list[Column]:
    """Highest score first; of equal scores the member that sorts last in bytes comes first."""
    return [F.col("score").desc(), F.col("member").desc()]


def _from_the_end() -> list[Column]:
    return [F.col("score").asc(), F.col("member").asc()]


def rank_desc(board: DataFrame, path: str | None = None) -> DataFrame:
    """``position`` 1..n for every member of a board table, by the spread-out numbering."""
    return number_rows(board, _ranking(), path=path).select("position", "member", "score")


def top_k(board: DataFrame, k: int) -> DataFrame:
    """The first ``k`` positions: each task keeps ``k`` rows, only those are merged."""
    first = board.orderBy(*_ranking()).limit(k)
    position = F.row_number().over(Window.orderBy(*_ranking()))
    return first.select(position.cast("bigint").alias("position"), "member", "score")


def bottom_k(board: DataFrame, k: int) -> DataFrame:
    """The last ``k`` positions, selected from the other end; the number of members is counted in
    the same job."""
    last = board.orderBy(*_from_the_end()).limit(k)
    from_end = F.row_number().over(Window.orderBy(*_from_the_end()))
    members = board.agg(F.count(F.lit(1))).scalar()
    ranked = last.select(from_end.alias("from_end"), "member", "score")
    return ranked.select((members - F.col("from_end") + 1).alias("position"), "member", "score")


def rank_slice(board: DataFrame, start: int, stop: int) -> DataFrame:
    """Positions by 0-based inclusive index; negative indices count from the end (-1 = last).

    A slice near one end keeps as many rows per task as reach from there, up to ``_SELECTED``.
    Others are cut from the numbering of the whole board.
    """
    if 0 <= start and 0 <= stop < _SELECTED:
        return top_k(board, stop + 1).filter(F.col("position") > start)
    if -_SELECTED <= start < 0:
        members = board.agg(F.count(F.lit(1))).scalar()
        last = F.lit(stop + 1) if stop >= 0 else members + stop + 1
        return bottom_k(board, -start).filter(F.col("position") <= last)
    ranked = rank_desc(board)
    if start < 0 or stop < 0:
        members = ranked.count()
        start = max(start + members, 0) if start < 0 else start
        stop = stop + members if stop < 0 else stop
    return ranked.filter(F.col("position").between(start + 1, stop + 1))
