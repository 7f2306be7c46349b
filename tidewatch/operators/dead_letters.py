"""What happens to records that cannot be decoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.functions.codecs import BAD_REASON


DECODING = "decoding"


def observe_decoding(decoded: DataFrame, name: str = DECODING) -> DataFrame:
    """Count records and bad records on the way, without an extra pass.

    The counts are in the progress of a streaming query and in ``Observation`` for a batch;
    ``streaming.counters`` adds them up under the name of the query. The
    observation is also where the plan stops pushing filters down: the decoding above the source
    is evaluated once per record, not once more for each condition on a decoded column.
    """
    bad = F.count(F.when(F.col(BAD_REASON).isNotNull(), 1))
    return decoded.observe(name, F.count(F.lit(1)).alias("records"), bad.alias("bad"))


def split_good_bad(decoded: DataFrame, name: str = DECODING) -> tuple[DataFrame, DataFrame]:
    """Good records without the reason, and bad ones as raw key, value and reason.

    Both are counted under ``name``. The bad side keeps the envelope only, so that column
    pruning drops the decoded fields.
    """
    observed = observe_decoding(decoded, name)
    good = observed.filter(F.col(BAD_REASON).isNull()).drop(BAD_REASON)
    bad = observed.filter(F.col(BAD_REASON).isNotNull()).select(
        "key", "value", F.col(BAD_REASON).alias("reason")
    )
    return good, bad


def good_records(
    decoded: DataFrame, on_error: str = "dead_letter", name: str = DECODING
) -> DataFrame:
    """Good records; with ``on_error="fail"`` the first bad one stops the query instead."""
    if on_error == "dead_letter":
        return split_good_bad(decoded, name)[0]
    if on_error != "fail":
        raise ValueError("on_error is 'dead_letter' or 'fail'")
    complaint = F.concat(
        F.lit("undecodable record: "), BAD_REASON, F.lit(": "), F.coalesce("value", F.lit("null"))
    )
    checked = F.when(F.col(BAD_REASON).isNull(), True).otherwise(
        F.raise_error(complaint).cast("boolean")
    )
    return observe_decoding(decoded, name).filter(checked).drop(BAD_REASON)
