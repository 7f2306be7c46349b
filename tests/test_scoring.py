from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import records, rows_of
from tidewatch.operators import scoring
from tidewatch.plans.registered import TEST_LEXICON


def test_last_sentence(spark):
    texts = ["One. Two", "One. Two!? ", "...", "", "no end", "a.\n\n b c .. \t"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.trim(scoring.last_sentence(F.col("t")))).collect()]
    assert got[:2] == ["Two", "Two"] and got[2:5] == [None, None, "no end"]
    assert got[5].strip() == "b c"


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("of to a.", "Very Negative"),
        ("the of a", "Negative"),
        ("nothing here", "Neutral"),
        ("of of of. ", "Very Negative"),
        ("of of of. THE end", "Positive"),
        ("the is it the", "Very Positive"),
        ("the5the", "Very Positive"),
        ("thethe within there", "Neutral"),
        ("", "Neutral"),
        ("...", "Neutral"),
        (None, "Error"),
    ],
)
def test_lexicon_labels(spark, text, label):
    df = records(spark, [("k", text, 1.0)])
    scored = scoring.score_stream(df, scoring.lexicon_scorer(TEST_LEXICON))
    assert rows_of(scored) == [("k", label)]


def test_lexicon_is_checked():
    with pytest.raises(ValueError):
        scoring.lexicon_scorer({"Not a word": 1})


def test_a_failed_call_spoils_only_its_own_text(spark):
    def connect():
        def client(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("refused")
            return [t.upper() for t in texts]

        return client

    texts = ["a", "bad", None, "b", "c", "very bad"]
    df = records(spark, [(str(i), t, 1.0) for i, t in enumerate(texts)]).coalesce(1)
    got = rows_of(scoring.remote_score(df, connect, batch_size=3))
    assert [label for _, label in got] == ["A", "Error", "Error", "B", "C", "Error"]


def test_a_wrong_number_of_labels_is_an_error(spark):
    df = records(spark, [("0", "a", 1.0), ("1", "b", 1.0)]).coalesce(1)
    got = rows_of(scoring.remote_score(df, lambda: lambda texts: [], batch_size=2))
    assert got == [("0", "Error"), ("1", "Error")]


def test_pandas_udf_as_scorer(spark):
    @F.pandas_udf("string")
    def by_length(texts: pd.Series) -> pd.Series:
        return texts.str.len().astype(str)

    df = records(spark, [("k", "four", 1.0)])
    assert rows_of(scoring.score_stream(df, by_length)) == [("k", "4")]


def test_a_refused_connection_labels_error_and_order_is_kept(spark):
    def refused():
        raise ConnectionRefusedError("no service")

    texts = spark.createDataFrame([(str(i), f"t{i}" if i % 7 else None) for i in range(50)], "key string, value string")
    assert {r["label"] for r in scoring.remote_score(texts, refused).collect()} == {"Error"}

    def echo():
        return lambda batch: [text.upper() for text in batch]

    got = {r["key"]: r["label"] for r in scoring.remote_score(texts, echo, batch_size=3).collect()}
    assert got == {str(i): f"T{i}" if i % 7 else "Error" for i in range(50)}


def test_a_lexicon_may_be_large(spark):
    words = {"".join(chr(97 + i // 26**k % 26) for k in range(3)): 1 for i in range(3000)}
    texts = spark.createDataFrame([("a", "aaa, baa caa. zzz aaa-baa!"), ("b", "zzz")], "key string, value string")
    got = {r["key"]: r["label"] for r in scoring.score_stream(texts, scoring.lexicon_scorer(words)).collect()}
    assert got == {"a": "Very Positive", "b": "Neutral"}
