"""Labelling text records with a pluggable scorer."""

from __future__ import annotations

import urllib.request
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, functions as F

# The labels from worst to best, and the label of a failed call.
LABELS = ["Very Negative", "Negative", "Neutral", "Positive", "Very Positive"]
ERROR = "Error"


def score_stream(df: DataFrame, scorer: Callable[[Column], Column]) -> DataFrame:
    """Label every record and keep its key; batch or stream, no shuffle.

    ``scorer`` maps the text column to a label column: built-in expressions or a pandas UDF.
    """
    return df.select("key", scorer(F.col("value")).alias("label"))


def last_sentence(text: Column) -> Column:
    """The last non-blank piece between runs of ``. ! ?``, NULL if there is none."""
    pieces = F.split(text, "[.!?]+")
    return F.try_element_at(F.filter(pieces, lambda p: p.rlike(r"\S")), F.lit(-1))


def lexicon_scorer(lexicon: dict[str, int]) -> Callable[[Column], Column]:
    """Scorer that adds up word weights (lower-case a-z words) in the last sentence.

    The sum -2, -1, 0, 1, 2 (clamped) picks the label. Text without a sentence is neutral and a
    NULL text is an error. The words of a sentence are looked up in one map, whatever the number
    of words in the lexicon.
    """
    for word in lexicon:
        if not (word.isascii() and word.isalpha() and word.islower()):
            raise ValueError(f"not a lower-case a-z word: {word!r}")

    def scorer(text: Column) -> Column:
        sentence = F.lower(last_sentence(text))
        weights = F.create_map(*[F.lit(x) for pair in lexicon.items() for x in pair])
        words = F.regexp_extract_all(sentence, F.lit("[a-z]+"), F.lit(0))
        total = F.aggregate(
            words, F.lit(0), lambda a, w: a + F.coalesce(F.try_element_at(weights, w), F.lit(0))
        )
        clamped = F.greatest(F.lit(-2), F.least(F.lit(2), F.coalesce(total, F.lit(0))))
        labels = F.array(*[F.lit(label) for label in LABELS])
        return F.when(text.isNull(), ERROR).otherwise(F.element_at(labels, clamped + F.lit(3)))

    return scorer


def score_with_model(df: DataFrame, model: Transformer, label: str = "prediction") -> DataFrame:
    """Label records with a fitted MLlib model that reads the column ``value``."""
    return model.transform(df).select("key", F.col(label).cast("string").alias("label"))


def http_client(
    url: str, timeout_seconds: float = 10.0
) -> Callable[[], Callable[[Sequence[str]], list[str]]]:
    """``connect`` for a service that takes one text per POST and answers with the label."""

    def connect() -> Callable[[Sequence[str]], list[str]]:
        opener = urllib.request.build_opener()

        def ask(text: str) -> str:
            try:
                request = urllib.request.Request(url, data=text.encode("utf-8"), method="POST")
                with opener.open(request, timeout=timeout_seconds) as response:
                    return response.read().decode("utf-8")
            except Exception:
                return ERROR

        return lambda texts: [ask(text) for text in texts]

    return connect


def remote_score(
    df: DataFrame,
    connect: Callable[[], Callable[[Sequence[str]], Sequence[str]]],
    batch_size: int = 256,
    calls_at_once: int = 4,
) -> DataFrame:
    """Label records through a service: one client per task, ``batch_size`` texts per call and up
    to ``calls_at_once`` calls at a time, so the client must allow that. Rows keep their order.

    ``connect`` runs on the executor and returns a function from texts to labels. When a call
    for a batch fails its texts are tried one by one, and those that fail alone, like missing
    texts, are labelled ``Error``; so are all texts of a task that cannot connect.
    """

    def call(client, texts: list[str]) -> list[str]:
        try:
            labels = list(client(texts))
            if len(labels) != len(texts):
                raise ValueError("one label per text is expected")
            return labels
        except Exception:
            if len(texts) == 1:
                return [ERROR]
            return [call(client, [text])[0] for text in texts]

    def label(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            client = connect()
        except Exception:
            client = None
        with ThreadPoolExecutor(calls_at_once) as pool:
            for frame in frames:
                present = frame["value"].dropna()
                batches = [present.iloc[i : i + batch_size].tolist() for i in range(0, len(present), batch_size)]
                if client is None:
                    done = [[ERROR] * len(batch) for batch in batches]
                else:
                    done = pool.map(lambda batch: call(client, batch), batches)
                labels = [label for batch in done for label in batch]
                scored = pd.Series(labels, index=present.index, dtype=object)
                yield pd.DataFrame({"key": frame["key"], "label": scored.reindex(frame.index, fill_value=ERROR)})

    return df.select("key", "value").mapInPandas(label, "key string, label string")
