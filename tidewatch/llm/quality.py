"""Quality of documents: repetition counts, and the distance of histograms from those of a language."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.scratch import written

# Java matches a list of characters much faster than a range.
_SPACES = r"\x20\x09\x0A\x0B\x0C\x0D"

# Frequent words of the languages that are judged. A document in another language, or
# without one, is judged by the base rules only.
COMMON_WORDS = {
    "de": ["der", "die", "das", "und", "den", "von"],
    "en": ["the", "of", "and", "to", "in", "a"],
    "es": ["de", "la", "el", "que", "y", "en"],
    "fr": ["de", "la", "le", "les", "des", "et"],
}

# Classes of characters besides white space; all others are one more class.
SYMBOLS = "#*$%&|<>"
CHARACTER_CLASSES = {
    "upper": string.ascii_uppercase,
    "digit": string.digits,
    "point": ".,;:!?",
    "symbol": SYMBOLS,
}

RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULTS += ["base_failed", "class_distance", "word_distance", "kept"]

MIN_WORDS = 60
MIN_CHARS = 300


def _class_limit(chars: Column) -> Column:
    """Largest distance of classes that is accepted: chance moves short texts further away. It moves
    whole words, of about 6 characters, so the factor is above 2 for 6 classes: sqrt(6 * 5 / (8 ln 2))."""
    return 0.18 + 2 / F.sqrt(chars)


def _word_limit(words: Column) -> Column:
    """Chance alone moves ``words`` words 1.04 / sqrt(words) away: sqrt(6 / (8 ln 2)), with 6 as the
    histogram has 7 classes. A text without any of the common words is 0.249 to 0.257 away, so
    it is out from about ``MIN_WORDS`` words."""
    return 0.14 + 0.9 / F.sqrt(words)


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0).cast("bigint"), lambda a, b: a + b)


def _measured(docs: DataFrame) -> DataFrame:
    """Add the counts of the base rules and the two histograms, ``_classes`` and ``_common``, of
    each text: its character classes, and how often it has each common word of its language."""
    lists = F.create_map(*[F.lit(x) for lang, own in COMMON_WORDS.items() for x in (lang, own)])
    docs = docs.withColumn("_text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("_parts", F.split("_text", f"[{_SPACES}]"))
    docs = docs.withColumn("_words", F.array_remove("_parts", ""))
    lines = F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(f"[^{_SPACES}]"))
    docs = docs.withColumns({"_lines": lines, "_list": lists[F.col("lang")], "_n": F.size("_words")})
    counts = {
        name: F.length(F.regexp_replace("_text", f"[^{members}]+", "")).cast("bigint")
        for name, members in CHARACTER_CLASSES.items()
    }
    size = len(next(iter(COMMON_WORDS.values())))
    times = [
        (F.col("_n") - F.size(F.array_remove("_words", F.col("_list")[k]))).cast("bigint")
        for k in range(size)
    ]
    # Each space ends one part but the last.
    spaces = (F.size("_parts") - 1).cast("bigint")
    docs = docs.withColumns(
        {
            "n_words": F.col("_n").cast("bigint"),
            "word_chars": F.length("_text").cast("bigint") - spaces,
            "n_symbols": counts["symbol"],
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "_found": F.array(*counts.values(), spaces),
            "_times": F.array(*times),
        }
    )
    docs = docs.withColumns(
        {
            "_classes": F.concat("_found", F.array(F.length("_text").cast("bigint") - _total(F.col("_found")))),
            "_common": F.concat("_times", F.array(F.col("n_words") - _total(F.col("_times")))),
        }
    )
    return _with_repeated_words(docs.drop("_lines", "_list", "_parts", "_found", "_times"))


def _references(measured: DataFrame) -> DataFrame:
    """The summed histograms of all documents of each language of ``COMMON_WORDS``, so one row for
    each of these languages at most."""
    known = measured.where(F.col("lang").isin(*COMMON_WORDS))
    sizes = {"_classes": len(CHARACTER_CLASSES) + 2, "_common": len(next(iter(COMMON_WORDS.values()))) + 1}
    sums = [F.sum(F.col(c)[k]).alias(f"{c}{k}") for c, n in sizes.items() for k in range(n)]
    return known.groupBy(F.col("lang").alias("_ref_lang")).agg(*sums).select(
        "_ref_lang", *[F.array(*[f"{c}{k}" for k in range(n)]).alias(f"_ref{c}") for c, n in sizes.items()]
    )


def _distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms, NULL if one of them is empty."""

    def share(x: Column) -> Column:
        return F.transform(x, lambda k: k / F.nullif(_total(x), F.lit(0)))

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    terms = F.zip_with(share(counts), share(reference), lambda p, q: part(p, q) + part(q, p))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) / 2))


def _pairwise(hashes: str, n: Column, step: int) -> Column:
    """Hashes of items that stand ``step`` apart; with ``n`` items, ``n - step`` pairs."""
    left = F.greatest(n - step, F.lit(0))
    return F.zip_with(
        F.slice(hashes, F.lit(1), left), F.slice(hashes, F.lit(step + 1), left), lambda a, b: F.xxhash64(a, b)
    )


def _with_repeated_words(docs: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words in 8-word windows that the text has twice or more.

    Window hashes are built by doubling. Only if not all are distinct are they sorted with
    their positions; neighbours with one hash are repeated. The words covered are the sum of
    the gaps between such positions, at most 8 each.
    """
    n = F.col("_n")
    docs = docs.withColumn("_h1", F.transform("_words", lambda w: F.xxhash64(w)))
    docs = docs.withColumn("_h2", _pairwise("_h1", n, 1))
    docs = docs.withColumn("_h4", _pairwise("_h2", n - 1, 2))
    docs = docs.withColumn("_h8", _pairwise("_h4", n - 3, 4)).drop("_h1", "_h2", "_h4")
    repeats = F.size(F.array_distinct("_h8")) < F.size("_h8")
    places = F.transform("_h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    docs = docs.withColumn("_sorted", F.when(repeats, F.sort_array(places))).drop("_h8")
    rest = F.slice("_sorted", F.lit(2), F.greatest(F.size("_sorted"), F.lit(0)))
    same = F.zip_with("_sorted", rest, lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    docs = docs.withColumn("_next", same)
    flags = F.arrays_zip("_sorted", "_next", F.concat(F.array(F.lit(False)), F.col("_next")).alias("_last"))
    docs = docs.withColumn("_flags", flags).drop("_sorted", "_next")
    repeated = F.filter("_flags", lambda x: x["_next"] | x["_last"] & x["_sorted"].isNotNull())
    docs = docs.withColumn("_at", F.sort_array(F.transform(repeated, lambda x: x["_sorted"]["i"])))
    after = F.slice("_at", F.lit(2), F.greatest(F.size("_at"), F.lit(0)))
    gaps = F.zip_with("_at", after, lambda a, b: F.least(F.lit(8), F.coalesce(b - a, F.lit(8))))
    covered = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return docs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint"))).drop("_flags", "_at")


def judged(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (text, lang and others), or its columns ``keep``, with ``n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance, kept``.

    ``base_failed``: fewer than 20 words, or more than 30 % of them in repeated 8-word windows.
    ``kept``: not failed, and near enough to the language. The reference of a language is the sum
    of the histograms of all its documents. The Jensen-Shannon distances of the character classes
    (from ``MIN_CHARS`` characters) and of the common words (from ``MIN_WORDS`` words) must be within
    ``_class_limit`` and ``_word_limit``. A distance is NULL, and says nothing, for shorter texts, for
    languages not in ``COMMON_WORDS`` and for no language.

    NULL texts are empty, so they fail. Rows are judged one by one, repeated ones alike. Columns
    of ``docs`` with the names of results or of the form ``_name`` are replaced or must not be kept.
    Counts are written to the shared folder once, with the columns to keep, and references come
    from there; the references are broadcast, one row for each of the listed languages.
    """
    kept = [c for c in keep or docs.columns if c not in RESULTS]
    helpers = ["_lang", "_chars", "_classes", "_common"]
    measured = _measured(docs.withColumn("_lang", F.col("lang")).withColumn("_chars", F.length("text")))
    counted = written(measured.select(*kept, *RESULTS[:5], *helpers), "measured")
    references = F.broadcast(_references(counted.withColumn("lang", F.col("_lang"))))
    joined = counted.join(references, F.col("_lang") == F.col("_ref_lang"), "left")
    class_distance = _distance(F.col("_classes"), F.col("_ref_classes"))
    word_distance = _distance(F.col("_common"), F.col("_ref_common"))
    joined = joined.withColumns(
        {
            "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
            "class_distance": F.when(F.col("_chars") >= MIN_CHARS, class_distance),
            "word_distance": F.when(F.col("n_words") >= MIN_WORDS, word_distance),
        }
    )
    near = [
        F.coalesce(F.col("class_distance") <= _class_limit(F.col("_chars")), F.lit(True)),
        F.coalesce(F.col("word_distance") <= _word_limit(F.col("n_words")), F.lit(True)),
    ]
    return joined.withColumn("kept", reduce(lambda a, b: a & b, near, ~F.col("base_failed"))).select(*kept, *RESULTS)
