"""Personal data in texts: regular expressions propose, checksums confirm, words around adjust."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_SPAN = "array<struct<start:int,end:int,value:string>>"
_AROUND = 40


@dataclass(frozen=True)
class Kind:
    """``prior`` is the score of a match, out of 100; ``words`` nearby before it add ``_CONTEXT``, a
    passed checksum adds ``_CHECKSUM``. ``needs`` is a character without which there is no match."""

    name: str
    pattern: str
    prior: int
    words: str
    needs: str | None = None


_CHECKSUM, _CONTEXT, _ASKED = 40, 30, 60

# The patterns of the base kinds are those of their definition, with lookbehind and possessive
# quantifiers that keep what is found and spare the backtracking: a match can only start where a
# run of its characters starts, or where the last match ended (\G).
BASE = [
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        60,
        "mail|contact|kontakt|correo|courriel",
        "@",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 60, "ip|host|server|address|login", "."),
    # A run of 16 to 19 digits; longer and shorter runs don't match, nor do parts of them.
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
        20,
        "card|visa|credit|payment|karte|tarjeta|carte",
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 60, "phone|tel|call|mobile|fax|movil", "+"),
]
MORE = [
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        20,
        "iban|account|konto|cuenta|compte|bank",
    ),
    # 13 to 15 digits are often something else, so only the words around make them a card.
    Kind(
        "short_card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,14}+(?![\x20-]?[0-9])",
        -10,
        "card|amex|diners|credit|payment|karte|tarjeta|carte",
    ),
]


def _luhn(value: Column) -> Column:
    """Every second digit from the right counts double, less 9 if above 9; the sum ends in 0."""
    digits = F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), "")

    def worth(digit: Column, i: Column) -> Column:
        number = digit.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(number > 9, number - 9).otherwise(number)

    return F.aggregate(F.transform(digits, worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def _mod_97(value: Column) -> Column:
    """The first four characters go to the end, letters are 10 to 35; the number leaves 1."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(letter >= 10, (rest * 100 + letter) % 97).otherwise((rest * 10 + F.ascii(c) - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _n_digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.split(F.regexp_replace(value, r"(?<![0-9])0+(?=[0-9])", ""), r"\.")
        return F.forall(parts, lambda p: (F.length(p) < 3) | (F.length(p) == 3) & (p <= "255"))
    if kind in ("card", "short_card"):
        return _luhn(value)
    if kind == "phone":
        return _n_digits(value).between(8, 15)
    if kind == "iban":
        return _mod_97(value)
    return F.lit(True)


def _placed(between: str, found: str) -> Column:
    """Matches with their places: what lies between them and the matches themselves add up."""
    pairs = F.zip_with(
        found,
        F.slice(between, F.lit(1), F.size(found)),
        lambda f, b: F.struct(F.length(b).alias("gap"), f.alias("value")),
    )
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + x["gap"]
        end = start + F.length(x["value"])
        span = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    return F.aggregate(pairs, empty, step, lambda done: done["spans"])


def _score(kind: Kind, text: Column, span: Column) -> Column:
    first = F.greatest(span["start"] - _AROUND, F.lit(0))
    before = F.lower(F.substring(text, first + 1, span["start"] - first))
    checked = _CHECKSUM if kind.name in ("card", "short_card", "iban") else 0
    return F.lit(kind.prior + checked) + F.when(before.rlike(rf"\b(?:{kind.words})"), _CONTEXT).otherwise(0)


def find_pii(docs: DataFrame) -> DataFrame:
    """``docs`` (text and others) with ``pii``: an array of (kind, start, end, score), by kind as in
    ``BASE`` and ``MORE``, then by start. Places are code points, ``end`` is exclusive.

    Matches of a kind are leftmost and don't overlap; those that fail their check (at most 255 a
    part, Luhn, 8 to 15 digits, mod 97) are dropped. Matches of ``BASE`` stay whatever their score; those of
    ``MORE`` need ``_ASKED``. NULL and empty texts have none. Rows are independent. A column ``pii`` of
    ``docs`` is replaced.
    """
    kept = [c for c in docs.columns if c != "pii"]
    kinds = BASE + MORE
    docs = docs.select(*kept, F.coalesce("text", F.lit("")).alias("_text"))
    found = {}
    for kind in kinds:
        all_found = F.regexp_extract_all("_text", F.lit(kind.pattern), F.lit(0))
        if kind.needs:
            all_found = F.when(F.contains(F.col("_text"), F.lit(kind.needs)), all_found)
        found[f"_found_{kind.name}"] = all_found
    docs = docs.withColumns(found)
    docs = docs.withColumns(
        {
            f"_between_{k.name}": F.when(F.size(f"_found_{k.name}") > 0, F.split("_text", k.pattern, -1))
            for k in kinds
        }
    )
    docs = docs.withColumns({f"_{k.name}": _placed(f"_between_{k.name}", f"_found_{k.name}") for k in kinds})

    def of(kind: Kind) -> Column:
        valid = F.filter(f"_{kind.name}", lambda s: _valid(kind.name, s["value"]))
        scored = F.transform(
            valid,
            lambda s: F.struct(
                F.lit(kind.name).alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                _score(kind, F.col("_text"), s).alias("score"),
            ),
        )
        asked = scored if kind in BASE else F.filter(scored, lambda s: s["score"] >= _ASKED)
        return F.coalesce(asked, F.array().cast("array<struct<kind:string,start:int,end:int,score:int>>"))

    return docs.withColumn("pii", F.concat(*[of(k) for k in kinds])).select(*kept, "pii")


def spelt(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def is_base(span: Column) -> Column:
    return span["kind"].isin(*[k.name for k in BASE])


def without_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of personal data in ``text`` replaced by its kind in brackets. Where
    spans overlap the first one's kind stands for all. NULL texts stay NULL."""
    found = find_pii(docs)
    text = F.coalesce("text", F.lit(""))
    ordered = F.array_sort(
        F.transform("pii", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        further = F.concat(done["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(s["start"] >= done["at"], further).otherwise(done["out"]).alias("out"),
        )

    def close(done: Column) -> Column:
        return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))

    redacted = F.aggregate(ordered, begin, step, close)
    clean = F.when(F.size("pii") > 0, redacted).otherwise(F.col("text"))
    return found.select(*[clean.alias(c) if c == "text" else F.col(c) for c in docs.columns])
