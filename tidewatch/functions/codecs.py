"""Decoding and encoding of the record values carried by topics.

Each decoder maps an envelope DataFrame (batch or stream) to the envelope plus the decoded
columns plus ``bad_reason``, which is NULL for a good record. No shuffle, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions import text_forms as tf

# Field names of an order record, in wire order, and the types of its numbers.
ORDER_FIELDS = ["orderId", "product", "quantity", "price"]
ORDER_NUMBERS = {"orderId": "int", "quantity": "int", "price": "double"}

BAD_REASON = "bad_reason"


def _last(fields: str, name: str) -> Column:
    """The last value under a name; NULL if there is none."""
    place = F.array_position(F.reverse(F.map_keys(fields)), name)
    return F.when(place > 0, F.get(F.map_values(fields), (F.size(fields) - place).cast("int")))


def _whole(value: Column, kind: Column, text: Column) -> Column:
    """A JSON number, cut off at the point, or a text that is a whole number; NULL if it is neither."""
    spelt = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))
    return F.when(kind == "STRING", spelt).otherwise(F.try_variant_get(value, "$", "double").try_cast("int"))


def _fraction(value: Column, kind: Column, text: Column) -> Column:
    """A JSON number or a text that is a number; NULL if it is neither."""
    return F.when(kind == "STRING", text.try_cast("double")).otherwise(F.try_variant_get(value, "$", "double"))


def decode_orders(df: DataFrame, strict: bool = True) -> DataFrame:
    """JSON value to ``orderId, product, quantity, price``.

    The JSON text is parsed once, into a map of variants, which keeps the names and the types of the
    values: with ``strict`` a name outside the schema makes the record bad. Of a repeated name the last
    value counts. Fractions in whole-number fields are cut off; texts that are numbers are accepted,
    but a whole number must be spelt as one. Missing, NULL and blank numbers are 0. A number or truth
    value as product is taken as text, an object or array makes the record bad.
    """
    parsed = df.withColumn("_fields", F.from_json("value", "map<string,variant>"))
    values = {name: _last("_fields", name) for name in ORDER_FIELDS}
    parsed = parsed.withColumns({f"_{name}": value for name, value in values.items()})
    parsed = parsed.withColumns({f"_{name}_kind": F.schema_of_variant(f"_{name}") for name in ORDER_FIELDS})
    numbers, unusable = {}, F.lit(False)
    for name, kind in ORDER_NUMBERS.items():
        value, found = F.col(f"_{name}"), F.col(f"_{name}_kind")
        text = F.trim(F.try_variant_get(value, "$", "string"))
        blank = found.isNull() | (found == "VOID") | ((found == "STRING") & (text == ""))
        number = (_whole if kind == "int" else _fraction)(value, found, text)
        number = F.when(found != "BOOLEAN", number)
        unusable = unusable | (~blank & number.isNull())
        numbers[name] = F.when(blank, F.lit(0).cast(kind)).otherwise(number)
    nested = F.col("_product_kind").rlike("^(OBJECT|ARRAY)")
    reason = F.when(F.col("_fields").isNull(), "not a JSON object")
    if strict:
        unknown = F.exists(F.map_keys("_fields"), lambda name: ~name.isin(ORDER_FIELDS))
        reason = reason.when(unknown, "unknown property")
    reason = reason.when(unusable, "bad number").when(nested, "bad product")
    product = F.when(~nested, F.try_variant_get(F.col("_product"), "$", "string"))
    decoded = {"product": product, **numbers}
    return parsed.select(
        *df.columns,
        *[decoded[name].alias(name) for name in ORDER_FIELDS],
        reason.alias(BAD_REASON),
    )


def encode_order(order_id: Column, product: Column, quantity: Column, price: Column) -> Column:
    values = dict(zip(ORDER_FIELDS, [order_id, product, quantity, price]))
    return F.to_json(F.struct(*[col.alias(name) for name, col in values.items()]))


def _csv_fields(value: Column) -> Column:
    """Unquoted fields; trailing empty fields do not count as present."""
    return F.split(F.rtrim(F.replace(value, F.lit('"'), F.lit("")), F.lit(",")), ",")


def decode_alerts(df: DataFrame) -> DataFrame:
    """Quoted CSV to ``alert_ts, level, code, mesg``; text after a comma in ``mesg`` is lost."""
    parts = _csv_fields(F.col("value"))
    fields = df.select(
        *df.columns,
        tf.parse_timestamp(F.get(parts, F.lit(0))).alias("alert_ts"),
        F.get(parts, F.lit(1)).alias("level"),
        F.get(parts, F.lit(2)).alias("code"),
        F.get(parts, F.lit(3)).alias("mesg"),
    )
    reason = (
        F.when(F.col("value").isNull(), "no value")
        .when(F.col("mesg").isNull(), "fewer than 4 fields")
        .when(F.col("alert_ts").isNull(), "bad timestamp")
    )
    return fields.withColumn(BAD_REASON, reason)


def decode_views(df: DataFrame) -> DataFrame:
    """Quoted CSV to ``view_ts, user, view_topic, minutes``."""
    parts = _csv_fields(F.col("value"))
    last = F.get(parts, F.lit(3))
    fields = df.select(
        *df.columns,
        tf.parse_timestamp(F.get(parts, F.lit(0))).alias("view_ts"),
        F.get(parts, F.lit(1)).alias("user"),
        F.get(parts, F.lit(2)).alias("view_topic"),
        tf.parse_int(last).alias("minutes"),
        last.isNull().alias("_short"),
    )
    reason = (
        F.when(F.col("value").isNull(), "no value")
        .when(F.col("_short"), "fewer than 4 fields")
        .when(F.col("view_ts").isNull(), "bad timestamp")
        .when(F.col("minutes").isNull(), "bad integer")
    )
    return fields.withColumn(BAD_REASON, reason).drop("_short")


def decode_scores(df: DataFrame) -> DataFrame:
    """Number text to ``score``; the member is the record key."""
    fields = df.withColumn("score", tf.parse_score(F.col("value")))
    return fields.withColumn(BAD_REASON, F.when(F.col("score").isNull(), "bad number"))


def encode_alert(ts: Column, level: Column, code: Column, mesg: Column) -> Column:
    """All four fields, quoted."""
    return F.concat_ws(",", *[tf.quoted(c) for c in (tf.timestamp_text(ts), level, code, mesg)])


def encode_critical(ts: Column, code: Column, mesg: Column) -> Column:
    """Three quoted fields; the level is implied by the topic."""
    return F.concat_ws(",", *[tf.quoted(c) for c in (tf.timestamp_text(ts), code, mesg)])


def encode_view(ts: Column, user: Column, topic: Column, minutes: Column) -> Column:
    """Three quoted fields and the bare minutes."""
    texts = [tf.quoted(c) for c in (tf.timestamp_text(ts), user, topic)]
    return F.concat_ws(",", *texts, minutes.cast("string"))


def encode_window_count(window: Column, key: Column, count: Column) -> tuple[Column, Column]:
    """Keyed record of a windowed count: ``[key@start/end]`` and ``"start","key","count"``."""
    texts = [tf.quoted(c) for c in (tf.iso_instant(window["start"]), key, count.cast("string"))]
    return tf.windowed_key(key, window), F.concat_ws(",", *texts)
