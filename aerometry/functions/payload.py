"""Pipe-delimited feed payloads: header line, value line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerometry.schemas import DEVICE, READING_VALUES

FIELD_SEPARATOR = "|"

# Number texts a reading may hold. Casting alone would also take surrounding
# blanks and Java's type suffixes; "$" alone would pass over a carriage return.
_INTEGER = r"^[+-]?[0-9]+\z"
_DOUBLE = (
    r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    r"|[+-]?([iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY])|[nN][aA][nN])\z"
)


def strict_bigint(text: Column) -> Column:
    """The integer a text spells, NULL for anything else."""
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def strict_double(text: Column) -> Column:
    """The double a text spells, NULL for anything else."""
    return F.when(text.rlike(_DOUBLE), text.try_cast("double"))


def first_field(line: Column) -> Column:
    """Text before the first separator; NULL where there is no separator."""
    return F.when(
        line.contains(FIELD_SEPARATOR), F.substring_index(line, FIELD_SEPARATOR, 1)
    )


def split_payload(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Add ``_fields``: header names and value texts, last one first, and the first text.

    The shorter line decides how many fields there are. Without a value line all
    parts are NULL; without a separator in it there is no first text. Lines are
    split in a column of their own, so that each is split once.
    """
    names, texts = F.col("_names"), F.col("_texts")
    width = F.when(texts.isNotNull(), F.least(F.size(names), F.size(texts)))
    fields = F.struct(
        F.reverse(F.slice(names, F.lit(1), width)).alias("names"),
        F.reverse(F.slice(texts, F.lit(1), width)).alias("texts"),
        F.when(F.size(texts) > 1, F.get(texts, F.lit(0))).alias("first"),
    )
    return (
        payloads.withColumn("_lines", F.split(F.col(body), "\n"))
        .withColumns(
            {
                "_names": F.split(F.get("_lines", F.lit(0)), r"\|"),
                "_texts": F.split(F.get("_lines", F.lit(1)), r"\|"),
            }
        )
        .withColumn("_fields", fields)
        .drop("_lines", "_names", "_texts")
    )


def field_text(fields: Column, name: Column | str) -> Column:
    """The text under a header name, NULL if absent; of a repeated name the last one."""
    return F.get(
        fields["texts"],
        (F.array_position(fields["names"], F.lit(name)) - 1).cast("int"),
    )


def field_map(fields: Column) -> Column:
    """All fields as a map; each name once, so no duplicate-key policy is needed."""
    names = F.array_distinct(fields["names"])
    return F.map_from_arrays(names, F.transform(names, lambda name: field_text(fields, name)))


def parse_payloads(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Split each payload into typed reading columns, plus the reason if it is unfit.

    Adds ``reading_key`` (first value text, which tells readings of a device
    apart), ``time``, the six numbers, and ``reject_reason`` (NULL when usable).
    Input columns stay; the payload's own deviceId or city is not looked at.
    """
    names = ("time", *READING_VALUES)
    found = {name: field_text(F.col("_fields"), name) for name in names}
    texts = split_payload(payloads, body).withColumn(
        "_texts", F.struct(*[text.alias(name) for name, text in found.items()])
    )
    text = F.col("_texts")
    typed = {"reading_key": F.col("_fields.first"), "time": strict_bigint(text["time"])}
    typed.update({name: strict_double(text[name]) for name in READING_VALUES})
    # The one-row generator makes columns of the typed values. Without it a
    # filter on the result would parse again for each column it looks at.
    parsed = texts.select(
        "*", F.inline(F.array(F.struct(*[value.alias(name) for name, value in typed.items()])))
    )
    no_key = F.when(F.col("_fields.texts").isNull(), F.lit("no value line")).otherwise(
        F.lit("no separator in value line")
    )
    reasons = [F.when(F.col("reading_key").isNull(), no_key)]
    for name in names:
        unfit = F.when(text[name].isNull(), F.lit(f"missing {name}"))
        reasons.append(F.when(F.col(name).isNull(), unfit.otherwise(F.lit(f"bad {name}"))))
    return parsed.withColumn("reject_reason", F.coalesce(*reasons)).drop("_fields", "_texts")


def accepted(parsed: DataFrame) -> DataFrame:
    """Usable readings."""
    return parsed.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(parsed: DataFrame, body: str = "body") -> DataFrame:
    """Unusable payloads with the reason, for the quarantine table."""
    return parsed.where(F.col("reject_reason").isNotNull()).select(
        DEVICE, body, "reject_reason"
    )
