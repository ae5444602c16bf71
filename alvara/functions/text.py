"""Text: blanks, addresses, company ids, and the shortening of long descriptions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The boilerplate that official sector descriptions carry.
UNSPECIFIED_TAIL = r"(?iuU)\s*,?\s*n[ãa]o especificad[oa]s?\s+anteriormente"
EXCEPT_CLAUSE = r"(?iuU),\s*exceto\s+[^,]+?(?=,|\n?\z)"
ADDRESS_PARTS = ["tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep"]
CONTROL_CHARACTERS = "".join(chr(code) for code in range(0x80, 0xA0))


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(text: str | Column) -> Column:
    return F.nullif(_col(text), F.lit(""))


def address_line(parts: Sequence[str | Column] = ADDRESS_PARTS) -> Column:
    """The non-empty parts joined by one space; NULL when nothing is left."""
    joined = F.concat_ws(" ", *[blank_to_null(part) for part in parts])
    return blank_to_null(F.trim(joined))


def company_id(digits: str | Column) -> Column:
    """``12345678000190`` as ``12.345.678/0001-90``."""
    return F.regexp_replace(
        _col(digits), r"^(.{2})(.{3})(.{3})(.{4})(.*)$", "$1.$2.$3/$4-$5"
    )


def scrub_controls(text: str | Column) -> Column:
    """Characters U+0080 to U+009F become ``?``; the length stays the same."""
    replaced = F.translate(_col(text), CONTROL_CHARACTERS, "?" * len(CONTROL_CHARACTERS))
    return F.when(_plain(text), _col(text)).otherwise(replaced)


def count_controls(text: str | Column) -> Column:
    kept = F.translate(_col(text), CONTROL_CHARACTERS, "")
    return F.when(_plain(text), 0).otherwise(F.coalesce(F.length(_col(text)) - F.length(kept), F.lit(0)))


def _plain(text: str | Column) -> Column:
    """Is every character one byte? Then none is a control character, and none need be looked at."""
    return F.octet_length(_col(text)) == F.length(_col(text))


def capitalised(text: str | Column) -> Column:
    """First letter upper, the rest lower (unlike ``initcap``, one word only)."""
    text = _col(text)
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2))))


def description_key(text: str | Column) -> Column:
    """What two descriptions must share to count as the same trade."""
    first = F.element_at(F.split(_col(text), ","), 1)
    return F.lower(F.substring(first, 1, 22))


def shorten(text: str | Column, limit: int = 34) -> Column:
    """Cut at the last blank within ``limit`` characters and add an ellipsis."""
    text = _col(text)
    head = F.substring(text, 1, limit)
    last_word = F.substring_index(head, " ", -1)
    before = F.substring(head, F.lit(1), F.length(head) - F.length(last_word) - 1)
    kept = F.when(F.length(last_word) >= F.length(head) - 1, head).otherwise(before)
    return F.when(F.length(text) <= limit, text).otherwise(
        F.concat(F.regexp_replace(kept, r"[,;]+\z", ""), F.lit("…"))
    )


def label_variants(text: str | Column) -> list[Column]:
    """Three forms of a description, from the shortest to the whole."""
    whole = F.regexp_replace(_strip(_col(text)), r"[. ]+\z", "")
    specified = _tidy(F.regexp_replace(whole, UNSPECIFIED_TAIL, ""))
    short = _tidy(F.regexp_replace(specified, EXCEPT_CLAUSE, ""))
    return [short, specified, whole]


def clean_label(text: str | Column) -> Column:
    return label_variants(text)[0]


def _strip(text: Column) -> Column:
    # Unicode blanks too, and the four separators that are no white space to Java.
    return F.regexp_replace(text, r"(?U)\A[\s\x1C-\x1F]+|[\s\x1C-\x1F]+\z", "")


def _tidy(text: Column) -> Column:
    return F.regexp_replace(_strip(text), r"[,. ]+\z", "")


def distinct_labels(df: DataFrame, text: str, within: Sequence[str] = ()) -> DataFrame:
    """The shortest label per text that no other text of its group has.

    One row per distinct text and group. Every text starts at its shortest form;
    only the texts whose label collides move on to the next form. Collisions are
    found by counting (combined before the shuffle), never by gathering a group.
    """
    within = list(within)
    forms = label_variants(text)
    level = (
        df.select(*within, text).distinct()
        .withColumn("_forms", F.array(*forms))
        .withColumn("_level", F.lit(1))
        .withColumn("label", F.element_at("_forms", F.col("_level")))
    )
    keys = [*within, "label"]
    for _ in range(len(forms) - 1):
        crowded = (
            level.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
            .select(*[F.col(key).alias(f"_{key}") for key in keys], F.lit(1).alias("_up"))
        )
        # Null-safe keys imply no filter on one side only, so both sides read the
        # same shuffle of the distinct texts.
        same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
        level = (
            level.join(crowded, same, "left")
            .withColumn(
                "_level",
                F.least(F.lit(len(forms)), F.col("_level") + F.coalesce("_up", F.lit(0))),
            )
            .withColumn("label", F.element_at("_forms", F.col("_level")))
            .drop("_up", *[f"_{key}" for key in keys])
        )
    return level.select(*within, text, "label")
