"""One-line addresses as typed fields."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.functions.checks import check_mode, require

# The separator, the order of the parts, and what counts as a house number.
SEPARATOR = ", "
FIELDS = ["number", "road", "city", "country"]
WHOLE_NUMBER = r"\A[+-]?[0-9]+\z"


def _parts(text: Column) -> Column:
    """The parts of an address, without empty parts at its end.

    Parts after the fourth are ignored, so the rest is left in one piece.
    """
    trimmed = F.when(
        text.endswith(SEPARATOR), F.regexp_replace(text, f"({SEPARATOR})+$", "")
    ).otherwise(text)
    return F.split(trimmed, SEPARATOR, len(FIELDS) + 1)


def _fields(parts: Column) -> dict[str, Column]:
    fields = {name: F.get(parts, F.lit(i)) for i, name in enumerate(FIELDS)}
    number = fields["number"]
    fields["number"] = F.when(number.rlike(WHOLE_NUMBER), number).try_cast("int")
    return fields


def address_fields(col: str = "address") -> dict[str, Column]:
    """number, road, city and country as columns of an address; null where they cannot be read."""
    return _fields(_parts(F.col(col)))


def is_malformed() -> Column:
    """Whether a parsed row lacks its number or some other part; never null.

    Parts are read in order, so an address with a country has a road and a city.
    """
    return F.col("number").isNull() | F.col("country").isNull()


def parse_address(df: DataFrame, col: str = "address", mode: str = "strict") -> DataFrame:
    """``df`` with the columns number, road, city and country.

    Strict mode fails on any address without a whole first part or with fewer
    than four parts; lenient mode leaves null what cannot be read.
    """
    check_mode(mode)
    # A one-element explode: plain columns would be split again by every filter on them.
    split = df.withColumn("_parts", F.explode(F.array(_parts(F.col(col)))))
    parsed = split.withColumns(_fields(F.col("_parts"))).drop("_parts")
    if mode == "strict":
        text = F.coalesce(F.col(col), F.lit("(null)"))
        parsed = require(parsed, ~is_malformed(), F.concat(F.lit("malformed address: "), text))
    return parsed
