"""Literal inputs and small helpers."""

import contextlib
import io

from dossier.schemas import ACCOUNT_RAW, ADDRESS_RAW, CUSTOMER


def customers(spark, *rows):
    return spark.createDataFrame([r if isinstance(r, tuple) else (r, "f", "s") for r in rows], CUSTOMER)


def accounts(spark, *rows):
    return spark.createDataFrame(list(rows), ACCOUNT_RAW)


def addresses(spark, *rows):
    return spark.createDataFrame(list(rows), ADDRESS_RAW)


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def plain(value):
    """Rows as tuples, at any depth."""
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value
