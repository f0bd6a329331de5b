"""The SQL entry (S4, C2): user statements over the store's tables and views.

``open_sql`` registers the five tables, the four reporting views and the date
functions that statements for the store's original database use:

* ``strftime(format, date)`` with %Y %m %d %j %H %M %S %%, as a SQL function
  that the optimizer inlines (no Python);
* ``julianday(date)``: days since noon of -4713-11-24.

Statements go to ``spark.sql`` as they are, with one exception: the type name
REAL, which means an eight-byte number there and a four-byte one here, is read
as DOUBLE outside of quotes.  ``/`` never cuts to an integer; where a statement
counts on that, write ``div``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from shelfmark.operators import sqlcorpus
from shelfmark.sources import files

# Format letters and the patterns that stand for them here.
_LETTERS = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%j": "DDD", "%H": "HH", "%M": "mm", "%S": "ss"}

_QUOTED_OR_REAL = re.compile(r"""'(?:[^']|'')*'|"(?:[^"]|"")*"|`[^`]*`|--[^\n]*|\bREAL\b""", re.IGNORECASE)


def _function_texts() -> list[str]:
    # Each letter's own date_format keeps the text between the letters literal.
    body = "replace(fmt, '%%', '\\u0001')"
    for letter, pattern in _LETTERS.items():
        body = f"replace({body}, '{letter}', date_format(t, '{pattern}'))"
    return [
        f"CREATE OR REPLACE TEMPORARY FUNCTION strftime(fmt STRING, t TIMESTAMP) RETURNS STRING RETURN replace({body}, '\\u0001', '%')",
        "CREATE OR REPLACE TEMPORARY FUNCTION julianday(t TIMESTAMP) RETURNS DOUBLE RETURN unix_micros(t) / 86400000000 + 2440587.5D",
    ]


def open_sql(spark: SparkSession, model) -> None:
    """Register tables, views and functions of one model in the session."""
    views = sqlcorpus.store_schema(model.clean_transactions, model.products, model.inventory)
    files.register_views(spark, views)
    model.stores.withColumnRenamed("store_name", "name").createOrReplaceTempView("stores")
    model.promotions.withColumnRenamed("promo_type", "campaign_type").createOrReplaceTempView("promotions")
    for text in _function_texts():
        spark.sql(text)


def statement(text: str) -> str:
    """The statement as it is handed to Spark."""
    return _QUOTED_OR_REAL.sub(lambda m: "DOUBLE" if m.group(0).upper() == "REAL" else m.group(0), text.strip().rstrip(";"))


def sql(spark: SparkSession, model, text: str) -> DataFrame:
    """One user statement over the model."""
    open_sql(spark, model)
    return spark.sql(statement(text))
