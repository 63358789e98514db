"""The API response envelope.

An HTTP trigger answers with ``{"Header": {"ResponseCode", "ResponseMessage",
"Language"}}``; the job records ``status`` and ``status_code`` beside it. Here
the envelope is decoded in bulk from a response log with ``from_json`` and a
fixed schema; an empty or malformed body gives a NULL header, a missing
field a NULL value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADER_SCHEMA = T.StructType(
    [
        T.StructField("ResponseCode", T.IntegerType()),
        T.StructField("ResponseMessage", T.StringType()),
        T.StructField("Language", T.StringType()),
    ]
)
RESPONSE_SCHEMA = T.StructType([T.StructField("Header", HEADER_SCHEMA)])


def decode_response(body: Column) -> Column:
    """Parse a JSON body into ``struct<Header: struct<...>>``; blank → NULL."""
    cleaned = F.when(F.trim(body) != "", body)
    return F.from_json(cleaned, RESPONSE_SCHEMA, {"mode": "PERMISSIVE"})


def response_status(status_code: Column) -> Column:
    """Status class of an HTTP code: 2xx → ``success``, else ``error``."""
    return F.when(status_code.between(200, 299), F.lit("success")).otherwise(F.lit("error"))
