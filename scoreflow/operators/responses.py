"""Normalising a response log.

Input: one row per API call with ``status``, ``status_code``, the JSON
``body`` and ``data_dt`` (``YYYYMMDD``). Output: the header fields as typed
columns, the status class recomputed from the code, and the business date
as ``YYYY-MM-DD``. Built-in ``from_json`` with a fixed schema: an empty or
malformed body gives NULL header fields, never an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.functions.dates import yyyymmdd_to_iso
from scoreflow.functions.envelope import decode_response, response_status


def normalise_responses(df: DataFrame, body_col: str = "body", code_col: str = "status_code", date_col: str = "data_dt") -> DataFrame:
    decoded = decode_response(F.col(body_col))
    keep = [c for c in df.columns if c not in (body_col, date_col)]
    return df.select(
        *keep,
        response_status(F.col(code_col)).alias("status_class"),
        decoded["Header"]["ResponseCode"].alias("response_code"),
        decoded["Header"]["ResponseMessage"].alias("response_message"),
        decoded["Header"]["Language"].alias("language"),
        yyyymmdd_to_iso(F.col(date_col)).alias("data_date"),
    )
