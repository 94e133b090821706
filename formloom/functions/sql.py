"""Scalar functions for SQL. They are SQL functions themselves: Catalyst puts their expressions in place of calls.

For columns of large tables prefer the stepwise forms in `text`: a long expression repeats what its branches share.
"""

from pyspark.sql import SparkSession

FUNCTIONS = {
    "form_time(s STRING) RETURNS STRING": r"""(SELECT CASE WHEN h <= 23 THEN lpad(cast(h AS string), 2, '0') || ':' || m END FROM (
        SELECT CASE WHEN a = 'am' AND h0 = 12 THEN 0 WHEN a = 'pm' AND h0 < 12 THEN h0 + 12 ELSE h0 END AS h, m FROM (
        SELECT try_cast(regexp_extract(t, r, 1) AS int) AS h0, regexp_extract(t, r, 2) AS m, regexp_extract(t, r, 3) AS a FROM (
        SELECT regexp_replace(translate(regexp_replace(lower(s), r'([ap])\.m\.?', '$1m'), ';,.-', '::::'), r'(?U)\s+', '') AS t, r'^([0-2]?\d):([0-5]\d)(am|pm)?$' AS r))))""",
    "form_date(s STRING) RETURNS STRING": r"""(SELECT CASE WHEN m BETWEEN 1 AND 12 AND d BETWEEN 1 AND 31 AND y BETWEEN 2000 AND 2100
        THEN lpad(cast(m AS string), 2, '0') || '/' || lpad(cast(d AS string), 2, '0') || '/' || cast(y AS string) END FROM (
        SELECT m, d, CASE WHEN y0 < 100 THEN y0 + 2000 ELSE y0 END AS y FROM (
        SELECT try_cast(regexp_extract(t, r, 1) AS int) AS m, try_cast(regexp_extract(t, r, 2) AS int) AS d, try_cast(regexp_extract(t, r, 3) AS int) AS y0 FROM (
        SELECT translate(regexp_replace(s, r'(?U)^\s+|\s+$', ''), '-.', '//') AS t, r'^(\d{1,2})/(\d{1,2})/(\d{2,4})$' AS r))))""",
    "form_amount_canon(s STRING) RETURNS STRING": r"""(SELECT CASE WHEN t IN ('', '.') THEN '' ELSE
        regexp_replace(CASE WHEN a = '' THEN '0' ELSE a END, r'^0+(?=\d)', '') || '.' || rpad(replace(substr(t, length(a) + 1), '.', ''), 2, '0') END FROM (
        SELECT t, substring_index(t, '.', 1) AS a FROM (SELECT regexp_replace(replace(s, ',', '.'), '[^0-9.]', '') AS t)))""",
    "form_minutes(s STRING) RETURNS INT": "cast(substring_index(s, ':', 1) AS int) * 60 + cast(substring_index(s, ':', -1) AS int)",
    "form_field_class(s STRING) RETURNS STRING": "substring_index(s, '_r', 1)",
    "form_image_id(s STRING) RETURNS BIGINT": "cast(conv(substr(md5(s), 1, 12), 16, 10) AS bigint)",
    "form_squeeze(s STRING) RETURNS STRING": r"trim(regexp_replace(coalesce(s, ''), r'(?U)\s+', ' '))",
}


def register(spark: SparkSession) -> None:
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
