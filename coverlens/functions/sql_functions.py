"""The same functions for SQL users, as temporary SQL functions."""

from __future__ import annotations

from pyspark.sql import SparkSession


def literal(value: str) -> str:
    """A string as a SQL literal, whatever it holds."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(spark: SparkSession, byline_marker: str = ".Wp-") -> None:
    """Create ``clean_byline``, ``page_domain`` and ``ordinal_suffix`` in the session.

    SQL functions are inlined by the optimizer, so they cost what their body costs.
    """
    marker = literal(byline_marker)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION clean_byline(byline STRING) RETURNS STRING RETURN
        substring_index(if(instr(byline, {marker}) = 1, '', byline), concat(', ', {marker}), 1)""")
    spark.sql(r"""
        CREATE OR REPLACE TEMPORARY FUNCTION page_domain(url STRING) RETURNS STRING RETURN
        regexp_replace(lower(regexp_extract(url,
            r'^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), r'^www\.', '')""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION ordinal_suffix(n BIGINT) RETURNS STRING RETURN
        CASE WHEN n = 0 THEN '' WHEN n % 100 IN (11, 12, 13) THEN 'th'
             WHEN n % 10 = 1 THEN 'st' WHEN n % 10 = 2 THEN 'nd' WHEN n % 10 = 3 THEN 'rd'
             ELSE 'th' END""")
