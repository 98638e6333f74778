"""SQL-visible functions (``CREATE TEMPORARY FUNCTION ... RETURN <expr>``).

They are SQL-bodied, so Catalyst inlines them like any built-in expression:
no Python worker, codegen applies.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from histevents.lexicons import URL_PATTERN


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register ``digital_root``, ``is_valid_url``, ``event_hash``,
    ``trigram_similarity`` for this session; returns their names."""
    stmts = {
        "digital_root": "CREATE OR REPLACE TEMPORARY FUNCTION digital_root(y INT) RETURNS INT "
                        "RETURN CASE WHEN y <= 9 THEN y ELSE 1 + pmod(y - 1, 9) END",
        "is_valid_url": f"CREATE OR REPLACE TEMPORARY FUNCTION is_valid_url(u STRING) RETURNS BOOLEAN "
                        f"RETURN u RLIKE {_lit(URL_PATTERN)}",
        "event_hash": "CREATE OR REPLACE TEMPORARY FUNCTION event_hash(y INT, t STRING, s STRING) RETURNS STRING "
                      "RETURN md5(concat_ws('_', coalesce(CAST(y AS STRING), 'None'), coalesce(t, 'None'), "
                      "coalesce(s, 'None')))",
        "trigrams": "CREATE OR REPLACE TEMPORARY FUNCTION trigrams(x STRING) RETURNS ARRAY<STRING> RETURN "
                    "array_distinct(flatten(transform(filter(split(lower(x), '[^\\\\p{L}\\\\p{N}]+', -1), "
                    "w -> w != ''), w -> transform(sequence(1, length(w) + 1), "
                    "i -> substring(concat('  ', w, ' '), i, 3)))))",
        "trigram_similarity": "CREATE OR REPLACE TEMPORARY FUNCTION trigram_similarity(a STRING, b STRING) "
                              "RETURNS DOUBLE RETURN try_divide("
                              "CAST(size(array_intersect(trigrams(a), trigrams(b))) AS DOUBLE), "
                              "CAST(size(trigrams(a)) + size(trigrams(b)) "
                              "- size(array_intersect(trigrams(a), trigrams(b))) AS DOUBLE))",
    }
    for sql in stmts.values():
        spark.sql(sql)
    return list(stmts)
