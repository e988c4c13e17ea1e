"""Literature queries: events as records of nested JSON, as varied as the service gives them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import records as src
from .registry import query, table

#: A record's text from an event, in either engine's SQL; every eleventh is cut off, every thirteenth no object.
_TEXT = """CASE WHEN event_id % 13 = 0 THEN '[1, 2]' ELSE concat('{"id": "', event_id, '", "source": "MED", "title": " On ', event_type, ' "',
  CASE event_id % 4 WHEN 0 THEN concat(', "pmid": "', user_id, '"') WHEN 1 THEN concat(', "pmid": null, "doi": "10.1/AB', user_id, '"') WHEN 2 THEN ', "doi": 7' ELSE '' END,
  CASE event_id % 3 WHEN 0 THEN concat(', "pubTypeList": {"pubType": ["', upper(event_type), '", "Letter", "letter", null]}') WHEN 1 THEN ', "pubTypeList": {"pubType": "Retracted Publication"}' ELSE ', "pubTypeList": "none"' END,
  ', "commentCorrectionList": {"commentCorrection": [{"type": "', CASE event_id % 5 WHEN 0 THEN 'Erratum in' WHEN 1 THEN 'Expression of concern in' ELSE 'Comment on' END, '"}, 5]}',
  ', "props": ', props, CASE WHEN event_id % 11 = 0 THEN '' ELSE '}' END) END"""


def _records(spark, sf_dir):
    rows = src.parsed(table(spark, sf_dir, "events").select("event_id", "event_type", "ts", F.expr(_TEXT).alias("text")), "text")
    return src.normalised(rows.withColumn("k", src.get(F.col("json"), "$.props.k", "bigint")))


_FIELDS = """b AS (SELECT *, CASE WHEN event_id % 13 = 0 THEN 'not_an_object' WHEN event_id % 11 = 0 THEN 'malformed' END AS bad FROM events),
r AS (SELECT *, CASE WHEN bad IS NOT NULL THEN '' WHEN event_id % 4 = 0 THEN CAST(user_id AS VARCHAR) WHEN event_id % 4 = 1 THEN '10.1/ab' || user_id WHEN event_id % 4 = 2 THEN '7' ELSE 'MED:' || event_id END AS key FROM b)"""


@query(f"""WITH {_FIELDS} SELECT event_id, bad, key, CASE WHEN bad IS NULL THEN 'On ' || event_type ELSE '' END AS title, CASE WHEN bad IS NOT NULL OR event_id % 3 = 2 THEN '' WHEN event_id % 3 = 1 THEN 'retracted publication'
  ELSE array_to_string(list_sort(['letter', event_type]), '|') END AS types, bad IS NULL AND event_id % 3 = 1 AS retracted, bad IS NULL AND event_id % 5 = 1 AS concern, bad IS NULL AND event_id % 5 = 0 AS corrected,
  CASE WHEN bad IS NULL THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM r""")
def literature_records(spark, sf_dir):
    return _records(spark, sf_dir).select("event_id", "bad", "key", "title", F.array_join("types", "|").alias("types"), "retracted", "concern", "corrected", "k")


@query("""SELECT CASE WHEN event_id % 13 = 0 THEN 'not_an_object' ELSE 'malformed' END AS bad, event_type, count(*) AS n, min(event_id) AS first_id FROM events WHERE event_id % 13 = 0 OR event_id % 11 = 0 GROUP BY ALL""")
def record_quarantine(spark, sf_dir):
    rows = src.parsed(table(spark, sf_dir, "events").select("event_id", "event_type", F.expr(_TEXT).alias("text")), "text")
    return src.quarantined(rows).groupBy("bad", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


MOST = 40


@query(f"""WITH {_FIELDS}, o AS (SELECT *, row_number() OVER (PARTITION BY event_type, key ORDER BY ts, event_id) AS nth FROM r WHERE key <> ''),
c AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS place FROM o WHERE nth = 1) SELECT event_type, key, event_id FROM c WHERE place <= {MOST}""")
def record_cap(spark, sf_dir):
    """Of each query's answer the first records, a key once."""
    found = _records(spark, sf_dir).select("event_type", "key", "ts", "event_id")
    return src.first_of_each(found, ["ts", "event_id"], MOST, ["event_type"]).select("event_type", "key", "event_id")
