"""The test tables seen as contribution records.

``RECORDS_SQL`` runs unchanged in Spark SQL and in DuckDB, so a query and its SQL check start from the same rows.
It makes name variants that normalize alike, several ZIP spellings, blank and placeholder ZIPs, missing
addresses, other entity types, bad dates, repeated name+date+amount keys and three load dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RECORDS_SQL = """
SELECT
  'C' || lpad(CAST(o_custkey % 97 AS STRING), 8, '0') AS CMTE_ID,
  CASE WHEN o_orderkey % 10 = 0 THEN 'A' ELSE 'N' END AS AMNDT_IND,
  'YE' AS RPT_TP,
  CASE WHEN o_orderkey % 12 = 0 THEN '' ELSE 'P' END AS TRANSACTION_PGI,
  '2026' || lpad(CAST(o_orderkey AS STRING), 14, '0') AS IMAGE_NUM,
  '10' AS TRANSACTION_TP,
  CASE WHEN o_orderkey % 20 = 7 THEN 'ORG' WHEN o_orderkey % 20 = 13 THEN 'COM' ELSE 'IND' END AS ENTITY_TP,
  CASE o_orderkey % 4
    WHEN 0 THEN 'O''FAM' || CAST(c_custkey % 200 AS STRING) || ', GIVEN-' || CAST(c_custkey % 3 AS STRING)
    WHEN 1 THEN 'ofam' || CAST(c_custkey % 200 AS STRING) || ' given_' || CAST(c_custkey % 3 AS STRING)
    WHEN 2 THEN ' OFam' || CAST(c_custkey % 200 AS STRING) || '  Given ' || CAST(c_custkey % 3 AS STRING) || '. '
    ELSE 'OFAM' || CAST(c_custkey % 200 AS STRING) || ', GIVEN ' || CAST(c_custkey % 3 AS STRING) END AS NAME,
  CASE WHEN c_custkey % 100 = 0 THEN NULL
       WHEN o_orderkey % 2 = 0 THEN 'Lake ' || CAST(c_nationkey % 5 AS STRING) || ' Street'
       ELSE 'LAKE ' || CAST(c_nationkey % 5 AS STRING) || ' ST.' END AS CITY,
  CASE WHEN c_custkey % 100 = 0 THEN NULL ELSE substr(r_name, 1, 2) END AS STATE,
  CASE WHEN c_custkey % 50 = 0 OR o_orderkey % 8 = 0
         THEN CASE WHEN o_orderkey % 16 = 0 THEN NULL ELSE '' END
       WHEN c_custkey % 77 = 5 THEN '00000'
       WHEN o_orderkey % 8 = 1 THEN lpad(CAST(c_custkey % 1000 AS STRING), 5, '0') || '-1234'
       WHEN o_orderkey % 8 = 2 THEN lpad(CAST(c_custkey % 1000 AS STRING), 5, '0') || '1234'
       WHEN o_orderkey % 8 = 3 THEN ' ' || lpad(CAST(c_custkey % 1000 AS STRING), 5, '0') || ' '
       WHEN o_orderkey % 8 = 4 THEN CAST(c_custkey % 1000 AS STRING)
       ELSE lpad(CAST(c_custkey % 1000 AS STRING), 5, '0') END AS ZIP_CODE,
  CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE c_mktsegment END AS EMPLOYER,
  CASE WHEN o_orderkey % 61 = 0 THEN '' ELSE o_orderpriority END AS OCCUPATION,
  CASE WHEN o_orderkey % 500 = 3 THEN '13452020'
       WHEN o_orderkey % 5 = 0 THEN '0101' || CAST(year(o_orderdate) AS STRING)
       ELSE lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || lpad(CAST(day(o_orderdate) AS STRING), 2, '0')
            || CAST(year(o_orderdate) AS STRING) END AS TRANSACTION_DT,
  CASE WHEN c_custkey % 6 = 0 THEN CAST(o_orderkey % 60 AS DECIMAL(18,2))
       WHEN o_orderkey % 5 = 0 THEN CAST(25 * (c_custkey % 4 + 1) AS DECIMAL(18,2))
       ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS TRANSACTION_AMT,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'C' || CAST(o_orderkey % 11 AS STRING) END AS OTHER_ID,
  'T' || CAST(o_orderkey AS STRING) AS TRAN_ID,
  CAST(o_orderkey % 1000 AS STRING) AS FILE_NUM,
  CASE WHEN o_orderkey % 143 = 0 THEN 'X' ELSE NULL END AS MEMO_CD,
  CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 'MEMO' END AS MEMO_TEXT,
  CAST(o_orderkey AS STRING) AS SUB_ID,
  CASE o_orderkey % 3 WHEN 0 THEN DATE '2025-01-01' WHEN 1 THEN DATE '2025-01-02'
                      ELSE DATE '2025-01-03' END AS _load_date
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
  JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

TABLES = ("orders", "customer", "nation", "region")


def contribution_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as raw contribution records (21 source columns and the load date)."""
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}
    return spark.sql(RECORDS_SQL, **tables)


def records_cte() -> str:
    """The same rows as SQL text over tables registered under their plain names."""
    return RECORDS_SQL.format(**{name: name for name in TABLES})
