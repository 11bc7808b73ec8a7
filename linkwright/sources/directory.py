"""The test directory: three noisy projections of ``part``, with the truth known by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_RAW = {
    "source1": """SELECT concat('S1-', CAST(p_partkey AS STRING)) AS id, p_partkey AS k,
  concat(p_name, ' ', lower(p_type), ' Ltd') AS business_name,
  concat(CAST(p_size AS STRING), ' ', p_brand, ' Street') AS business_address,
  concat(lpad(CAST(p_partkey % 90 AS STRING), 2, '0'), '001') AS postal_code, n_name AS country
  FROM part JOIN nation ON n_nationkey = p_partkey % 25""",
    "source2": """SELECT concat('S2-', CAST(p_partkey AS STRING)) AS id, p_partkey AS k,
  concat(upper(p_name), ' ', upper(p_type), ' LIMITED') AS business_name,
  concat(CAST(p_size AS STRING), ' ', p_brand, ' St') AS business_address,
  concat(lpad(CAST(p_partkey % 90 AS STRING), 2, '0'), '001') AS postal_code, n_name AS country
  FROM part JOIN nation ON n_nationkey = p_partkey % 25 WHERE p_partkey % 7 <> 0""",
    "source3": """SELECT concat('S3-', CAST(p_partkey AS STRING)) AS id, p_partkey AS k,
  concat(substr(p_name, 1, length(p_name) - 1), ' ', lower(p_type), ' Pvt. Ltd.') AS business_name,
  concat('Near ', p_type, ' ATM, ', CAST(p_size AS STRING), ' ', p_brand, ' Street') AS business_address,
  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE concat(lpad(CAST(p_partkey % 90 AS STRING), 2, '0'), '001') END AS postal_code,
  CASE WHEN p_partkey % 6 = 0 THEN '' ELSE n_name END AS country
  FROM part JOIN nation ON n_nationkey = p_partkey % 25 WHERE p_partkey % 5 <> 0""",
}

#: As common table expressions, for oracles.
CTES = ",\n".join(f"{name} AS ({sql})" for name, sql in _RAW.items())


def read_directory(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """id, k (the key that tells the truth), business_name, business_address, postal_code, country."""
    sql = _RAW[source]
    return spark.sql(
        sql.replace("FROM part JOIN nation", "FROM {part} AS part JOIN {nation} AS nation"),
        part=spark.read.parquet(f"{sf_dir}/part.parquet"),
        nation=spark.read.parquet(f"{sf_dir}/nation.parquet"),
    )
