"""Checked queries on shares: revenue of parts within their brand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselight.operators import shares
from caselight.registry import query, table

_ITEMS = """
items AS (SELECT p_brand AS brand, l_partkey AS partkey, sum(l_extendedprice * (1 - l_discount)) AS revenue
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
shared AS (SELECT *, revenue / sum(revenue) OVER (PARTITION BY brand) AS p FROM items)"""


def items(spark, sf_dir) -> DataFrame:
    """(brand, partkey, revenue); line items fold to parts before they meet the part table."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("partkey")).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")
    )
    brands = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("partkey"), F.col("p_brand").alias("brand")
    )
    return lines.join(brands, "partkey").select("brand", "partkey", "revenue")


def _shown(df: DataFrame) -> DataFrame:
    return df.select("brand", "partkey", F.round("share", 6).alias("share"))


@query(
    "topk_share",
    f"""WITH {_ITEMS}, kept AS (SELECT * FROM shared
        QUALIFY row_number() OVER (PARTITION BY brand ORDER BY revenue DESC, partkey) <= 5)
      SELECT brand, partkey, round(revenue / sum(revenue) OVER (PARTITION BY brand), 6) AS share FROM kept""",
)
def topk_share(spark, sf_dir):
    return _shown(shares.top_k_share(items(spark, sf_dir), "brand", "partkey", "revenue", 5))


@query(
    "nucleus_share",
    f"""WITH {_ITEMS}, running AS (SELECT *, sum(p) OVER (PARTITION BY brand ORDER BY revenue DESC, partkey
          ROWS UNBOUNDED PRECEDING) - p AS before FROM shared)
      SELECT brand, partkey, round(revenue / sum(revenue) OVER (PARTITION BY brand), 6) AS share
      FROM running WHERE before < 0.6 - 1e-12""",
)
def nucleus_share(spark, sf_dir):
    return _shown(shares.nucleus_share(items(spark, sf_dir), "brand", "partkey", "revenue", 0.6))


@query(
    "temperature_share",
    f"""WITH {_ITEMS}, logged AS (SELECT *, ln(greatest(p, 1e-10)) / 0.5 AS l FROM shared),
      scaled AS (SELECT *, exp(l - max(l) OVER (PARTITION BY brand)) AS e FROM logged)
      SELECT brand, partkey, round(e / sum(e) OVER (PARTITION BY brand), 6) AS share FROM scaled""",
)
def temperature_share(spark, sf_dir):
    return _shown(shares.temperature_share(items(spark, sf_dir), "brand", "revenue", 0.5))


@query(
    "weighted_sample",
    f"""WITH {_ITEMS}, drawn AS (SELECT brand, partkey,
        -ln((CAST('0x' || substr(md5('7:' || brand || ':' || partkey::VARCHAR), 1, 13) AS BIGINT) + 0.5::DOUBLE)
            / 4503599627370496::DOUBLE) / revenue AS draw FROM items WHERE revenue > 0)
      SELECT brand, partkey, row_number() OVER (PARTITION BY brand ORDER BY draw, partkey) AS rank FROM drawn
      QUALIFY rank <= 5""",
)
def weighted_sample(spark, sf_dir):
    return shares.weighted_sample(items(spark, sf_dir), "brand", "partkey", "revenue", 5).select(
        "brand", "partkey", "rank"
    )
