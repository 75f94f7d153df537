"""Driver tables and the subject-level views recast onto them.

Each view exists twice: as a Spark DataFrame builder and as the SQL text of
the same definition (used by the DuckDB oracle).  Both must stay in lockstep.

| view           | built from                | stands in for                              |
|----------------|---------------------------|--------------------------------------------|
| pred           | lineitem                  | predictions (subject, modality, split, ...) |
| cls            | labels join documents     | class predictions                          |
| series         | events                    | confound time series per subject            |
| signal         | embeddings (posexplode)   | ROI time series (subject, run, t, roi)      |
| voxel / roi    | lineitem / part           | voxel coordinates and sphere centres        |
| stats          | lineitem by supplier      | segmentation statistics                     |
| features_wide  | customer left join orders | subject feature table with real gaps        |
| targets        | customer + orders         | target table (two targets)                  |
| files          | pages.url                 | file inventory                              |
| idmap          | customer                  | participant/session map with prefixes        |
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import nan_to_null

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (Parquet; Catalyst prunes columns and pushes filters)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# ---------------------------------------------------------------- predictions

def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("subject"),
        F.col("l_returnflag").alias("modality"),
        F.col("l_linenumber").alias("split"),
        nan_to_null("l_extendedprice").alias("price"),
        nan_to_null(F.col("l_quantity") * F.lit(1500.0)).alias("price_pred"),
        nan_to_null("l_tax").alias("tax"),
        nan_to_null("l_discount").alias("tax_pred"),
        (F.lit(1.0) + F.col("l_discount")).alias("weight"),
    )


PRED_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS subject, l_returnflag AS modality, l_linenumber AS split,
       l_extendedprice AS price, l_quantity * 1500.0 AS price_pred,
       l_tax AS tax, l_discount AS tax_pred, 1.0 + l_discount AS weight
FROM lineitem"""


def cls(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "source")
    return lab.join(doc, "doc_id").select(
        F.col("doc_id").cast("string").alias("subject"),
        F.col("source").alias("modality"),
        (F.col("doc_id") % 5).cast("int").alias("split"),
        F.col("quality").cast("double").alias("quality"),
        (F.lit(1) - F.col("toxic")).cast("double").alias("quality_pred"),
        (F.lit(1.0) + (F.col("doc_id") % 3).cast("double")).alias("weight"),
    )


CLS_SQL = """
SELECT CAST(l.doc_id AS VARCHAR) AS subject, d.source AS modality, CAST(l.doc_id % 5 AS INTEGER) AS split,
       CAST(l.quality AS DOUBLE) AS quality, CAST(1 - l.toxic AS DOUBLE) AS quality_pred,
       1.0 + CAST(l.doc_id % 3 AS DOUBLE) AS weight
FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


# ---------------------------------------------------------------- time series

def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One time series per subject (user); order key (ts, event_id)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("subject"),
        F.col("ts"), F.col("event_id"),
        nan_to_null("value").alias("value"),
    )


SERIES_SQL = """
SELECT CAST(user_id AS VARCHAR) AS subject, ts, event_id, value FROM events"""


def signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long ROI signal: (subject, run, t, roi, network, value)."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("label").cast("string").alias("subject"),
        (F.col("vec_id") % 2).cast("int").alias("run"),
        F.col("vec_id").alias("t"),
        F.posexplode("embedding").alias("roi", "v"),
    ).select(
        "subject", "run", "t", "roi",
        F.concat(F.lit("n"), (F.col("roi") % 7).cast("string")).alias("network"),
        nan_to_null(F.col("v").cast("double")).alias("value"),
    )


SIGNAL_SQL = """
SELECT subject, run, t, roi, 'n' || CAST(roi % 7 AS VARCHAR) AS network, value FROM (
  SELECT CAST(label AS VARCHAR) AS subject, CAST(vec_id % 2 AS INTEGER) AS run, vec_id AS t,
         CAST(unnest(generate_series(0, len(embedding) - 1)) AS INTEGER) AS roi,
         CAST(unnest(embedding) AS DOUBLE) AS value
  FROM embeddings)"""


# ---------------------------------------------------------------- geometry

def voxel(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_linenumber").cast("int").alias("x"),
        F.col("l_quantity").cast("int").alias("y"),
        F.round(F.col("l_discount") * 100).cast("int").alias("z"),
        # prices carry 2 decimals: exact decimal sums make the ROI means
        # independent of summation order
        F.col("l_extendedprice").cast("decimal(15,2)").alias("value"),
    )


VOXEL_SQL = """
SELECT CAST(l_linenumber AS INTEGER) AS x, CAST(l_quantity AS INTEGER) AS y,
       CAST(round(l_discount * 100) AS INTEGER) AS z, CAST(l_extendedprice AS DECIMAL(15, 2)) AS value
FROM lineitem"""


def roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("roi"),
        ((F.col("p_size") % 7) + 1).cast("int").alias("x"),
        (F.col("p_size") * 2).cast("int").alias("y"),
        (F.col("p_partkey") % 11).cast("int").alias("z"),
    )


ROI_SQL = """
SELECT p_partkey AS roi, CAST(p_size % 7 + 1 AS INTEGER) AS x, CAST(p_size * 2 AS INTEGER) AS y,
       CAST(p_partkey % 11 AS INTEGER) AS z
FROM part"""


# ---------------------------------------------------------------- structural stats

def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long stats: (subject, struct, value); struct 'eTIV' carries the subject total."""
    li = table(spark, sf_dir, "lineitem")
    per = li.groupBy(
        F.col("l_suppkey").cast("string").alias("subject"),
        F.concat("l_returnflag", "l_linestatus").alias("struct"),
    ).agg(F.sum("l_quantity").alias("value"))
    # the subject total is derived from the (small) per-structure table: no second scan
    tot = per.groupBy("subject").agg(F.lit("eTIV").alias("struct"), F.sum("value").alias("value"))
    return per.unionByName(tot)


STATS_SQL = """
SELECT subject, struct, value FROM (
  SELECT CAST(l_suppkey AS VARCHAR) AS subject, l_returnflag || l_linestatus AS struct, sum(l_quantity) AS value
  FROM lineitem GROUP BY 1, 2) s
UNION ALL
SELECT subject, 'eTIV' AS struct, sum(value) AS value FROM (
  SELECT CAST(l_suppkey AS VARCHAR) AS subject, l_returnflag || l_linestatus AS struct, sum(l_quantity) AS value
  FROM lineitem GROUP BY 1, 2) s2
GROUP BY subject"""


# ---------------------------------------------------------------- subject tables

ORDER_STATUSES = ("F", "O", "P")


def features_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer features with real gaps: average order price per status (NULL if none)."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    per = o.groupBy("o_custkey").agg(*[
        F.avg(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))).alias(f"price_{s}")
        for s in ORDER_STATUSES])
    return c.join(per, c.c_custkey == per.o_custkey, "left").select(
        F.col("c_custkey").cast("string").alias("subject"),
        nan_to_null("c_acctbal").alias("acctbal"),
        *[F.col(f"price_{s}") for s in ORDER_STATUSES])


FEATURES_WIDE_SQL = """
SELECT CAST(c.c_custkey AS VARCHAR) AS subject, c.c_acctbal AS acctbal,
       p.price_F, p.price_O, p.price_P
FROM customer c LEFT JOIN (
  SELECT o_custkey,
         avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS price_F,
         avg(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS price_O,
         avg(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS price_P
  FROM orders GROUP BY o_custkey) p ON c.c_custkey = p.o_custkey"""


def learn_x(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model inputs per customer: average price (gaps) and order count per status."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    per = o.groupBy("o_custkey").agg(*[
        F.avg(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))).alias(f"price_{s}")
        for s in ORDER_STATUSES], *[
        F.count(F.when(F.col("o_orderstatus") == s, 1)).cast("double").alias(f"n_{s}")
        for s in ORDER_STATUSES])
    return c.join(per, c.c_custkey == per.o_custkey).select(
        F.col("c_custkey").cast("string").alias("subject"),
        *[F.col(f"price_{s}") for s in ORDER_STATUSES], *[F.col(f"n_{s}") for s in ORDER_STATUSES])


LEARN_X_SQL = """
SELECT CAST(c.c_custkey AS VARCHAR) AS subject, p.price_F, p.price_O, p.price_P, p.n_F, p.n_O, p.n_P
FROM customer c JOIN (
  SELECT o_custkey,
         avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS price_F,
         avg(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS price_O,
         avg(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS price_P,
         CAST(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS DOUBLE) AS n_F,
         CAST(count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS DOUBLE) AS n_O,
         CAST(count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS DOUBLE) AS n_P
  FROM orders GROUP BY o_custkey) p ON c.c_custkey = p.o_custkey"""

LEARN_FEATURES = [f"price_{s}" for s in ORDER_STATUSES] + [f"n_{s}" for s in ORDER_STATUSES]


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two targets per subject: account balance and total order price."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    tot = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total_price"))
    return c.join(tot, c.c_custkey == tot.o_custkey).select(
        F.col("c_custkey").cast("string").alias("subject"),
        nan_to_null("c_acctbal").alias("acctbal"),
        nan_to_null("total_price").alias("total_price"))


TARGETS_SQL = """
SELECT CAST(c.c_custkey AS VARCHAR) AS subject, c.c_acctbal AS acctbal, t.total_price
FROM customer c JOIN (SELECT o_custkey, sum(o_totalprice) AS total_price FROM orders GROUP BY o_custkey) t
  ON c.c_custkey = t.o_custkey"""


def idmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Participant/session map with BIDS-style prefixes added."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("sub-"), F.col("c_custkey").cast("string")).alias("participant_id"),
        F.concat(F.lit("ses-"), F.lower("c_mktsegment")).alias("session_id"))


IDMAP_SQL = """
SELECT 'sub-' || CAST(c_custkey AS VARCHAR) AS participant_id, 'ses-' || lower(c_mktsegment) AS session_id
FROM customer"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web page URLs read as a file inventory: path plus its entities."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.col("url").alias("path"))


FILES_SQL = "SELECT page_id, url AS path FROM pages"


VIEW_SQL = {
    "pred": PRED_SQL, "cls": CLS_SQL, "series": SERIES_SQL, "signal": SIGNAL_SQL,
    "voxel": VOXEL_SQL, "roi": ROI_SQL, "stats": STATS_SQL, "features_wide": FEATURES_WIDE_SQL,
    "targets": TARGETS_SQL, "idmap": IDMAP_SQL, "files": FILES_SQL, "learn_x": LEARN_X_SQL,
}

VIEWS = {
    "pred": pred, "cls": cls, "series": series, "signal": signal, "voxel": voxel, "roi": roi,
    "stats": stats, "features_wide": features_wide, "targets": targets, "idmap": idmap, "files": files,
    "learn_x": learn_x,
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named views (oracle side)."""
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in names)
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{sql}"
