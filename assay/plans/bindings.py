"""Bind the driver tables to the roles the operators take (key, segment, features, score).

B1 general   lineitem          key (l_orderkey, l_linenumber, l_partkey, l_suppkey),
                               segment l_returnflag,
                               features l_extendedprice, l_discount, l_tax, unit_price,
                               score floor(l_quantity / 5) in 0..10
B2 skewed    events            key event_id, segment event_type, feature value
B3 labelled  documents+labels  key doc_id, segment lang, n_chars and word counts, label quality
B4 vectors   embeddings        key vec_id, 64-float embedding, label
B5 regress.  orders+lineitem   key o_orderkey, segment o_orderpriority, line aggregates,
                               target o_totalprice

Each builder has its SQL twin (a CTE body) so oracle statements share one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.sources.tables import table


@dataclass(frozen=True)
class Roles:
    key: tuple
    segment: str
    features: tuple
    score: str


B1 = Roles(("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "l_returnflag",
           ("l_extendedprice", "l_discount", "l_tax", "unit_price"), "score")
B2 = Roles(("event_id",), "event_type", ("value",), "score")
B3 = Roles(("doc_id",), "lang", ("n_chars", "n_words", "n_lines"), "quality")
B5 = Roles(("o_orderkey",), "o_orderpriority",
           ("n_lines", "avg_discount", "avg_tax", "sum_quantity"), "o_totalprice")


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice",
                     "l_discount", "l_tax",
                     (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
                     F.floor(F.col("l_quantity") / 5).cast("int").alias("score"))


M_SQL = """m AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_extendedprice, l_discount, l_tax,
       l_extendedprice / l_quantity AS unit_price,
       CAST(FLOOR(l_quantity / 5) AS INTEGER) AS score FROM lineitem)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "event_type", "value", "user_id",
                     F.least(F.floor(F.col("value") / 10), F.lit(10)).cast("int").alias("score"))


E_SQL = """e AS (SELECT event_id, event_type, value, user_id,
       CAST(LEAST(FLOOR(value / 10), 10) AS INTEGER) AS score FROM events)"""


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels; word and line counts over the whole text."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    words = F.size(F.split(F.trim(F.col("text")), r"\s+"))
    return (d.join(lab, "doc_id")
            .select("doc_id", "lang", F.col("n_chars").cast("double").alias("n_chars"),
                    F.when(F.trim(F.col("text")) == "", F.lit(0)).otherwise(words)
                    .cast("double").alias("n_words"),
                    F.size(F.split(F.col("text"), "\n")).cast("double").alias("n_lines"),
                    "quality", "toxic"))


D_SQL = r"""d AS (SELECT doc_id, lang, CAST(n_chars AS DOUBLE) AS n_chars,
       CAST(CASE WHEN trim(text) = '' THEN 0 ELSE len(regexp_split_to_array(trim(text), '\s+')) END AS DOUBLE) AS n_words,
       CAST(len(string_split(text, chr(10))) AS DOUBLE) AS n_lines,
       quality, toxic FROM documents JOIN labels USING (doc_id))"""


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its line aggregates (partial aggregation before the join)."""
    li = table(spark, sf_dir, "lineitem")
    agg = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"),
        F.avg("l_discount").alias("avg_discount"), F.avg("l_tax").alias("avg_tax"),
        F.sum("l_quantity").alias("sum_quantity"))
    o = table(spark, sf_dir, "orders")
    return (o.join(agg, o.o_orderkey == agg.l_orderkey)
            .select("o_orderkey", "o_orderpriority", "n_lines", "avg_discount", "avg_tax",
                    "sum_quantity", "o_totalprice"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")
