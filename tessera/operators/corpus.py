"""Corpus assembly from three feeds.

Three feed DataFrames are projected onto one 14-field document schema and
unioned by name.  Incremental loads drop ids that the corpus already holds
with an anti join; when the corpus is stored partitioned by day, restrict the
old side to the touched days first so the anti join reads only those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Id prefix and platform code per feed (P20, Q22).
FEEDS = {"news": ("N", 1), "article": ("W", 2), "micro": ("B", 3)}

DOC_COLUMNS = ["doc_id", "platform", "title", "url", "content", "notice_time", "source",
               "feed_type", "sentiment", "location", "main_body", "product_info",
               "nick_name", "keyword"]

DOC_SCHEMA = ("doc_id string, platform int, title string, url string, content string, "
              "notice_time timestamp, source string, feed_type int, sentiment double, "
              "location string, main_body string, product_info string, nick_name string, "
              "keyword string")


def _typed(df: DataFrame) -> DataFrame:
    types = dict(f.split(" ", 1) for f in DOC_SCHEMA.split(", "))
    cols = []
    for c in DOC_COLUMNS:
        col = F.col(c) if c in df.columns else F.lit(None)
        cols.append(col.cast(types[c]).alias(c))
    return df.select(*cols)


def main_body(org, company):
    """`org+:company`, NULL only when both are NULL."""
    return F.when(org.isNull() & company.isNull(), F.lit(None).cast("string")) \
        .otherwise(F.concat(F.coalesce(org, F.lit("")), F.lit("+:"), F.coalesce(company, F.lit(""))))


def from_news(news: DataFrame) -> DataFrame:
    """Columns: news_id, title, url, body, notice_time, source, type,
    neg_sentiment, ner_location, ner_org_name, ner_company_name, ner_product_name."""
    p, code = FEEDS["news"]
    return _typed(news.select(
        F.concat(F.lit(p), F.col("news_id").cast("string")).alias("doc_id"),
        F.lit(code).alias("platform"), "title", "url", F.col("body").alias("content"),
        "notice_time", "source", F.col("type").alias("feed_type"),
        F.coalesce(F.col("neg_sentiment"), F.lit(0.0)).alias("sentiment"),
        F.col("ner_location").alias("location"),
        main_body(F.col("ner_org_name"), F.col("ner_company_name")).alias("main_body"),
        F.col("ner_product_name").alias("product_info")))


def from_articles(articles: DataFrame) -> DataFrame:
    """Columns: id, title, url, body, notice_time, source."""
    p, code = FEEDS["article"]
    return _typed(articles.select(
        F.concat(F.lit(p), F.col("id").cast("string")).alias("doc_id"),
        F.lit(code).alias("platform"), "title", "url", F.col("body").alias("content"),
        "notice_time", "source", F.lit(0.0).alias("sentiment")))


def from_micro(micro: DataFrame) -> DataFrame:
    """Columns: id, nick_name, content, detail_url, publish_time, keyword."""
    p, code = FEEDS["micro"]
    return _typed(micro.select(
        F.concat(F.lit(p), F.col("id").cast("string")).alias("doc_id"),
        F.lit(code).alias("platform"), F.col("detail_url").alias("url"), "content",
        F.col("publish_time").alias("notice_time"), "keyword", "nick_name"))


def in_range(df: DataFrame, start, end, col: str = "notice_time") -> DataFrame:
    """Inclusive time range (pushed to the scan when `df` is a file source)."""
    return df.where(F.col(col).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def one_per_id(docs: DataFrame) -> DataFrame:
    """One row per doc_id: of copies that differ the earliest, then the least
    by all columns."""
    first = F.struct(F.col("notice_time").alias("_at"), F.struct(*docs.columns).alias("_row"))
    return docs.groupBy(F.col("doc_id").alias("_id")).agg(F.min(first).alias("_first")).select("_first._row.*")


def load_documents(news: DataFrame, articles: DataFrame, micro: DataFrame, start, end,
                   existing: DataFrame | None = None) -> DataFrame:
    """S6 + U2 + J7: documents of all feeds in [start, end] not yet in `existing`."""
    docs = (from_news(in_range(news, start, end))
            .unionByName(from_articles(in_range(articles, start, end)))
            .unionByName(from_micro(in_range(micro, start, end, "publish_time"))))
    if existing is not None:
        docs = docs.join(existing.select("doc_id"), "doc_id", "left_anti")
    return one_per_id(docs)


def decode_id(doc_id):
    """P20 inverse: (prefix, numeric id)."""
    return F.substring(doc_id, 1, 1), F.substring(doc_id, 2, 1 << 30).cast("bigint")


def exclude_micro_and_type2(df: DataFrame) -> DataFrame:
    """Drop platform 3 or feed type 2; NULL feed_type stays in."""
    return df.where(~(F.coalesce(F.col("platform") == 3, F.lit(False))
                      | F.coalesce(F.col("feed_type") == 2, F.lit(False))))


def only_platform(df: DataFrame, platform: int) -> DataFrame:
    """P4."""
    return df.where(F.col("platform") == platform)
