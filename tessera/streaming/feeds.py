"""Incremental corpus ingest as a Structured Streaming job (2.12; S6 J7 U2).

The reference has no streaming operator: it re-reads overlapping time windows
and skips ids it already holds.  Here one feed folder is a file stream:

    readStream.parquet(feed folder)        new files only, tracked by the source
    -> S6 normalisation to the document schema
    -> dropDuplicates(doc_id): the ids of all batches are the stream's state
    -> foreachBatch: anti join (J7) against other loads, write the batch's folder

No event-time watermark: feeds re-deliver old records in any order (the
overlapping re-reads), and a watermarked de-duplication would drop every row
behind the watermark.  The ids a stream has stored are its state, in RocksDB
state stores that write a batch's changes only: a batch looks up and adds its
own ids, so its cost does not grow with the corpus.  Ids that were stored by
other loads are read from those loads, whose size the stream does not change.

Every batch writes a folder of its own, `load=stream-<feed>-<query>-<batch>`,
partitioned by day.  A batch replayed after a lost executor or driver finds the
state of before and overwrites its own folder with the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import corpus as C
from tessera.session import checkpoint_dir
from tessera.sources.store import names_in

# Input schema of each feed (the columns the normaliser reads).
FEED_SCHEMAS = {
    "news": ("news_id bigint, title string, url string, body string, notice_time timestamp, "
             "source string, type int, neg_sentiment double, ner_location string, "
             "ner_org_name string, ner_company_name string, ner_product_name string"),
    "article": "id bigint, title string, url string, body string, notice_time timestamp, source string",
    "micro": ("id bigint, nick_name string, content string, detail_url string, "
              "publish_time timestamp, keyword string"),
}

_NORMALISE = {"news": C.from_news, "article": C.from_articles, "micro": C.from_micro}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


ADAPTIVE = "spark.sql.adaptive.enabled"
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def new_documents(batch: DataFrame, corpus_path: str, feed: str | None = None, own: str | None = None) -> DataFrame:
    """J7 for one batch: rows whose doc_id the stored corpus lacks, whatever
    day either carries.  Only ids are read; of a corpus in loads, neither the
    loads of the stream `own`, whose ids are its state, nor those of other
    feeds' streams, whose ids differ."""
    spark = batch.sparkSession
    if not _exists(spark, corpus_path):
        return batch
    loads = [n.split("=", 1)[1] for n in names_in(spark, corpus_path) if n.startswith("load=")]
    if not loads:
        return batch.join(spark.read.schema("doc_id string").parquet(corpus_path), "doc_id", "left_anti")
    others = [f for f in FEED_SCHEMAS if f != feed]
    wanted = [x for x in loads if not (own and x.startswith(own)) and not any(x.startswith(f"stream-{f}-") for f in others)]
    if not wanted:
        return batch
    stored = spark.read.schema("doc_id string").parquet(*[f"{corpus_path.rstrip('/')}/load={x}" for x in wanted])
    return batch.join(stored, "doc_id", "left_anti")


def feed_stream(spark: SparkSession, feed: str, src_dir: str,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """The normalised document stream of one feed folder."""
    reader = spark.readStream.schema(FEED_SCHEMAS[feed])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = _NORMALISE[feed](reader.parquet(src_dir))
    return docs.withColumn("day", F.to_date("notice_time"))


def ingest(spark: SparkSession, feed: str, src_dir: str, corpus_path: str,
           checkpoint: str | None = None, available_now: bool = True,
           processing_time: str | None = None, max_files_per_trigger: int | None = None):
    """Start the ingest of `feed` files arriving in `src_dir` into the corpus
    table at `corpus_path` (Parquet partitioned by load and day).  With `available_now`
    (default) every file present is processed and the query stops; otherwise
    it runs on `processing_time` triggers.  Returns the StreamingQuery."""
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/ingest-{feed}"

    def store(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        own = f"stream-{feed}-{query}-"
        # few files a day, and a large day in several tasks: the hint holds under AQE only, which a
        # stream's session switches off for the plans of its state
        conf = batch.sparkSession.conf
        before = conf.get(ADAPTIVE)
        conf.set(ADAPTIVE, "true")
        try:
            (new_documents(batch, corpus_path, feed, own).hint("rebalance", "day")
             .write.mode("overwrite").partitionBy("day").parquet(f"{corpus_path.rstrip('/')}/load={own}{batch_id}"))
        finally:
            conf.set(ADAPTIVE, before)

    for key, value in STATE.items():
        if not spark.conf.get(key, "").endswith(value):
            spark.conf.set(key, value)
    w = (feed_stream(spark, feed, src_dir, max_files_per_trigger).dropDuplicates(["doc_id"]).writeStream
         .foreachBatch(store).option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()
