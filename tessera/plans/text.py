"""Corpus, hot-term and hot-document queries bound to the driver tables.

The `documents` table is split into the three feeds by language (en -> news,
fr/de -> articles, es -> micro-blog); title = first line of the text;
sentiment = labels.toxic; feed type = 1 for quality 1, 2 for quality 0, NULL
when unlabelled; notice time = 2024-01-01 + (doc_id mod 60) x 12 h, i.e. 60
half-day periods.  Every query reads the whole table and whole texts.

corpus_load    S6 P19 P20 U2 J7 P2   docs of [2024-01-11, 2024-01-31] not loaded before 2024-01-16
feed_stream_ingest  2.12 S6 J7       news feed files (overlapping re-reads) streamed into a corpus
hot_terms      A3 T3 F6 F7 P7 P8     whole corpus as the window
hot_terms_pre  A4                    whole corpus, corpus-wide distinctive terms
tfpdf_terms    A5 A22                channel = source
tfpdf_docs     A6                    all documents
hot_burst      W4 F5 X3 T1 T2        history = A3 per half-day period, all periods
hot_docs       X16 A6 A7 P3 P9 P10   every period's documents scored by its burst terms
hot_writeback  J20                   news rows receive their hot score
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import half_day_period_end
from tessera.functions.text import NUMBER_PATTERN, TOKEN_SPLIT
from tessera.operators import corpus as C
from tessera.operators import hot as H
from tessera.operators import terms as T
from tessera.plans.common import r6, tables
from tessera.session import checkpoint_dir
from tessera.sources.store import derived_folder, derived_path, derived_table
from tessera.streaming import feeds as ST

# Parameters of the bound queries (word lists are job inputs, not data).
HOT_STOP_WORDS = ["the", "and", "of", "de", "der", "la", "die", "und"]
WHITE_LIST = [("orantion", 2.5), ("und", None)]
BLACK_LIST = ["rewh"]
LOG_UNTIL, LOG_AGAIN = "2024-01-15 00:00:00", "2024-01-29 00:00:00"
LOAD_START, LOAD_END, LOADED_BEFORE = "2024-01-11 00:00:00", "2024-01-31 00:00:00", "2024-01-16 00:00:00"


def _words(spark, words, with_score=False) -> DataFrame:
    if with_score:
        return spark.createDataFrame(words, "word string, score double")
    return spark.createDataFrame([(w,) for w in words], "word string")


def feeds(spark, sf_dir):
    """The three feed tables derived from `documents` + `labels`."""
    t = tables(spark, sf_dir)
    d = t.documents.select("doc_id", "text", "lang", "source")
    lab = t.labels.select("doc_id", "quality", "toxic")
    base = (d.join(lab, "doc_id", "left")
             .withColumn("notice_time", F.timestamp_seconds(F.lit(1704067200) + (F.col("doc_id") % 60) * 43200))
             .withColumn("title", F.split_part(F.col("text"), F.lit("\n"), F.lit(1))))
    news = base.where(F.col("lang") == "en").select(
        F.col("doc_id").alias("news_id"), "title", F.lit(None).cast("string").alias("url"),
        F.col("text").alias("body"), "notice_time", "source",
        F.when(F.col("quality") == 1, 1).when(F.col("quality") == 0, 2).alias("type"),
        F.col("toxic").cast("double").alias("neg_sentiment"),
        F.lit(None).cast("string").alias("ner_location"), F.col("source").alias("ner_org_name"),
        F.lit(None).cast("string").alias("ner_company_name"),
        F.lit(None).cast("string").alias("ner_product_name"))
    articles = base.where(F.col("lang").isin("fr", "de")).select(
        F.col("doc_id").alias("id"), "title", F.lit(None).cast("string").alias("url"),
        F.col("text").alias("body"), "notice_time", "source")
    micro = base.where(F.col("lang") == "es").select(
        F.col("doc_id").alias("id"), F.col("source").alias("nick_name"), F.col("text").alias("content"),
        F.lit(None).cast("string").alias("detail_url"), F.col("notice_time").alias("publish_time"),
        F.lit(None).cast("string").alias("keyword"))
    return news, articles, micro


def _inputs(sf_dir):
    return [f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet"]


def corpus(spark, sf_dir) -> DataFrame:
    """The assembled corpus (S6 over all feeds) with its half-day period,
    written once to the shared folder and read back by every text query."""
    def build():
        news, articles, micro = feeds(spark, sf_dir)
        docs = C.load_documents(news, articles, micro, "2024-01-01 00:00:00", "2024-12-31 23:59:59")
        # a stated number of files: cutting texts into terms is far more work than their bytes tell AQE
        docs = docs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id")
        return docs.withColumn("period_end", half_day_period_end(F.col("notice_time")))
    return derived_table(spark, "corpus", _inputs(sf_dir), build)


def terms(spark, sf_dir, stop_words=None) -> DataFrame:
    """The forward index of the corpus (X6): content and title fields, one
    row per (doc, field, term) with tf and field length, plus the document's
    source and period for grouping.  Written once per analyser stop list."""
    def build():
        docs = corpus(spark, sf_dir)
        keep = ("source", "period_end")
        content = T.doc_terms(docs, keep=keep, field="content", stop_words=stop_words)
        title = T.doc_terms(docs.where(F.col("title").isNotNull()), text_col="title", keep=keep,
                            field="title", stop_words=stop_words)
        return content.unionByName(title)
    params = ",".join(stop_words or [])
    return derived_table(spark, "terms", _inputs(sf_dir), build, params=params)


def content_terms(spark, sf_dir, stop_words=None, keep=()) -> DataFrame:
    t = terms(spark, sf_dir, stop_words).where(F.col("field") == "content")
    return t.select("doc_id", "doc_len", *keep, "term", "tf")


def corpus_load(spark, sf_dir):
    news, articles, micro = feeds(spark, sf_dir)
    existing = C.load_documents(news, articles, micro, "2024-01-01 00:00:00", LOADED_BEFORE)
    out = C.load_documents(news, articles, micro, LOAD_START, LOAD_END, existing=existing)
    # nullable integers leave as double so every client reads one numeric kind
    return out.withColumn("feed_type", F.col("feed_type").cast("double"))


def feed_stream_ingest(spark, sf_dir):
    """2.12: the news feed delivered as overlapping re-reads (days before
    2024-01-20, and days from 2024-01-15: the overlap arrives twice), streamed
    two files per micro-batch into a fresh day-partitioned corpus.  Every news
    document is stored exactly once."""
    def build():
        news, _, _ = feeds(spark, sf_dir)
        news = news.select(*[F.col(c.split(" ")[0]).cast(c.split(" ")[1]).alias(c.split(" ")[0])
                             for c in ST.FEED_SCHEMAS["news"].split(", ")])
        early = news.where(F.col("notice_time") < F.lit("2024-01-20").cast("timestamp")).repartition(4)
        late = news.where(F.col("notice_time") >= F.lit("2024-01-15").cast("timestamp")).repartition(4)
        return early.unionByName(late)  # one file per partition, each file one re-read
    src = derived_path(spark, "feed_news_files", _inputs(sf_dir), build)
    run = f"{checkpoint_dir(spark).rstrip('/')}/streams/news-{uuid.uuid4().hex}"
    ST.ingest(spark, "news", src, f"{run}/corpus", checkpoint=f"{run}/checkpoint",
              max_files_per_trigger=2).awaitTermination()
    out = spark.read.parquet(f"{run}/corpus").drop("load", "day")
    return out.withColumn("feed_type", F.col("feed_type").cast("double"))


def feed_streams_ingest(spark, sf_dir):
    """2.12 over all three feeds: each delivered as overlapping re-reads (as in
    `feed_stream_ingest`) and streamed into the one day-partitioned corpus.
    Every document of every feed is stored exactly once."""
    run = f"{checkpoint_dir(spark).rstrip('/')}/streams/feeds-{uuid.uuid4().hex}"
    files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)  # a re-read; four batches a feed
    for (feed, schema), rows in zip(ST.FEED_SCHEMAS.items(), feeds(spark, sf_dir)):
        fields = [f.split(" ") for f in schema.split(", ")]
        time = "publish_time" if feed == "micro" else "notice_time"

        def build():
            all_ = rows.select(*[F.col(c).cast(kind).alias(c) for c, kind in fields])  # noqa: B023
            early = all_.where(F.col(time) < F.lit("2024-01-20").cast("timestamp")).repartition(files, fields[0][0])  # noqa: B023
            late = all_.where(F.col(time) >= F.lit("2024-01-15").cast("timestamp")).repartition(files, fields[0][0])  # noqa: B023
            return early.unionByName(late)  # one file per partition, each file one re-read
        src = derived_path(spark, f"feed_{feed}_rereads", _inputs(sf_dir), build, params=f"{files} files")
        ST.ingest(spark, feed, src, f"{run}/corpus", checkpoint=f"{run}/checkpoint-{feed}",
                  max_files_per_trigger=files // 2).awaitTermination()
    out = spark.read.parquet(f"{run}/corpus").drop("load", "day")
    return out.withColumn("feed_type", F.col("feed_type").cast("double"))


def _index(spark, sf_dir, keep=()):
    docs = corpus(spark, sf_dir)
    dt = content_terms(spark, sf_dir, keep=keep)
    return docs, dt, T.term_stats(dt), T.doc_count(docs)


def hot_terms(spark, sf_dir):
    docs, dt, _, n = _index(spark, sf_dir)
    w = H.hot_term_weights(dt, None, n, stop_words=_words(spark, HOT_STOP_WORDS))
    return w.select("term", r6("weight").alias("weight"))


def hot_terms_pre(spark, sf_dir):
    docs, dt, cs, n = _index(spark, sf_dir)
    w = H.hot_term_weights_pre(dt, cs, n, n, stop_words=_words(spark, HOT_STOP_WORDS))
    return w.select("term", r6("weight").alias("weight"))


def tfpdf_terms(spark, sf_dir):
    docs, dt, cs, n = _index(spark, sf_dir, keep=("source",))
    channels = docs.groupBy(F.col("source").alias("channel")).agg(F.count(F.lit(1)).alias("n_docs"))
    w = H.tfpdf_weights(dt.withColumnRenamed("source", "channel"), channels, cs, n)
    return w.select("term", r6("weight").alias("weight"))


def tfpdf_docs(spark, sf_dir):
    docs, dt, cs, n = _index(spark, sf_dir, keep=("source",))
    channels = docs.groupBy(F.col("source").alias("channel")).agg(F.count(F.lit(1)).alias("n_docs"))
    w = H.tfpdf_weights(dt.withColumnRenamed("source", "channel"), channels, cs, n)
    return H.doc_scores(dt, w, docs).select("doc_id", r6("score").alias("score"))


def tfpdf_ranked(spark, sf_dir):
    """T4: the documents by TF-PDF score, with their position."""
    ranked = H.ranked_documents(tfpdf_docs(spark, sf_dir))
    return ranked.select("doc_id", "score", "position")


def tfpdf_daily(spark, sf_dir):
    """A5 with its look-back: TF-PDF over the ten days that end with each day."""
    docs = corpus(spark, sf_dir).select("doc_id", F.to_date("notice_time").alias("day"), F.col("source").alias("channel"))
    dt = content_terms(spark, sf_dir, keep=("source",)).select("doc_id", "term", "tf", F.col("source").alias("channel"))
    dt = dt.join(docs.select("doc_id", "day"), "doc_id")
    w = H.tfpdf_daily(dt, docs)
    return w.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "term", r6("weight").alias("weight"))


def hot_history_log(spark, sf_dir):
    """The history as a log: the periods up to a date, then all
    (only newer ones are taken), then the last day again as a later load with
    doubled weights; the ten newest periods as a reader finds them."""
    def build(path):
        log, rows = H.HistoryLog(spark, path), history(spark, sf_dir)
        log.append(rows.where(F.col("period_end") < F.lit(LOG_UNTIL).cast("timestamp")))
        log.append(rows)
        log.append(rows.where(F.col("period_end") >= F.lit(LOG_AGAIN).cast("timestamp")).withColumn("weight", 2 * F.col("weight")), again=True)
    log = H.HistoryLog(spark, derived_folder(spark, "history-log", _inputs(sf_dir), build))
    return log.read(newest=10).select("period_end", "term", r6("weight").alias("weight"))


def key_terms(spark, sf_dir):
    """The 100 best key terms (Bo1) of every source."""
    _, dt, cs, n = _index(spark, sf_dir, keep=("source",))
    return T.key_terms(T.term_stats(dt, ["source"]), cs, n, 100, ["source"])


def distinctive_terms(spark, sf_dir):
    """T3 corpus-wide: the 1000 most distinctive terms."""
    _, _, cs, n = _index(spark, sf_dir)
    return T.distinctive_terms(cs, n, 1000)


def key_terms_whole(spark, sf_dir):
    """T3 at the reference's size: the 10,000 best key terms of every source."""
    _, dt, cs, n = _index(spark, sf_dir, keep=("source",))
    return T.key_terms(T.term_stats(dt, ["source"]), cs, n, H.KEY_TERMS, ["source"])


def distinctive_terms_whole(spark, sf_dir):
    """T3 corpus-wide at the reference's size: the 10,000 most distinctive terms."""
    _, _, cs, n = _index(spark, sf_dir)
    return T.distinctive_terms(cs, n, H.DISTINCTIVE_TERMS)


def distinctive_terms_tfpdf(spark, sf_dir):
    """T3 corpus-wide as TF-PDF asks for it: the 100,000 most distinctive terms."""
    _, _, cs, n = _index(spark, sf_dir)
    return T.distinctive_terms(cs, n, H.TFPDF_TERMS)


def _periods(docs):
    """Every half-day period between the first and the last document."""
    p = docs.select(half_day_period_end(F.col("notice_time")).alias("period_end"))
    b = p.agg(F.min("period_end").alias("lo"), F.max("period_end").alias("hi"))
    days = b.select("lo", "hi", F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"))).alias("d"))
    ends = days.select("lo", "hi", F.explode(F.array(
        F.to_timestamp(F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit(" 09:00:00"))),
        F.to_timestamp(F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit(" 17:30:00"))))).alias("period_end"))
    return ends.where(F.col("period_end").between(F.col("lo"), F.col("hi"))).select("period_end")


def history(spark, sf_dir) -> DataFrame:
    """S13 term-weight history: A3 weights of every half-day period, the table
    the burst detector reads.  Written once per input and stop list to the
    shared folder (the reference keeps it as a history file per period)."""
    def build():
        docs = corpus(spark, sf_dir)
        dt = content_terms(spark, sf_dir, keep=("period_end",))
        return H.hot_term_weights(dt, None, T.doc_count(docs), by=("period_end",), stop_words=_words(spark, HOT_STOP_WORDS))
    params = "all terms|" + ",".join(HOT_STOP_WORDS)
    return derived_table(spark, "hot_history", _inputs(sf_dir), build, params=params)


def _burst(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    dt = content_terms(spark, sf_dir, keep=("period_end",))
    stops = _words(spark, HOT_STOP_WORDS)
    burst = H.burst_terms(history(spark, sf_dir), _periods(docs), stop_words=stops)
    return docs, dt, burst


def hot_burst(spark, sf_dir):
    _, _, b = _burst(spark, sf_dir)
    return b.select("period_end", "term", r6("weight").alias("weight"), r6("ratio").alias("ratio"), "rank")


def _hot_docs(spark, sf_dir):
    docs, dt, burst = _burst(spark, sf_dir)
    docs = C.exclude_micro_and_type2(docs)
    # scores of other documents than `docs` are not looked up: their terms need no filter.  Hot terms
    # are bounded (HOT_TERM_LIMIT a half-day period): the index stays where it is
    return H.rank_hot_documents(docs.select("period_end", "doc_id", "title", "sentiment"), dt, F.broadcast(burst),
                                white=_words(spark, WHITE_LIST, True), black=_words(spark, BLACK_LIST))


def hot_docs(spark, sf_dir):
    r = _hot_docs(spark, sf_dir)
    return r.select("period_end", "doc_id", r6("score").alias("score"), r6("hotscore").alias("hotscore"))


def hot_writeback(spark, sf_dir):
    news, _, _ = feeds(spark, sf_dir)
    out = H.hot_writeback(news.select("news_id", "title"), _hot_docs(spark, sf_dir), "N", "news_id")
    return out.select("news_id", "title", r6("hot").alias("hot"))


QUERIES = {
    "corpus_load": corpus_load,
    "feed_stream_ingest": feed_stream_ingest,
    "feed_streams_ingest": feed_streams_ingest,
    "hot_terms": hot_terms,
    "key_terms": key_terms,
    "distinctive_terms": distinctive_terms,
    "key_terms_whole": key_terms_whole,
    "distinctive_terms_whole": distinctive_terms_whole,
    "distinctive_terms_tfpdf": distinctive_terms_tfpdf,
    "hot_terms_pre": hot_terms_pre,
    "tfpdf_terms": tfpdf_terms,
    "tfpdf_docs": tfpdf_docs,
    "tfpdf_ranked": tfpdf_ranked,
    "tfpdf_daily": tfpdf_daily,
    "hot_history_log": hot_history_log,
    "hot_burst": hot_burst,
    "hot_docs": hot_docs,
    "hot_writeback": hot_writeback,
}


# ---------------------------------------------------------------- oracle SQL

def _list(words):
    return ", ".join("('" + w + "')" for w in words)


FEEDS_SQL = """
base AS (SELECT d.doc_id AS nid, d.text, d.lang, d.source, l.quality, l.toxic,
                TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(12 * (d.doc_id % 60) AS BIGINT)) AS notice_time,
                split_part(d.text, chr(10), 1) AS title
         FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
docs_all AS (
  SELECT 'N' || CAST(nid AS VARCHAR) AS doc_id, 1 AS platform, title, CAST(NULL AS VARCHAR) AS url, text AS content,
         notice_time, source, CASE WHEN quality = 1 THEN 1 WHEN quality = 0 THEN 2 END AS feed_type,
         coalesce(CAST(toxic AS DOUBLE), 0.0) AS sentiment, CAST(NULL AS VARCHAR) AS location,
         source || '+:' AS main_body, CAST(NULL AS VARCHAR) AS product_info, CAST(NULL AS VARCHAR) AS nick_name,
         CAST(NULL AS VARCHAR) AS keyword
  FROM base WHERE lang = 'en'
  UNION ALL
  SELECT 'W' || CAST(nid AS VARCHAR), 2, title, NULL, text, notice_time, source, NULL, 0.0, NULL, NULL, NULL, NULL, NULL
  FROM base WHERE lang IN ('fr', 'de')
  UNION ALL
  SELECT 'B' || CAST(nid AS VARCHAR), 3, NULL, NULL, text, notice_time, NULL, NULL, NULL, NULL, NULL, NULL, source, NULL
  FROM base WHERE lang = 'es')"""


def _tok(x):
    return f"list_filter(string_split_regex({x}, '{TOKEN_SPLIT}'), lambda t: t <> '')"


INDEX_SQL = FEEDS_SQL + f""",
docs AS (SELECT * FROM docs_all WHERE notice_time BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-12-31 23:59:59'),
toks AS (SELECT doc_id, source, {_tok('lower(content)')} AS tk FROM docs),
dt AS (SELECT doc_id, source, len(tk) AS doc_len, term, count(*) AS tf
       FROM (SELECT doc_id, source, tk, unnest(tk) AS term FROM toks) GROUP BY ALL),
ncorp AS (SELECT count(*) AS n FROM docs),
cs AS (SELECT term, count(*) AS df, sum(tf) AS cf, sum(sqrt(tf / doc_len)) AS s FROM dt GROUP BY term),
stops AS (SELECT * FROM (VALUES {_list(HOT_STOP_WORDS)}) s(word))"""


def _filters(alias):
    return (f"NOT regexp_matches({alias}.term, '{NUMBER_PATTERN}') "
            f"AND NOT EXISTS (SELECT 1 FROM stops WHERE stops.word <> '' AND instr(stops.word, {alias}.term) > 0)")


BO1 = "(cf_set * log2((1 + cf / ncorp.n) / (cf / ncorp.n)) + log2(1 + cf / ncorp.n))"

HOT_TERMS_SQL = "WITH " + INDEX_SQL + f""",
nwin AS (SELECT count(DISTINCT doc_id) AS n FROM dt),
keys AS (SELECT term FROM cs),
w AS (SELECT cs.term, s * (ln(ncorp.n / (df + 1)) + 1) * (df / nwin.n) / nwin.n AS weight
      FROM cs, ncorp, nwin WHERE cs.term IN (SELECT term FROM keys))
SELECT w.term, round(w.weight, 6) + 0.0 AS weight FROM w WHERE w.weight > 0 AND {_filters('w')}"""

KEY_TERMS_SQL = "WITH " + INDEX_SQL + f""",
ws AS (SELECT source, term, sum(tf) AS cf_set FROM dt GROUP BY 1, 2),
keyed AS (SELECT source, ws.term, row_number() OVER (PARTITION BY source ORDER BY {BO1} DESC, ws.term DESC) AS krk
          FROM ws JOIN cs ON cs.term = ws.term, ncorp)
SELECT source, term FROM keyed WHERE krk <= 100"""

DISTINCTIVE_TERMS_SQL = "WITH " + INDEX_SQL + """
SELECT term FROM cs, ncorp ORDER BY cf * ln(ncorp.n / df) DESC, term DESC LIMIT 1000"""

KEY_TERMS_WHOLE_SQL = "WITH " + INDEX_SQL + f""",
ws AS (SELECT source, term, sum(tf) AS cf_set FROM dt GROUP BY 1, 2),
keyed AS (SELECT source, ws.term, row_number() OVER (PARTITION BY source ORDER BY {BO1} DESC, ws.term DESC) AS krk
          FROM ws JOIN cs ON cs.term = ws.term, ncorp)
SELECT source, term FROM keyed WHERE krk <= {H.KEY_TERMS}"""


def _most_distinctive(k):
    return "WITH " + INDEX_SQL + f"""
SELECT term FROM cs, ncorp ORDER BY cf * ln(ncorp.n / df) DESC, term DESC LIMIT {k}"""


HOT_TERMS_PRE_SQL = "WITH " + INDEX_SQL + f""",
chosen AS (SELECT term FROM cs),
sel AS (SELECT *, sum(tf) OVER (PARTITION BY doc_id) AS len_sel FROM dt WHERE term IN (SELECT term FROM chosen)),
agg AS (SELECT term, count(*) AS df_win, sum(sqrt(tf / len_sel)) AS s FROM sel GROUP BY term),
w AS (SELECT agg.term, agg.s * (ln(ncorp.n / (cs.df + 1)) + 1) * (agg.df_win / ncorp.n) / ncorp.n AS weight
      FROM agg JOIN cs USING (term), ncorp)
SELECT w.term, round(w.weight, 6) + 0.0 AS weight FROM w WHERE w.weight > 0 AND {_filters('w')}"""

TFPDF_SQL = INDEX_SQL + """,
chosen AS (SELECT term FROM cs),
chan AS (SELECT source AS channel, count(*) AS n_c FROM docs GROUP BY 1),
per AS (SELECT term, source AS channel, sum(tf) AS f, count(*) AS n FROM dt
        WHERE term IN (SELECT term FROM chosen) GROUP BY 1, 2),
tw AS (SELECT term, CASE WHEN sum(f * f) > 0 THEN sum(f * exp(n / n_c)) / sqrt(sum(f * f)) ELSE 0.0 END AS weight
       FROM per JOIN chan USING (channel) GROUP BY term)"""

TFPDF_TERMS_SQL = "WITH " + TFPDF_SQL + "\nSELECT term, round(weight, 6) + 0.0 AS weight FROM tw"

TFPDF_DOCS_SQL = "WITH " + TFPDF_SQL + """,
ds AS (SELECT doc_id, sum(weight) AS score FROM (SELECT DISTINCT doc_id, term FROM dt) x JOIN tw USING (term) GROUP BY 1)
SELECT docs.doc_id, round(coalesce(ds.score, 0.0), 6) + 0.0 AS score FROM docs LEFT JOIN ds USING (doc_id)"""

TFPDF_RANKED_SQL = f"SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) - 1 AS position FROM ({TFPDF_DOCS_SQL})"

TFPDF_DAILY_SQL = "WITH " + INDEX_SQL + f""",
dd AS (SELECT doc_id, source, CAST(notice_time AS DATE) AS day FROM docs),
spans AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS upto FROM dd),
chan AS (SELECT upto, source, count(*) AS n_c FROM dd JOIN spans ON day BETWEEN upto - {H.TFPDF_DAYS - 1} AND upto GROUP BY 1, 2),
daily AS (SELECT term, dt.source, day, sum(tf) AS f, count(*) AS n FROM dt JOIN dd USING (doc_id) GROUP BY ALL),
per AS (SELECT upto, term, source, sum(f) AS f, sum(n) AS n FROM daily JOIN spans ON day BETWEEN upto - {H.TFPDF_DAYS - 1} AND upto GROUP BY 1, 2, 3)
SELECT strftime(upto, '%Y-%m-%d') AS day, term, round(sum(f * exp(n / n_c)) / sqrt(sum(f * f)), 6) + 0.0 AS weight
FROM per JOIN chan USING (upto, source) GROUP BY 1, 2"""

PERIOD = """CASE WHEN CAST({t} AS TIME) <= TIME '09:00:00' THEN CAST({t} AS DATE) + INTERVAL 9 HOUR
            WHEN CAST({t} AS TIME) <= TIME '17:30:00' THEN CAST({t} AS DATE) + INTERVAL 17 HOUR + INTERVAL 30 MINUTE
            ELSE CAST({t} AS DATE) + INTERVAL 1 DAY + INTERVAL 9 HOUR END"""

BURST_SQL = FEEDS_SQL + f""",
docs AS (SELECT *, {PERIOD.format(t='notice_time')} AS period_end FROM docs_all
         WHERE notice_time BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-12-31 23:59:59'),
toks AS (SELECT doc_id, period_end, {_tok('lower(content)')} AS tk FROM docs),
dt AS (SELECT doc_id, period_end, len(tk) AS doc_len, term, count(*) AS tf
       FROM (SELECT doc_id, period_end, tk, unnest(tk) AS term FROM toks) GROUP BY ALL),
ncorp AS (SELECT count(*) AS n FROM docs),
cs AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM dt GROUP BY term),
stops AS (SELECT * FROM (VALUES {_list(HOT_STOP_WORDS)}) s(word)),
ws AS (SELECT period_end, term, count(*) AS df_p, sum(tf) AS cf_set, sum(sqrt(tf / doc_len)) AS s FROM dt GROUP BY 1, 2),
nwin AS (SELECT period_end, count(DISTINCT doc_id) AS n_win FROM dt GROUP BY 1),
keyed AS (SELECT ws.*, cs.df, cs.cf
          FROM ws JOIN cs USING (term), ncorp),
hist AS (SELECT keyed.period_end, keyed.term,
                keyed.s * (ln(ncorp.n / (keyed.df + 1)) + 1) * (keyed.df_p / nwin.n_win) / nwin.n_win AS weight
         FROM keyed JOIN nwin USING (period_end), ncorp),
hist_f AS (SELECT * FROM hist WHERE weight > 0 AND {_filters('hist')}),
bounds AS (SELECT min(period_end) AS lo, max(period_end) AS hi FROM docs),
cal AS (SELECT p AS period_end FROM (
          SELECT unnest([CAST(d AS DATE) + INTERVAL 9 HOUR, CAST(d AS DATE) + INTERVAL 17 HOUR + INTERVAL 30 MINUTE]) AS p
          FROM bounds, (SELECT unnest(generate_series(CAST((SELECT lo FROM bounds) AS DATE),
                                                      CAST((SELECT hi FROM bounds) AS DATE), INTERVAL 1 DAY)) AS d)) x, bounds
        WHERE p BETWEEN lo AND hi),
pidx AS (SELECT period_end, row_number() OVER (ORDER BY period_end) - 1 AS p_idx FROM cal),
h AS (SELECT period_end, term, CAST(round(weight * 1e6) AS BIGINT) AS wm, p_idx FROM hist_f JOIN pidx USING (period_end)),
hw AS (SELECT *, coalesce(sum(CASE WHEN wm > 0 THEN wm END) OVER w, 0) AS past_sum,
              count(CASE WHEN wm <= 0 THEN 1 END) OVER w AS past_nonpos, least(p_idx, 30) AS n_past
       FROM h WINDOW w AS (PARTITION BY term ORDER BY p_idx RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING)),
rt AS (SELECT period_end, term, wm / 1e6 AS weight,
              CASE WHEN n_past - past_nonpos = 0 AND wm <> 0 THEN 3.0
                   WHEN wm = 0 THEN 0.0
                   WHEN past_sum = 0 THEN 3.0
                   ELSE CAST(wm AS DOUBLE) * (n_past - past_nonpos) / past_sum END AS ratio
       FROM hw),
rk AS (SELECT *, row_number() OVER (PARTITION BY period_end ORDER BY ratio DESC, term ASC) AS rank
       FROM rt WHERE {_filters('rt')}),
burst AS (SELECT * FROM rk WHERE rank <= 100)"""

HOT_BURST_SQL = "WITH " + BURST_SQL + """
SELECT period_end, term, round(weight, 6) + 0.0 AS weight, round(ratio, 6) + 0.0 AS ratio, rank FROM burst"""

HISTORY_LOG_SQL = "WITH " + BURST_SQL + f"""
SELECT period_end, term, round(weight * CASE WHEN period_end >= TIMESTAMP '{LOG_AGAIN}' THEN 2 ELSE 1 END, 6) + 0.0 AS weight
FROM hist_f WHERE period_end IN (SELECT DISTINCT period_end FROM hist_f ORDER BY period_end DESC LIMIT 10)"""

HOT_DOCS_BODY = BURST_SQL + f""",
hd AS (SELECT * FROM docs WHERE NOT (coalesce(platform = 3, false) OR coalesce(feed_type = 2, false))),
hs AS (SELECT doc_id, period_end, sum(ratio) AS hs
       FROM (SELECT DISTINCT dt.period_end, dt.doc_id, dt.term FROM dt WHERE dt.tf > 0
             AND dt.doc_id IN (SELECT doc_id FROM hd)) x
       JOIN burst USING (period_end, term) GROUP BY 1, 2),
hot AS (SELECT hd.period_end, hd.doc_id, hd.title, hd.sentiment, coalesce(hs.hs, 0.0) AS hotscore
        FROM hd LEFT JOIN hs USING (period_end, doc_id)),
mx AS (SELECT period_end, max(hotscore) AS m FROM hot GROUP BY 1),
white AS (SELECT * FROM (VALUES {", ".join(f"('{w}', {('NULL' if s is None else s)})" for w, s in WHITE_LIST)}) t(word, score)),
black AS (SELECT * FROM (VALUES {_list(BLACK_LIST)}) t(word)),
wsc AS (SELECT hot.doc_id, max(coalesce(white.score, 2.0)) AS ws FROM hot JOIN white
        ON white.word <> '' AND instr(hot.title, white.word) > 0 GROUP BY 1),
bl AS (SELECT DISTINCT hot.doc_id FROM hot JOIN black ON black.word <> '' AND instr(hot.title, black.word) > 0),
ranked AS (
  SELECT hot.period_end, hot.doc_id, hot.hotscore,
         CASE WHEN bl.doc_id IS NOT NULL THEN -1.0
              WHEN coalesce(wsc.ws, 0.0) <> 0 THEN wsc.ws
              ELSE hot.hotscore / (CASE WHEN mx.m = 0 THEN 1.0 ELSE mx.m END) + coalesce(hot.sentiment, 0.0) END AS score
  FROM hot JOIN mx USING (period_end) LEFT JOIN wsc USING (doc_id) LEFT JOIN bl USING (doc_id))"""

HOT_DOCS_SQL = "WITH " + HOT_DOCS_BODY + """
SELECT period_end, doc_id, round(score, 6) + 0.0 AS score, round(hotscore, 6) + 0.0 AS hotscore FROM ranked"""

HOT_WRITEBACK_SQL = "WITH " + HOT_DOCS_BODY + """
SELECT CAST(substr(b.doc_id, 2) AS BIGINT) AS news_id, b.title, round(r.score, 6) + 0.0 AS hot
FROM docs_all b LEFT JOIN ranked r ON r.doc_id = b.doc_id WHERE b.platform = 1"""

CORPUS_LOAD_SQL = "WITH " + FEEDS_SQL + f"""
SELECT * REPLACE (CAST(feed_type AS DOUBLE) AS feed_type) FROM docs_all
WHERE notice_time BETWEEN TIMESTAMP '{LOAD_START}' AND TIMESTAMP '{LOAD_END}'
  AND doc_id NOT IN (SELECT doc_id FROM docs_all
                     WHERE notice_time BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '{LOADED_BEFORE}')"""

FEED_STREAM_SQL = "WITH " + FEEDS_SQL + """
SELECT * REPLACE (CAST(feed_type AS DOUBLE) AS feed_type) FROM docs_all WHERE platform = 1"""

FEED_STREAMS_SQL = "WITH " + FEEDS_SQL + """
SELECT * REPLACE (CAST(feed_type AS DOUBLE) AS feed_type) FROM docs_all"""

ORACLE = {
    "corpus_load": CORPUS_LOAD_SQL,
    "feed_stream_ingest": FEED_STREAM_SQL,
    "feed_streams_ingest": FEED_STREAMS_SQL,
    "hot_terms": HOT_TERMS_SQL,
    "key_terms": KEY_TERMS_SQL,
    "distinctive_terms": DISTINCTIVE_TERMS_SQL,
    "key_terms_whole": KEY_TERMS_WHOLE_SQL,
    "distinctive_terms_whole": _most_distinctive(H.DISTINCTIVE_TERMS),
    "distinctive_terms_tfpdf": _most_distinctive(H.TFPDF_TERMS),
    "hot_terms_pre": HOT_TERMS_PRE_SQL,
    "tfpdf_terms": TFPDF_TERMS_SQL,
    "tfpdf_docs": TFPDF_DOCS_SQL,
    "tfpdf_ranked": TFPDF_RANKED_SQL,
    "tfpdf_daily": TFPDF_DAILY_SQL,
    "hot_history_log": HISTORY_LOG_SQL,
    "hot_burst": HOT_BURST_SQL,
    "hot_docs": HOT_DOCS_SQL,
    "hot_writeback": HOT_WRITEBACK_SQL,
}
