"""Search, per-user relevance and user vocabulary queries on the driver tables.

Bindings (besides the corpus of `plans.text`):
  users              events.user_id (P12: not NULL, uid < 9800 for the vocabulary)
  keywords           every token of the items a user purchased (events.props k =
                     benchmark.item_id), stop words excluded
  analyser           relevance drops the stop words below (X4); the search index none
  institutions       part: id = p_partkey, short = first word of p_name, full = p_name
  bonds              part: id = p_partkey, short = p_type, full = p_name || ' ' || p_type
  user x institution click events (props k = p_partkey)
  user name          'user_' || floor(uid / 2)  (two uids share a name: A21)
  short-name filter  P11 list below
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import TOKEN_SPLIT, tokens
from tessera.operators import search as S
from tessera.operators.index import SegmentedIndex
from tessera.operators import terms as T
from tessera.plans.common import r6, tables
from tessera.plans.text import FEEDS_SQL, _inputs, corpus
from tessera.sources.snapshot import BucketedTable
from tessera.sources.store import derived_folder, derived_table

# Parameters of the bound queries.
# Analyser stop list (X4) of user relevance: common function words of the corpus
# languages.  The search index keeps every word.
SEARCH_STOP_WORDS = ["the", "and", "of", "to", "a", "in", "is", "it", "that", "was", "for", "on", "are",
                     "as", "with", "by", "this", "be", "at", "an", "or", "from",
                     "le", "la", "les", "de", "des", "du", "et", "en", "un", "une", "que", "qui", "pour",
                     "der", "die", "das", "und", "zu", "den", "mit", "von", "ein", "eine", "ist", "nicht",
                     "el", "los", "las", "y", "por", "con", "para", "del", "se"]
SHORT_NAME_FILTER = ["small"]
NAME_STOP_WORDS = ["有限公司", "公司", "有限责任"]
WINDOW = ("2024-01-01 00:00:00", "2024-01-31 00:00:00")
PRIOR_END = "2024-01-16 00:00:00"

FIELDS = {"content": "content", "title": "title"}
DAILY_FROM = "2024-01-25 00:00:00"  # days from here on are added to the index
LOADS = ["2024-01-01 00:00:00", "2024-01-20 00:00:00", "2024-01-26 12:00:00", "2025-01-01 00:00:00"]
VIEWED, VIEWED_AT = 500, "2023-12-31 00:00:00"
PAGE = 100  # hits of an ad-hoc search

QUERY_BOOL = S.AndMaybe(S.AndNot(S.And(S.Term("that"), S.Or(S.Term("the"), S.Term("der"))),
                                 S.Term("rewh", field="title")), S.Term("and"))
QUERY_PREFIX = S.Or(S.Prefix("thatin"), S.Wildcard("th?n*"))
QUERY_FUZZY = S.Fuzzy("orantion", 2)
QUERY_FUZZY_NEAR = S.Or(S.Fuzzy("the", 1), S.Fuzzy("und", 1, field="title"))
QUERY_FUZZY_FAR = S.AndNot(S.Fuzzy("orantion", 3), S.Fuzzy("tion", 1))
QUERY_WILD = S.Or(S.And(S.Wildcard("*ntion"), S.Wildcard("e*th")), S.Or(S.Wildcard("?ent*le?"), S.Wildcard("*chtsch*")))
QUERY_RANGE = S.And(S.Range("notice_time", "2024-01-05 00:00:00", "2024-01-20 00:00:00"),
                    S.And(S.Range("sentiment", 1.0, None), S.Term("the")))
QUERY_BOOST = S.Or(S.Term("the", boost=2.0), S.Term("de", field="title", boost=1.5))


def index(spark, sf_dir, stop_words=None) -> SegmentedIndex:
    """The segmented index of the corpus (content and title): one segment of
    the days before `DAILY_FROM`, one of the later ones added to it."""
    def build(path):
        docs = corpus(spark, sf_dir)
        first = F.col("notice_time") < F.lit(DAILY_FROM).cast("timestamp")
        for some in (docs.where(first), docs.where(~first)):
            SegmentedIndex(spark, path).add(some, FIELDS, stop_words=stop_words, lookups=stop_words is None)
    path = derived_folder(spark, "index", _inputs(sf_dir), build, params=",".join(stop_words or []))
    return SegmentedIndex(spark, path)


def _search(query, limit=None, made=index):
    def run(spark, sf_dir):
        docs = corpus(spark, sf_dir).select("doc_id", "notice_time", "sentiment", "platform")
        hits = made(spark, sf_dir).search(docs, query, limit=limit)
        return hits.select("doc_id", r6("score").alias("score"), *(["rank"] if limit else []))
    return run


def merged_index(spark, sf_dir) -> SegmentedIndex:
    """The index grown day by day (three loads) and merged."""
    def build(path):
        docs, grown = corpus(spark, sf_dir), SegmentedIndex(spark, path)
        for low, high in zip(LOADS, LOADS[1:]):
            grown.add(docs.where((F.col("notice_time") >= F.lit(low).cast("timestamp")) & (F.col("notice_time") < F.lit(high).cast("timestamp"))), FIELDS)
        grown.merge()
    return SegmentedIndex(spark, derived_folder(spark, "merged-index", _inputs(sf_dir), build))


def _links(spark, sf_dir):
    t = tables(spark, sf_dir)
    ev = t.events.where(F.col("user_id").isNotNull()).select(
        F.col("user_id").alias("uid"), "event_type",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    part = t.part.select("p_partkey", "p_name", "p_type")
    item_kw = t.benchmark.select("item_id", F.explode(F.array_distinct(
        tokens(F.col("text"), stop_words=SEARCH_STOP_WORDS))).alias("keyword"))
    kw = (ev.where(F.col("event_type") == "purchase").select("uid", F.col("k").alias("item_id")).distinct()
            .join(item_kw, "item_id").select("uid", "keyword").distinct())
    clicks = ev.where(F.col("event_type") == "click").select("uid", F.col("k").alias("institutionid")).distinct()
    company = part.select(F.col("p_partkey").alias("institutionid"),
                          F.split_part("p_name", F.lit(" "), F.lit(1)).alias("shortname"),
                          F.col("p_name").alias("fullname"))
    bond = part.select(F.col("p_partkey").alias("institutionid"), F.col("p_type").alias("shortname"),
                       F.concat_ws(" ", "p_name", "p_type").alias("fullname"))
    return kw, clicks, company, bond


def _interests(spark, sf_dir):
    # The user's institutions joined with company and bond names
    kw, clicks, company, bond = _links(spark, sf_dir)
    cs = clicks.join(company, "institutionid").select("uid", F.col("shortname").alias("name"))
    cf = clicks.join(company, "institutionid").select("uid", F.col("fullname").alias("name"))
    bs = clicks.join(bond, "institutionid").select("uid", F.col("shortname").alias("name"))
    filt = spark.createDataFrame([(w,) for w in SHORT_NAME_FILTER], "word string")
    return S.user_interests(kw, cs, cf, bs, short_name_filter=filt, stop_words=SEARCH_STOP_WORDS, whole=True)


def _relevance(spark, sf_dir, platform):
    docs = corpus(spark, sf_dir)
    held = index(spark, sf_dir, SEARCH_STOP_WORDS)
    content = F.col("field") == "content"
    dt = held.postings().where(content).select("doc_id", "term", "tf", "doc_len")
    window = docs.where(F.col("notice_time").between(F.lit(WINDOW[0]).cast("timestamp"),
                                                     F.lit(WINDOW[1]).cast("timestamp"))
                        & (F.col("platform") == platform))
    r = S.user_relevance(window.select("doc_id", "notice_time", "platform", "sentiment"), dt,
                         _interests(spark, sf_dir), terms=held.terms().where(content), n_docs=docs.count(), total_len=held.length("content"), separator=" ")
    return r.select("uid", "notice_time", "doc_id", "source_flag", r6("score").alias("score"),
                    "sentiment", "matched_terms", "rank")


def user_relevance(spark, sf_dir):
    """Written once per input to the shared folder: `correlation_append` reads
    it twice."""
    paths = sorted({*_inputs(sf_dir), *(f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("events", "benchmark", "part"))})
    return derived_table(spark, "user_relevance", paths, lambda: _relevance(spark, sf_dir, 1))


def user_relevance_micro(spark, sf_dir):
    return _relevance(spark, sf_dir, 3)


def correlation_append(spark, sf_dir):
    new = user_relevance(spark, sf_dir).where(F.col("doc_id").startswith("N"))
    rows = new.select("uid", "notice_time", F.substring("doc_id", 2, 1 << 30).cast("bigint").alias("news_id"),
                      "source_flag", "score", F.col("sentiment").alias("neg_sentiment"))
    existing = rows.where(F.col("notice_time") < F.lit(PRIOR_END).cast("timestamp"))
    return S.insert_if_absent(existing, rows)


def correlation_existing(spark, sf_dir):
    """J18 into a stored table with rows of its own (from the view events),
    some of whose keys the new rows have too; the batch is delivered twice."""
    keys = ["uid", "news_id", "source_flag"]
    paths = sorted({*_inputs(sf_dir), *(f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("events", "benchmark", "part"))})

    def build(path):
        t = tables(spark, sf_dir)
        before = t.events.where((F.col("event_type") == "view") & F.col("user_id").isNotNull()).select(
            F.col("user_id").alias("uid"), (F.col("event_id") % VIEWED).alias("news_id"), F.lit(1).alias("source_flag")).distinct()
        table = BucketedTable(spark, path, keys)
        table.create(before.select(F.lit(VIEWED_AT).cast("timestamp").alias("notice_time"), *keys, F.lit(-1.0).alias("score"), F.lit(0.0).alias("neg_sentiment")))
        new = user_relevance(spark, sf_dir).where(F.col("doc_id").startswith("N")).select(
            "notice_time", "uid", F.substring("doc_id", 2, 1 << 30).cast("bigint").alias("news_id"), F.col("source_flag").cast("int").alias("source_flag"),
            "score", F.col("sentiment").alias("neg_sentiment"))
        for _ in range(2):
            table.merge(new, lambda old, rows: old.unionByName(S.insert_if_absent(old, rows, keys)), "relevance")
    return BucketedTable(spark, derived_folder(spark, "correlation-table", paths, build), keys).read().select(*keys, "notice_time", "score", "neg_sentiment")


def name_dictionary(spark, sf_dir):
    """Distinct bond short names, then distinct company short names;
    names present in both lists appear twice."""
    _, _, company, bond = _links(spark, sf_dir)
    b = bond.select(F.trim("shortname").alias("name")).where(F.col("name").isNotNull()).distinct() \
        .withColumn("list", F.lit("bond"))
    c = company.select(F.trim("shortname").alias("name")).where(F.col("name").isNotNull()).distinct() \
        .withColumn("list", F.lit("company"))
    return b.unionByName(c).select("list", "name")


def _cut(col):
    """X4 + X5 for names: tokens without the name stop words, space-joined."""
    return F.array_join(F.filter(tokens(col), lambda x: ~x.isin(*NAME_STOP_WORDS)), " ")


def user_vocabulary(spark, sf_dir):
    """X17 + J6 + J22 + A21 + P12: one line per user name (its first uid)."""
    kw, clicks, company, bond = _links(spark, sf_dir)
    users = (kw.select("uid").unionByName(clicks.select("uid")).distinct()
               .where(F.col("uid") < 9800)
               .withColumn("user_name", F.concat(F.lit("user_"), F.floor(F.col("uid") / 2).cast("string"))))
    first = users.groupBy("user_name").agg(F.min("uid").alias("uid"))
    # One line per user is the S18 format itself.  The lists are built from
    # distinct (user, keyword) / (user, institution) pairs, so their length is
    # bounded by the keyword and institution tables, not by the event volume.
    kws = kw.groupBy("uid").agg(F.array_join(F.array_sort(F.collect_set("keyword")), "\t").alias("key_words"))
    comp = (clicks.join(company, "institutionid")
                  .groupBy("uid").agg(F.array_sort(F.collect_list(F.struct(
                      "institutionid", "shortname", "fullname"))).alias("c")))
    comp = comp.select("uid",
                       F.array_join(F.transform("c", lambda s: s["shortname"]), "\t").alias("short_names"),
                       F.array_join(F.transform("c", lambda s: _cut(F.concat(s["shortname"], s["fullname"]))),
                                    "\t").alias("full_names"))
    bnd = (clicks.join(bond, "institutionid")
                 .groupBy("uid").agg(F.array_sort(F.collect_list(F.struct(
                     "institutionid", "shortname", "fullname"))).alias("b")))
    bnd = bnd.select("uid",
                     F.array_join(F.transform("b", lambda s: s["shortname"]), "\t").alias("bond_short_names"),
                     F.array_join(F.transform("b", lambda s: _cut(s["fullname"])), "\t").alias("bond_full_names"))
    out = first.join(kws, "uid", "left").join(comp, "uid", "left").join(bnd, "uid", "left")
    cols = ["key_words", "short_names", "bond_short_names", "full_names", "bond_full_names"]
    out = out.select("user_name", "uid", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols])
    return out.withColumn("line", F.concat_ws("||", "user_name", *cols))  # S18 text form


def top_tags(spark, sf_dir):
    """Three best tags per part description by tf * idf over all parts."""
    t = tables(spark, sf_dir)
    parts = t.part.select(F.col("p_partkey").alias("doc_id"),
                          F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("content"))
    dt = T.doc_terms(parts)
    tags = T.top_tags(dt, T.term_stats(dt), T.doc_count(parts), 3)
    return tags.select("doc_id", "rank", "term", r6("score").alias("score"))


QUERIES = {
    "search_bool": _search(QUERY_BOOL),
    "search_prefix": _search(QUERY_PREFIX),
    "search_fuzzy": _search(QUERY_FUZZY),
    "search_fuzzy_near": _search(QUERY_FUZZY_NEAR),
    "search_fuzzy_far": _search(QUERY_FUZZY_FAR),
    "search_wildcard": _search(QUERY_WILD),
    "search_page": _search(QUERY_BOOL, limit=PAGE),
    "search_merged": _search(QUERY_PREFIX, made=merged_index),
    "search_range": _search(QUERY_RANGE),
    "search_boost": _search(QUERY_BOOST),
    "user_relevance": user_relevance,
    "user_relevance_micro": user_relevance_micro,
    "correlation_append": correlation_append,
    "correlation_existing": correlation_existing,
    "name_dictionary": name_dictionary,
    "user_vocabulary": user_vocabulary,
    "top_tags": top_tags,
}


# ---------------------------------------------------------------- oracle SQL

def _tok(x, stops=True):
    cond = "t <> ''"
    if stops:
        cond += " AND NOT list_contains([" + ", ".join(f"'{w}'" for w in SEARCH_STOP_WORDS) + "], t)"
    return f"list_filter(string_split_regex(lower({x}), '{TOKEN_SPLIT}'), lambda t: {cond})"


FIELDS_SQL = FEEDS_SQL + f""",
docs AS (SELECT * FROM docs_all WHERE notice_time BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-12-31 23:59:59'),
toks AS (SELECT doc_id, 'content' AS field, {_tok('content', False)} AS tk FROM docs
         UNION ALL SELECT doc_id, 'title', {_tok('title', False)} FROM docs WHERE title IS NOT NULL),
dt AS (SELECT doc_id, field, len(tk) AS doc_len, term, count(*) AS tf
       FROM (SELECT doc_id, field, tk, unnest(tk) AS term FROM toks) GROUP BY ALL),
ndocs AS (SELECT count(DISTINCT doc_id) AS n FROM dt),
flen AS (SELECT field, sum(doc_len) AS total FROM (SELECT DISTINCT field, doc_id, doc_len FROM dt) GROUP BY 1),
dfs AS (SELECT field, term, count(*) AS df FROM dt GROUP BY 1, 2)"""

BM25_SQL = ("(ln(ndocs.n / (dfs.df + 1)) + 1) * dt.tf * 2.2 / "
            "(dt.tf + 1.2 * (0.25 + 0.75 * dt.doc_len / (flen.total / ndocs.n)))")


def _leaf_cond(leaf):
    if isinstance(leaf, S.Term):
        return f"dt.term = '{leaf.term}'"
    if isinstance(leaf, S.Prefix):
        return f"starts_with(dt.term, '{leaf.prefix}')"
    if isinstance(leaf, S.Wildcard):
        return f"dt.term LIKE '{leaf.pattern.replace('*', '%').replace('?', '_')}'"
    # DuckDB's levenshtein counts bytes; against an ASCII query term every
    # non-ASCII character is simply "different", so one placeholder byte per
    # character keeps the character distance.
    assert leaf.term.isascii()
    return (f"levenshtein(regexp_replace(dt.term, '[^\\x00-\\x7F]', '#', 'g'), '{leaf.term}') "
            f"<= {leaf.distance}")


def _search_sql(query, exact=False):
    leaves = S._leaves(query, [])
    ctes, joins = [], []
    for i, leaf in enumerate(leaves):
        if isinstance(leaf, S.Range) or leaves.index(leaf) != i:
            continue
        fb = S.FIELD_BOOSTS.get(leaf.field, 1.0)
        ctes.append(f"""s{i} AS (SELECT dt.doc_id, sum({leaf.boost} * {fb} * {BM25_SQL}) AS s
  FROM dt JOIN dfs USING (field, term) JOIN flen USING (field), ndocs
  WHERE dt.field = '{leaf.field}' AND {_leaf_cond(leaf)} GROUP BY 1)""")
        joins.append(f"LEFT JOIN s{i} ON s{i}.doc_id = docs.doc_id")

    def b(q):
        if isinstance(q, S.Range):
            c = []
            if q.low is not None:
                lo = f"TIMESTAMP '{q.low}'" if isinstance(q.low, str) else q.low
                c.append(f"docs.{q.column} >= {lo}")
            if q.high is not None:
                hi = f"TIMESTAMP '{q.high}'" if isinstance(q.high, str) else q.high
                c.append(f"docs.{q.column} <= {hi}")
            return f"coalesce({' AND '.join(c)}, false)", "0.0"
        if isinstance(q, S._TERM_LEAVES):
            i = leaves.index(q)
            return f"(s{i}.s IS NOT NULL)", f"coalesce(s{i}.s, 0.0)"
        lm, ls = b(q.left)
        rm, rs = b(q.right)
        if isinstance(q, S.And):
            return f"({lm} AND {rm})", f"({ls} + {rs})"
        if isinstance(q, S.Or):
            return (f"({lm} OR {rm})",
                    f"(CASE WHEN {lm} THEN {ls} ELSE 0.0 END + CASE WHEN {rm} THEN {rs} ELSE 0.0 END)")
        if isinstance(q, S.AndNot):
            return f"({lm} AND NOT {rm})", ls
        return lm, f"({ls} + CASE WHEN {rm} THEN {rs} ELSE 0.0 END)"

    m, sc = b(query)
    return ("WITH " + FIELDS_SQL + ",\n" + ",\n".join(ctes) +
            f"\nSELECT docs.doc_id, {f'round(abs({sc}), 9) AS exact, ' if exact else ''}round(abs({sc}), 6) + 0.0 AS score FROM docs {' '.join(joins)} WHERE {m}")


LINKS_SQL = f"""
ev AS (SELECT user_id AS uid, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
       FROM events WHERE user_id IS NOT NULL),
item_kw AS (SELECT item_id, unnest({_tok('text')}) AS keyword FROM benchmark),
kw AS (SELECT DISTINCT uid, keyword FROM ev JOIN item_kw b ON ev.k = b.item_id WHERE ev.event_type = 'purchase'),
clicks AS (SELECT DISTINCT uid, k AS institutionid FROM ev WHERE event_type = 'click'),
company AS (SELECT p_partkey AS institutionid, split_part(p_name, ' ', 1) AS shortname, p_name AS fullname FROM part),
bond AS (SELECT p_partkey AS institutionid, p_type AS shortname, concat_ws(' ', p_name, p_type) AS fullname FROM part)"""


def _relevance_sql(platform: int) -> str:
    filt = ", ".join(f"('{w}')" for w in SHORT_NAME_FILTER)
    return "WITH " + FEEDS_SQL + f""",
docs AS (SELECT * FROM docs_all WHERE notice_time BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-12-31 23:59:59'),
toks AS (SELECT doc_id, {_tok('content')} AS tk FROM docs),
dt AS (SELECT doc_id, len(tk) AS doc_len, term, count(*) AS tf
       FROM (SELECT doc_id, tk, unnest(tk) AS term FROM toks) GROUP BY ALL),
ndocs AS (SELECT count(*) AS n FROM docs),
flen AS (SELECT sum(doc_len) AS total FROM (SELECT DISTINCT doc_id, doc_len FROM dt)),
dfs AS (SELECT term, count(*) AS df FROM dt GROUP BY 1),
win AS (SELECT * FROM docs WHERE notice_time BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}'
        AND platform = {platform}),{LINKS_SQL},
nkw AS (SELECT uid, count(*) AS nk FROM kw GROUP BY 1),
filt AS (SELECT * FROM (VALUES {filt}) f(word)),
cs AS (SELECT DISTINCT uid, shortname AS name FROM clicks JOIN company USING (institutionid)
       WHERE shortname IS NOT NULL AND shortname NOT IN (SELECT word FROM filt)),
cf AS (SELECT DISTINCT uid, fullname AS name FROM clicks JOIN company USING (institutionid) WHERE fullname IS NOT NULL),
bs AS (SELECT DISTINCT c.uid, b.shortname AS name FROM clicks c JOIN bond b USING (institutionid)
       LEFT JOIN nkw ON nkw.uid = c.uid WHERE b.shortname IS NOT NULL),
names AS (SELECT * FROM cs UNION SELECT * FROM cf UNION SELECT * FROM bs),
q AS (SELECT uid, 'keyword' AS kind, keyword AS name, 1.2 AS boost FROM kw
      UNION ALL SELECT uid, 'name', name, 1.0 FROM names),
qt AS (SELECT uid, kind, name, boost, len(tk) AS n_tokens, unnest(tk) AS term
       FROM (SELECT *, list_distinct({_tok('name')}) AS tk FROM q) WHERE len(tk) > 0),
hits AS (SELECT qt.uid, dt.doc_id, qt.kind, qt.name, qt.n_tokens, dt.term,
                qt.boost * (ln(ndocs.n / (dfs.df + 1)) + 1) * dt.tf * 2.2 /
                (dt.tf + 1.2 * (0.25 + 0.75 * dt.doc_len / (flen.total / ndocs.n))) AS s
         FROM dt JOIN qt USING (term) JOIN dfs USING (term), ndocs, flen
         WHERE dt.doc_id IN (SELECT doc_id FROM win)),
pn AS (SELECT uid, doc_id, kind, name, sum(s) AS s, list(term) AS terms FROM hits
       GROUP BY uid, doc_id, kind, name, n_tokens HAVING count(*) = n_tokens),
pd AS (SELECT uid, doc_id, sum(s) AS score, array_to_string(list_sort(list_distinct(flatten(list(terms)))), ' ') AS matched_terms
       FROM pn GROUP BY 1, 2),
ranked AS (SELECT pd.uid, win.notice_time, pd.doc_id, win.platform AS source_flag, abs(pd.score) AS score,
                  coalesce(win.sentiment, 0.0) AS sentiment, pd.matched_terms,
                  row_number() OVER (PARTITION BY pd.uid ORDER BY round(pd.score, 9) DESC, win.sentiment DESC NULLS LAST,
                                     win.notice_time DESC NULLS LAST, pd.doc_id ASC) AS rank
           FROM pd JOIN win USING (doc_id))"""


def _rel_select(platform):
    return _relevance_sql(platform) + """
SELECT uid, notice_time, doc_id, source_flag, round(score, 6) + 0.0 AS score, sentiment, matched_terms, rank
FROM ranked WHERE rank <= 1000"""


CORRELATION_SQL = _relevance_sql(1) + f""",
rows AS (SELECT uid, notice_time, CAST(substr(doc_id, 2) AS BIGINT) AS news_id, source_flag,
                round(score, 6) + 0.0 AS score, sentiment AS neg_sentiment
         FROM ranked WHERE rank <= 1000 AND starts_with(doc_id, 'N')),
existing AS (SELECT DISTINCT uid, news_id, source_flag FROM rows WHERE notice_time < TIMESTAMP '{PRIOR_END}')
SELECT * FROM rows WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.uid = rows.uid AND e.news_id = rows.news_id
                                     AND e.source_flag = rows.source_flag)"""

CORRELATION_EXISTING_SQL = _relevance_sql(1) + f""",
rows AS (SELECT uid, notice_time, CAST(substr(doc_id, 2) AS BIGINT) AS news_id, source_flag,
                round(score, 6) + 0.0 AS score, sentiment AS neg_sentiment
         FROM ranked WHERE rank <= 1000 AND starts_with(doc_id, 'N')),
before AS (SELECT DISTINCT user_id AS uid, event_id % {VIEWED} AS news_id, 1 AS source_flag FROM events
           WHERE event_type = 'view' AND user_id IS NOT NULL)
SELECT uid, news_id, source_flag, TIMESTAMP '{VIEWED_AT}' AS notice_time, -1.0::DOUBLE AS score, 0.0::DOUBLE AS neg_sentiment FROM before
UNION ALL
SELECT uid, news_id, source_flag, notice_time, score, neg_sentiment FROM rows r
WHERE NOT EXISTS (SELECT 1 FROM before b WHERE b.uid = r.uid AND b.news_id = r.news_id AND b.source_flag = r.source_flag)"""

NAME_DICTIONARY_SQL = "WITH " + LINKS_SQL.lstrip() + """
SELECT 'bond' AS list, name FROM (SELECT DISTINCT trim(shortname) AS name FROM bond WHERE shortname IS NOT NULL)
UNION ALL
SELECT 'company', name FROM (SELECT DISTINCT trim(shortname) AS name FROM company WHERE shortname IS NOT NULL)"""


def _cut_sql(x):
    stops = ", ".join(f"'{w}'" for w in NAME_STOP_WORDS)
    return f"array_to_string(list_filter({_tok(x, False)}, lambda t: NOT list_contains([{stops}], t)), ' ')"


USER_VOCABULARY_SQL = "WITH " + LINKS_SQL.lstrip() + f""",
users AS (SELECT uid, 'user_' || CAST(floor(uid / 2) AS BIGINT) AS user_name
          FROM (SELECT uid FROM kw UNION SELECT uid FROM clicks) WHERE uid < 9800),
firstu AS (SELECT user_name, min(uid) AS uid FROM users GROUP BY 1),
kws AS (SELECT uid, array_to_string(list_sort(list(DISTINCT keyword)), chr(9)) AS key_words FROM kw GROUP BY 1),
comp AS (SELECT uid, string_agg(shortname, chr(9) ORDER BY institutionid, shortname, fullname) AS short_names,
                string_agg({_cut_sql('shortname || fullname')}, chr(9) ORDER BY institutionid, shortname, fullname) AS full_names
         FROM clicks JOIN company USING (institutionid) GROUP BY 1),
bnd AS (SELECT uid, string_agg(shortname, chr(9) ORDER BY institutionid, shortname, fullname) AS bond_short_names,
               string_agg({_cut_sql('fullname')}, chr(9) ORDER BY institutionid, shortname, fullname) AS bond_full_names
        FROM clicks JOIN bond USING (institutionid) GROUP BY 1),
o AS (SELECT f.user_name, f.uid, coalesce(key_words, '') AS key_words, coalesce(short_names, '') AS short_names,
             coalesce(bond_short_names, '') AS bond_short_names, coalesce(full_names, '') AS full_names,
             coalesce(bond_full_names, '') AS bond_full_names
      FROM firstu f LEFT JOIN kws USING (uid) LEFT JOIN comp USING (uid) LEFT JOIN bnd USING (uid))
SELECT *, concat_ws('||', user_name, key_words, short_names, bond_short_names, full_names, bond_full_names) AS line FROM o"""

TOP_TAGS_SQL = f"""
WITH parts AS (SELECT p_partkey AS doc_id, concat_ws(' ', p_name, p_type, p_brand) AS content FROM part),
toks AS (SELECT doc_id, {_tok('content', False)} AS tk FROM parts),
dt AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tk) AS term FROM toks) GROUP BY ALL),
n AS (SELECT count(*) AS n FROM parts),
dfs AS (SELECT term, count(*) AS df FROM dt GROUP BY 1),
s AS (SELECT doc_id, term, tf * (ln(n.n / (df + 1)) + 1) AS score FROM dt JOIN dfs USING (term), n),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term ASC) AS rank FROM s)
SELECT doc_id, rank, term, round(score, 6) + 0.0 AS score FROM r WHERE rank <= 3"""

ORACLE = {
    "search_bool": _search_sql(QUERY_BOOL),
    "search_prefix": _search_sql(QUERY_PREFIX),
    "search_fuzzy": _search_sql(QUERY_FUZZY),
    "search_fuzzy_near": _search_sql(QUERY_FUZZY_NEAR),
    "search_fuzzy_far": _search_sql(QUERY_FUZZY_FAR),
    "search_wildcard": _search_sql(QUERY_WILD),
    "search_page": f"""SELECT doc_id, score, rank FROM (
        SELECT r.doc_id, r.score, row_number() OVER (ORDER BY r.exact DESC, d.sentiment DESC NULLS LAST, d.notice_time DESC NULLS LAST, r.doc_id) AS rank
        FROM ({_search_sql(QUERY_BOOL, exact=True)}) r JOIN ({'WITH ' + FEEDS_SQL} SELECT * FROM docs_all) d ON d.doc_id = r.doc_id) WHERE rank <= {PAGE}""",
    "search_merged": _search_sql(QUERY_PREFIX),
    "search_range": _search_sql(QUERY_RANGE),
    "search_boost": _search_sql(QUERY_BOOST),
    "user_relevance": _rel_select(1),
    "user_relevance_micro": _rel_select(3),
    "correlation_append": CORRELATION_SQL,
    "correlation_existing": CORRELATION_EXISTING_SQL,
    "name_dictionary": NAME_DICTIONARY_SQL,
    "user_vocabulary": USER_VOCABULARY_SQL,
    "top_tags": TOP_TAGS_SQL,
}
