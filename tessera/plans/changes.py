"""Subscription-change queries on the driver tables.

The change log is derived from `events` (one line per event, seq = event_id,
date = event day, user = 'user_' || user_id, k = props.k):
  file type   value < 10 email, < 40 keyword, < 45 phone (not a valid type), else manager
  operation   signup -> 'add', purchase -> 'ADD', error -> 'DEL', others upper-cased (invalid)
  e-mail      op,r<k>,u<k>@<renren-inc | mail>.com[,staff for k >= 80]; k = 99 -> malformed
  keyword     value < 20 bond line of part k (k >= 90: unknown symbol); < 25 company short
              name of customer k; < 30 its full name; else type 1 (unsupported)
  manager     value < 100 by id k, else by name NATION_<k>
Reference tables: organisations = users with a signup event before 2024-01-04; bonds = parts
(securityid S<partkey>, short = p_name, symbol = p_brand-p_size, institution =
p_size, NULL above 45); institutions = customers (id NULL for negative balance);
managers = nations.  Subscriptions for C6: purchase / view events.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import changes as C
from tessera.plans.common import tables
from tessera.sources.snapshot import BucketedTable
from tessera.sources.store import derived_folder, derived_table, materialised

STAFF_ALIAS = [("u3", "Staff Three")]
SIGNUP_BEFORE = "2024-01-04 00:00:00"


def _k(t):
    return F.get_json_object("props", "$.k").cast("bigint")


def change_log(t):
    ev = t.events.select("event_id", "ts", "user_id", "event_type", "value", _k(t).alias("k"))
    part = t.part.select("p_partkey", "p_name", "p_brand", "p_size")
    cust = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    e = (ev.join(part, ev.k == part.p_partkey, "left").join(cust, ev.k == cust.c_custkey, "left"))
    v, k = F.col("value"), F.col("k")
    op = (F.when(F.col("event_type") == "signup", "add").when(F.col("event_type") == "purchase", "ADD")
           .when(F.col("event_type") == "error", "DEL").otherwise(F.upper("event_type")))
    ftype = (F.when(v < 10, "email").when(v < 40, "keyword").when(v < 45, "phone").otherwise("manager"))
    email = F.concat(F.lit("u"), k.cast("string"), F.lit("@"),
                     F.when(k < 10, "renren-inc").otherwise("mail"), F.lit(".com"))
    em_line = F.when(k == 99, op).otherwise(F.concat(
        op, F.lit(",r"), k.cast("string"), F.lit(","), email, F.when(k >= 80, ",staff").otherwise("")))
    symbol = F.concat_ws("-", "p_brand", F.col("p_size").cast("string"))
    kw_line = (F.when(v < 20, F.concat_ws(",", op, F.when(k >= 90, "nobond").otherwise(F.col("p_name")),
                                           F.lit("2"), F.when(k >= 90, "X").otherwise(symbol)))
                .when(v < 25, F.concat_ws(",", op, "c_name", F.lit("0")))
                .when(v < 30, F.concat_ws(",", op, F.concat_ws(" ", "c_name", "c_mktsegment"), F.lit("0")))
                .otherwise(F.concat(F.concat_ws(",", op, "p_name", F.lit("1")), F.lit(","))))
    mg_line = F.when(v < 100, F.concat_ws(",", op, k.cast("string"))) \
        .otherwise(F.concat(op, F.lit(",NATION_"), k.cast("string")))
    line = F.when(ftype == "keyword", kw_line).when(ftype == "manager", mg_line).otherwise(em_line)
    return e.select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_name"),
                    ftype.alias("file_type"), F.date_format("ts", "yyyyMMdd").alias("date"),
                    F.col("event_id").alias("seq"), line.alias("line"))


def organisations(t):
    return (t.events.where((F.col("event_type") == "signup") & (F.col("ts") < F.lit(SIGNUP_BEFORE).cast("timestamp")))
            .select(F.col("user_id").alias("id"), F.concat(F.lit("user_"), F.col("user_id").cast("string"))
                    .alias("name")).distinct())


def bonds(t):
    return t.part.select(F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("securityid"),
                         F.col("p_name").alias("shortname"),
                         F.concat_ws("-", "p_brand", F.col("p_size").cast("string")).alias("symbol"),
                         F.when(F.col("p_size") <= 45, F.col("p_size")).cast("bigint").alias("institutionid"))


def institutions(t):
    return t.customer.select(F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("institutionid"),
                             F.col("c_name").alias("shortname"),
                             F.concat_ws(" ", "c_name", "c_mktsegment").alias("fullname"))


def managers(t):
    return t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))


def _routed(spark, sf_dir):
    """The change files after C1 routing (uid attached, whole-file rejects
    marked): in the reference the files on disk, here written once per input
    to the shared folder and read by every change query."""
    t = tables(spark, sf_dir)
    paths = [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in ("events", "part", "customer")]
    routed = derived_table(spark, "change_log_routed", paths, lambda: C.route(change_log(t), organisations(t)))
    return t, routed


def apply_email_changes(spark, sf_dir):
    t, r = _routed(spark, sf_dir)
    return C.apply_email(C.email_changes(r))


def apply_keyword_changes(spark, sf_dir):
    t, r = _routed(spark, sf_dir)
    return C.apply_keywords(C.keyword_changes(r, bonds(t), institutions(t)))


def apply_manager_changes(spark, sf_dir):
    t, r = _routed(spark, sf_dir)
    return C.apply_managers(C.manager_changes(r, managers(t)))


def _existing(t):
    """Subscription tables that were there before the change files, from the
    click events: (uid, e-mail), (uid, bond) and (uid, manager) rows."""
    ev = t.events.where((F.col("event_type") == "click") & F.col("user_id").isNotNull()).select(
        F.col("user_id").alias("uid"), F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("username"), _k(t).alias("k"), "value")
    email = ev.where("k < 99").select(
        "uid", "username", F.concat(F.lit("c"), F.col("k").cast("string")).alias("recipient"),
        F.concat(F.lit("u"), F.col("k").cast("string"), F.lit("@"), F.when(F.col("k") < 10, "renren-inc").otherwise("mail"), F.lit(".com")).alias("email"),
        F.lit("old").alias("type")).distinct()
    part = t.part.select("p_partkey", "p_name", "p_brand", "p_size")
    keyword = ev.where("k < 90").join(part, F.col("k") == F.col("p_partkey")).select(
        "uid", "username", F.col("p_name").alias("keyword"), F.lit(2).alias("type"),
        F.concat_ws("-", "p_brand", F.col("p_size").cast("string")).alias("symbol"),
        F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("securityid"), F.col("p_size").cast("bigint").alias("institutionid")).distinct()
    manager = ev.select("uid", "username", (F.col("k") % 25).alias("managerid")).distinct()
    return {"email": email, "keyword": keyword, "manager": manager}


def _applied(spark, t, kind, keys, changes, apply):
    """The change log merged into the existing table in two batches, split at
    the middle of its numbers, the second delivered twice."""
    def build(path):
        table = BucketedTable(spark, path, keys)
        table.create(_existing(t)[kind])
        accepted = materialised(changes.where(F.col("status") == "accepted"), f"accepted-{kind}")
        middle = (accepted.agg(F.max("seq")).first()[0] or 0) // 2
        for batch, some in (("1", accepted.where(F.col("seq") <= middle)), ("2", accepted.where(F.col("seq") > middle)), ("2", accepted)):
            table.merge(some, lambda old, new: apply(new, existing=old), batch)
    inputs = [f"{t._dir.rstrip('/')}/{name}.parquet" for name in ("events", "part", "customer", "nation")]
    return BucketedTable(spark, derived_folder(spark, f"subscriptions-{kind}", inputs, build), keys).read()


def apply_email_existing(spark, sf_dir):
    t, r = _routed(spark, sf_dir)
    return _applied(spark, t, "email", ["uid", "email"], C.email_changes(r), C.apply_email)


def apply_keyword_existing(spark, sf_dir):
    t, r = _routed(spark, sf_dir)
    return _applied(spark, t, "keyword", ["uid", "keyword", "securityid"], C.keyword_changes(r, bonds(t), institutions(t)), C.apply_keywords)


def apply_manager_existing(spark, sf_dir):
    t, r = _routed(spark, sf_dir)
    return _applied(spark, t, "manager", ["uid", "managerid"], C.manager_changes(r, managers(t)), C.apply_managers)


def change_audit(spark, sf_dir):
    """Every input line, accepted (enriched, date-prefixed) or rejected
    (with reason); lines of rejected files stay visible (Q27)."""
    t, r = _routed(spark, sf_dir)
    cols = ["user_name", "file_type", "date", "seq", "status", "reject_reason", "out_line"]
    em = C.email_changes(r).select(*cols)
    kw = C.keyword_changes(r, bonds(t), institutions(t)).select(*cols)
    mg = C.manager_changes(r, managers(t)).select(*cols)
    other = (r.where(~F.col("file_type").isin(*C.FILE_TYPES))
              .select("user_name", "file_type", "date", "seq", F.lit("rejected").alias("status"), "reject_reason",
                      F.concat_ws(",", F.trim("line"), "reject_reason").alias("out_line")))
    return em.unionByName(kw).unionByName(mg).unionByName(other)


def orphan_users(spark, sf_dir):
    t = tables(spark, sf_dir)
    return C.orphan_users(change_log(t), organisations(t))


def subscriptions(t):
    ev = (t.events.where(F.col("event_type").isin("purchase", "view"))
          .select("user_id", "event_type", "value", _k(t).alias("k")))
    part = t.part.select("p_partkey", "p_name", "p_brand")
    cust = t.customer.select("c_custkey", "c_name")
    e = ev.join(part, ev.k == part.p_partkey, "left").join(cust, ev.k == cust.c_custkey, "left")
    view = F.col("event_type") == "view"
    k = F.col("k")
    return e.select(
        F.col("user_id").alias("uid"), F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_name"),
        F.when(view, F.lit(None)).when(F.col("value") >= 100, F.concat(F.col("c_name"), F.lit("公司")))
         .otherwise(F.col("p_name")).alias("key_word"),
        F.when(view, F.lit(None)).otherwise(F.col("p_brand")).alias("symbol"),
        F.when(view, F.lit(None)).otherwise(k).alias("institutionid"),
        F.concat(F.lit("u"), k.cast("string"), F.lit("@"), F.when(k < 10, "renren-inc").otherwise("mail"),
                 F.lit(".com")).alias("email"))


def subscription_changes(spark, sf_dir):
    t = tables(spark, sf_dir)
    alias = spark.createDataFrame(STAFF_ALIAS, "login string, name string")
    return C.subscription_change_lines(subscriptions(t), alias)


QUERIES = {
    "apply_email_changes": apply_email_changes,
    "apply_keyword_changes": apply_keyword_changes,
    "apply_manager_changes": apply_manager_changes,
    "apply_email_existing": apply_email_existing,
    "apply_keyword_existing": apply_keyword_existing,
    "apply_manager_existing": apply_manager_existing,
    "change_audit": change_audit,
    "orphan_users": orphan_users,
    "subscription_changes": subscription_changes,
}


# ---------------------------------------------------------------- oracle SQL

LOG_SQL = """
ev AS (SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value,
              CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k FROM events e),
e2 AS (SELECT ev.*, p.p_name, p.p_brand, p.p_size, c.c_name, c.c_mktsegment,
              CASE ev.event_type WHEN 'signup' THEN 'add' WHEN 'purchase' THEN 'ADD' WHEN 'error' THEN 'DEL'
                   ELSE upper(ev.event_type) END AS op,
              CASE WHEN ev.value < 10 THEN 'email' WHEN ev.value < 40 THEN 'keyword' WHEN ev.value < 45 THEN 'phone'
                   ELSE 'manager' END AS file_type
       FROM ev LEFT JOIN part p ON ev.k = p.p_partkey LEFT JOIN customer c ON ev.k = c.c_custkey),
log AS (SELECT 'user_' || CAST(user_id AS VARCHAR) AS user_name, file_type, strftime(ts, '%Y%m%d') AS date,
               event_id AS seq,
               CASE WHEN file_type = 'keyword' THEN
                      CASE WHEN value < 20 THEN concat_ws(',', op, CASE WHEN k >= 90 THEN 'nobond' ELSE p_name END, '2',
                                                        CASE WHEN k >= 90 THEN 'X' ELSE concat_ws('-', p_brand, CAST(p_size AS VARCHAR)) END)
                           WHEN value < 25 THEN concat_ws(',', op, c_name, '0')
                           WHEN value < 30 THEN concat_ws(',', op, concat_ws(' ', c_name, c_mktsegment), '0')
                           ELSE concat_ws(',', op, p_name, '1') || ',' END
                    WHEN file_type = 'manager' THEN
                      CASE WHEN value < 100 THEN concat_ws(',', op, CAST(k AS VARCHAR)) ELSE op || ',NATION_' || CAST(k AS VARCHAR) END
                    ELSE CASE WHEN k = 99 THEN op
                              ELSE op || ',r' || CAST(k AS VARCHAR) || ',u' || CAST(k AS VARCHAR) || '@'
                                   || CASE WHEN k < 10 THEN 'renren-inc' ELSE 'mail' END || '.com'
                                   || CASE WHEN k >= 80 THEN ',staff' ELSE '' END END END AS line
        FROM e2),
orgs AS (SELECT DISTINCT user_id AS id, 'user_' || CAST(user_id AS VARCHAR) AS name FROM events
         WHERE event_type = 'signup' AND ts < TIMESTAMP '""" + SIGNUP_BEFORE + """'),
routed AS (SELECT l.*, o.uid,
                  CASE WHEN l.file_type NOT IN ('keyword', 'email', 'manager') THEN 'Error file type'
                       WHEN o.uid IS NULL THEN 'Unknown user' END AS rr
           FROM log l LEFT JOIN (SELECT name, max(id) AS uid FROM orgs WHERE id IS NOT NULL AND name IS NOT NULL GROUP BY 1) o
             ON o.name = l.user_name
           WHERE trim(l.line) <> ''),
parsed AS (SELECT *, string_split(trim(line), ',') AS p FROM routed)"""

EMAIL_SQL = LOG_SQL + """,
em AS (SELECT *, upper(p[1]) AS op, p[2] AS recipient, p[3] AS email, coalesce(p[4], 'user') AS type,
              coalesce(rr, CASE WHEN len(p) < 3 THEN 'Malformed line' END) AS r1
       FROM parsed WHERE file_type = 'email'),
emf AS (SELECT *, coalesce(r1, CASE WHEN op NOT IN ('ADD', 'DEL') THEN 'Error operation' END) AS reason FROM em)"""

KW_SQL = LOG_SQL + """,
bonds AS (SELECT 'S' || CAST(p_partkey AS VARCHAR) AS securityid, p_name AS shortname,
                 concat_ws('-', p_brand, CAST(p_size AS VARCHAR)) AS symbol,
                 CAST(CASE WHEN p_size <= 45 THEN p_size END AS BIGINT) AS institutionid FROM part),
insts AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS institutionid, c_name AS shortname,
                 concat_ws(' ', c_name, c_mktsegment) AS fullname FROM customer),
kw AS (SELECT *, upper(p[1]) AS op, p[2] AS keyword, p[3] AS type, nullif(p[4], '') AS symbol,
              coalesce(rr, CASE WHEN len(p) < 3 THEN 'Malformed line' END) AS r1
       FROM parsed WHERE file_type = 'keyword'),
cand AS (SELECT kw.seq, count(*) AS n, arg_min(struct_pack(s := b.securityid, i := b.institutionid), b.securityid) AS only_b,
                arg_min(struct_pack(s := b.securityid, i := b.institutionid),
                        CASE WHEN b.shortname = kw.keyword THEN b.securityid END) AS named_b
         FROM kw JOIN bonds b ON b.symbol = kw.symbol WHERE kw.type = '2' GROUP BY 1),
bpick AS (SELECT seq, CASE WHEN n = 1 THEN only_b ELSE named_b END AS bond FROM cand),
byfull AS (SELECT fullname AS keyword, arg_min(institutionid, (institutionid IS NULL, institutionid)) AS fid
           FROM insts GROUP BY 1),
byshort AS (SELECT shortname AS keyword, arg_min(institutionid, (institutionid IS NULL, institutionid)) AS sid
            FROM insts GROUP BY 1),
kw2 AS (SELECT kw.*,
               CASE WHEN kw.type = '2' THEN bp.bond.s WHEN kw.type = '0' THEN '0' END AS securityid,
               CAST(CASE WHEN kw.type = '2' THEN bp.bond.i
                         WHEN kw.type = '0' THEN CASE WHEN bf.keyword IS NOT NULL THEN bf.fid ELSE bs.sid END END AS BIGINT)
                 AS institutionid
        FROM kw LEFT JOIN bpick bp USING (seq) LEFT JOIN byfull bf ON bf.keyword = kw.keyword
        LEFT JOIN byshort bs ON bs.keyword = kw.keyword),
kwf AS (SELECT *, coalesce(r1, CASE WHEN type = '2' THEN CASE WHEN institutionid IS NULL THEN 'Error bond info' END
                                    WHEN type = '0' THEN CASE WHEN institutionid IS NULL THEN 'Error company keyword!' END
                                    ELSE 'Unsupported type' END,
                           CASE WHEN op NOT IN ('ADD', 'DEL') THEN 'Error operation' END) AS reason
        FROM kw2)"""

MG_SQL = LOG_SQL + """,
mgrs AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation),
mg AS (SELECT *, upper(p[1]) AS op, p[2] AS ref, TRY_CAST(p[2] AS BIGINT) AS ref_id FROM parsed WHERE file_type = 'manager'),
mg2 AS (SELECT mg.*, bi.nm AS name_of_id, bn.mid AS id_of_name,
               CASE WHEN mg.ref_id IS NOT NULL THEN mg.ref_id ELSE bn.mid END AS managerid,
               CASE WHEN mg.ref_id IS NOT NULL THEN bi.nm ELSE mg.ref END AS manager_name
        FROM mg LEFT JOIN (SELECT id, min(name) AS nm FROM mgrs GROUP BY 1) bi ON bi.id = mg.ref_id
        LEFT JOIN (SELECT name, min(id) AS mid FROM mgrs GROUP BY 1) bn ON bn.name = mg.ref),
mgf AS (SELECT *, coalesce(rr, CASE WHEN len(p) < 2 THEN 'Malformed line'
                                    WHEN ref_id IS NOT NULL AND name_of_id IS NULL THEN 'Error manager id'
                                    WHEN ref_id IS NULL AND id_of_name IS NULL THEN 'Error manager name' END,
                           CASE WHEN op NOT IN ('ADD', 'DEL') THEN 'Error operation' END) AS reason FROM mg2)"""


def _survive(src, key, cols):
    k = ", ".join(key)
    return f"""
SELECT {cols} FROM (
  SELECT *, max(CASE WHEN op = 'DEL' THEN seq END) OVER (PARTITION BY {k}) AS last_del
  FROM {src} WHERE reason IS NULL) x
WHERE op = 'ADD' AND (last_del IS NULL OR seq > last_del)"""


APPLY_EMAIL_SQL = "WITH " + EMAIL_SQL + _survive(
    "emf", ["uid", "email"], "uid, user_name AS username, recipient, email, type")
APPLY_KW_SQL = "WITH " + KW_SQL + _survive(
    "kwf", ["uid", "keyword", "securityid"],
    "uid, user_name AS username, keyword, CAST(type AS INTEGER) AS type, symbol, securityid, institutionid")
APPLY_MG_SQL = "WITH " + MG_SQL + _survive("mgf", ["uid", "managerid"], "uid, user_name AS username, managerid")



def _survive_existing(sql, src, key, cols, named, old):
    """As `_survive`, with the rows of `old` before all changes."""
    k = ", ".join(key)
    return f"""WITH {sql},
clicks AS (SELECT user_id AS uid, 'user_' || CAST(user_id AS VARCHAR) AS username, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
           FROM events WHERE event_type = 'click' AND user_id IS NOT NULL),
every AS (SELECT {cols}, 'ADD' AS op, -1 AS seq FROM ({old}) UNION ALL SELECT {named}, op, seq FROM {src} WHERE reason IS NULL)
SELECT {cols} FROM (SELECT *, max(CASE WHEN op = 'DEL' THEN seq END) OVER (PARTITION BY {k}) AS last_del FROM every) x
WHERE op = 'ADD' AND (last_del IS NULL OR seq > last_del)"""


EMAIL_EXISTING_SQL = _survive_existing(
    EMAIL_SQL, "emf", ["uid", "email"], "uid, username, recipient, email, type", "uid, user_name, recipient, email, type",
    """SELECT DISTINCT uid, username, 'c' || CAST(k AS VARCHAR) AS recipient,
       'u' || CAST(k AS VARCHAR) || '@' || CASE WHEN k < 10 THEN 'renren-inc' ELSE 'mail' END || '.com' AS email, 'old' AS type FROM clicks WHERE k < 99""")
KW_EXISTING_SQL = _survive_existing(
    KW_SQL, "kwf", ["uid", "keyword", "securityid"], "uid, username, keyword, type, symbol, securityid, institutionid",
    "uid, user_name, keyword, CAST(type AS INTEGER), symbol, securityid, institutionid",
    """SELECT DISTINCT uid, username, p_name AS keyword, 2 AS type, concat_ws('-', p_brand, CAST(p_size AS VARCHAR)) AS symbol,
       'S' || CAST(p_partkey AS VARCHAR) AS securityid, CAST(p_size AS BIGINT) AS institutionid FROM clicks JOIN part ON k = p_partkey WHERE k < 90""")
MG_EXISTING_SQL = _survive_existing(
    MG_SQL, "mgf", ["uid", "managerid"], "uid, username, managerid", "uid, user_name, managerid",
    "SELECT DISTINCT uid, username, k % 25 AS managerid FROM clicks")

AUDIT_SQL = "WITH " + KW_SQL.replace("WITH ", "") + "," + EMAIL_SQL.split(LOG_SQL + ",", 1)[1] + "," + \
    MG_SQL.split(LOG_SQL + ",", 1)[1] + """
SELECT user_name, file_type, date, seq, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
       reason AS reject_reason,
       CASE WHEN reason IS NULL THEN concat_ws(',', date, trim(line)) ELSE concat_ws(',', trim(line), reason) END AS out_line
FROM emf
UNION ALL
SELECT user_name, file_type, date, seq, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END, reason,
       CASE WHEN reason IS NULL THEN concat_ws(',', date, concat_ws(',', op, keyword, type, coalesce(symbol, 'null'),
                                                                securityid, CAST(institutionid AS VARCHAR)))
            ELSE concat_ws(',', trim(line), reason) END
FROM kwf
UNION ALL
SELECT user_name, file_type, date, seq, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END, reason,
       CASE WHEN reason IS NULL THEN concat_ws(',', date, concat_ws(',', op, CAST(managerid AS VARCHAR), manager_name))
            ELSE concat_ws(',', trim(line), reason) END
FROM mgf
UNION ALL
SELECT user_name, file_type, date, seq, 'rejected', rr, concat_ws(',', trim(line), rr)
FROM routed WHERE file_type NOT IN ('keyword', 'email', 'manager')"""

ORPHAN_SQL = "WITH " + LOG_SQL + """
SELECT DISTINCT user_name FROM log WHERE user_name NOT IN (SELECT name FROM orgs WHERE name IS NOT NULL)"""

SUBS_SQL = """
WITH ev AS (SELECT user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
            FROM events WHERE event_type IN ('purchase', 'view')),
subs AS (SELECT 'user_' || CAST(user_id AS VARCHAR) AS user_name,
                CASE WHEN event_type = 'view' THEN NULL WHEN value >= 100 THEN c.c_name || '公司' ELSE p.p_name END AS key_word,
                CASE WHEN event_type = 'view' THEN NULL ELSE p.p_brand END AS symbol,
                CASE WHEN event_type = 'view' THEN NULL ELSE k END AS institutionid,
                'u' || CAST(k AS VARCHAR) || '@' || CASE WHEN k < 10 THEN 'renren-inc' ELSE 'mail' END || '.com' AS email
         FROM ev LEFT JOIN part p ON ev.k = p.p_partkey LEFT JOIN customer c ON ev.k = c.c_custkey),
kw AS (SELECT DISTINCT user_name, key_word, symbol, institutionid FROM subs),
nkw AS (SELECT user_name, count(*) AS n,
               max(CASE WHEN key_word IS NOT NULL OR symbol IS NOT NULL OR institutionid IS NOT NULL THEN 1 END) AS anyv
        FROM kw GROUP BY 1),
kwl AS (SELECT DISTINCT kw.user_name, 'keyword' AS file_type,
               concat_ws(',', 'ADD', coalesce(key_word, ''),
                         CASE WHEN contains(coalesce(key_word, ''), '公司') OR contains(coalesce(key_word, ''), '研究院') THEN '0' ELSE '2' END,
                         CASE WHEN contains(coalesce(key_word, ''), '公司') OR contains(coalesce(key_word, ''), '研究院') THEN ''
                              ELSE coalesce(symbol, '') END,
                         coalesce(CAST(institutionid AS VARCHAR), '')) AS line
        FROM kw JOIN nkw USING (user_name) WHERE NOT (nkw.n = 1 AND nkw.anyv IS NULL)),
alias AS (SELECT * FROM (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in STAFF_ALIAS) + """) t(login, name)),
em AS (SELECT DISTINCT user_name, email FROM subs WHERE email IS NOT NULL),
eml AS (SELECT user_name, 'email' AS file_type,
               concat_ws(',', 'ADD',
                         CASE WHEN split_part(split_part(email, '@', 2), '.', 1) = 'renren-inc'
                              THEN coalesce(a.name, split_part(email, '@', 1)) ELSE split_part(email, '@', 1) END,
                         email,
                         CASE WHEN split_part(split_part(email, '@', 2), '.', 1) = 'renren-inc' THEN 'renren' ELSE 'user' END) AS line
        FROM em LEFT JOIN alias a ON a.login = split_part(email, '@', 1)),
mgl AS (SELECT DISTINCT user_name, 'manager' AS file_type, 'ADD,2' AS line FROM subs)
SELECT * FROM kwl UNION ALL SELECT * FROM eml UNION ALL SELECT * FROM mgl"""

ORACLE = {
    "apply_email_changes": APPLY_EMAIL_SQL,
    "apply_keyword_changes": APPLY_KW_SQL,
    "apply_manager_changes": APPLY_MG_SQL,
    "apply_email_existing": EMAIL_EXISTING_SQL,
    "apply_keyword_existing": KW_EXISTING_SQL,
    "apply_manager_existing": MG_EXISTING_SQL,
    "change_audit": AUDIT_SQL,
    "orphan_users": ORPHAN_SQL,
    "subscription_changes": SUBS_SQL,
}
