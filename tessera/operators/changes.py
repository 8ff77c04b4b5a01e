"""Subscription change files: generation, validation, enrichment and
application (C1-C7, W6, J8-J12, U5, F20, P15-P18, T6, S11, S15, S16, Q14 Q15 Q27
Q29-Q31).

A change log is a DataFrame of lines with an explicit order:
    (user_name, file_type, date, seq, line)
read from `user_type_date.csv` files by `read_change_files`.  Every step is a
join or a window over a bounded key:
  * routing (C1) joins the user table (J8) and checks the file type (P15);
  * enrichment joins bonds counted by symbol and by name (J9) or
    institutions on full / short name (J10), managers on id or name (J11);
  * application (W6) keeps an ADD when no later DEL of the same key exists:
    `max(seq of DEL)` over the key - the window holds one key's changes.
Every input line ends in exactly one of `accepted` / `rejected(reason)`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import keyword_type
from tessera.operators.report import global_row_index

# Fixed values of the reference jobs.
FILE_TYPES = ["keyword", "email", "manager"]
ADD, DEL = "ADD", "DEL"
STAFF_DOMAIN = "renren-inc"
STAFF_TYPE = "renren"
USER_TYPE = "user"
MANAGER_LINE = "ADD,2"


# ------------------------------------------------------------------ S11

def read_change_files(spark, path: str) -> DataFrame:
    """Every `user_type_date.csv` under `path`, one row per line; `seq`
    numbers the lines of all files in the order of date, file and line,
    whatever the order in which the files are read."""
    df = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"))
    # rows of one block of a file are read in order
    df = df.withColumn("row", F.monotonically_increasing_id())
    stem = F.regexp_replace("file_name", r"\.csv$", "")
    df = df.select(F.split_part(stem, F.lit("_"), F.lit(1)).alias("user_name"),
                   F.split_part(stem, F.lit("_"), F.lit(2)).alias("file_type"),
                   F.split_part(stem, F.lit("_"), F.lit(3)).alias("date"), "file_name", "block", "row", "line")
    numbered = global_row_index(df, ["date", "file_name", "block", "row"])
    return numbered.select("user_name", "file_type", "date", F.col("row_index").alias("seq"), "line")


# ------------------------------------------------------------------ C1 / C7

def route(changes: DataFrame, organisations: DataFrame, file_types=FILE_TYPES,
          allow_new_users: bool = False) -> DataFrame:
    """C1 + J8 + P15: attach uid; a file of unknown type or unknown user is
    rejected as a whole (its lines are kept as rejected, Q27).  With
    `allow_new_users` (C7, the older behaviour) unknown names get
    uid = max(uid) + their rank instead."""
    orgs = (organisations.where(F.col("id").isNotNull() & F.col("name").isNotNull())
            .groupBy(F.col("name").alias("user_name")).agg(F.max("id").alias("uid")))
    c = changes.where(F.trim("line") != "")  # blank lines dropped (Q31)
    c = c.join(orgs, "user_name", "left")
    if allow_new_users:
        new = c.where(F.col("uid").isNull()).select("user_name").distinct()
        top = orgs.agg(F.coalesce(F.max("uid"), F.lit(0)).alias("_max")).select("_max").scalar()
        new = global_row_index(new, ["user_name"]).select("user_name", (top + F.col("row_index") + 1).alias("_new"))
        c = (c.join(new.select("user_name", "_new"), "user_name", "left")
              .withColumn("uid", F.coalesce("uid", "_new")).drop("_new"))
    reason = (F.when(~F.col("file_type").isin(*file_types), F.lit("Error file type"))
               .when(F.col("uid").isNull(), F.lit("Unknown user")))
    return c.withColumn("reject_reason", reason)


def _fields(line):
    return F.split(F.trim(line), ",")


def _op(parts):
    return F.upper(F.get(parts, 0))


def _finish(df: DataFrame, out_line) -> DataFrame:
    """Accepted lines carry the enriched text, rejected the reason."""
    op_bad = ~F.col("op").isin(ADD, DEL)
    reason = F.coalesce(F.col("reject_reason"), F.when(op_bad, F.lit("Error operation")))
    return (df.withColumn("reject_reason", reason)
              .withColumn("status", F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected"))
              .withColumn("out_line", F.when(F.col("status") == "accepted", F.concat_ws(",", F.col("date"), out_line))
                          .otherwise(F.concat_ws(",", F.trim("line"), F.col("reject_reason")))))


def survivors(df: DataFrame, key) -> DataFrame:
    """An ADD row survives when no DEL of the same key comes after it.

    The last DEL per key is a grouped aggregate (combined map-side, one row per
    key) joined back, not a window: a key holding a large share of the changes
    is never gathered into one task, and AQE's skew join splits its ADD rows."""
    key = list(key)
    last_del = df.where(F.col("op") == DEL).groupBy(*key).agg(F.max("seq").alias("_last_del"))
    adds = df.where(F.col("op") == ADD)
    # null-safe key match: a NULL key part is one key, as in a window partition
    cond = [adds[k].eqNullSafe(last_del[k]) for k in key]
    return (adds.join(last_del, cond, "left")
                .where(F.col("_last_del").isNull() | (F.col("seq") > F.col("_last_del")))
                .select(*[adds[c] for c in df.columns]))


# ------------------------------------------------------------------- C2

def email_changes(routed: DataFrame) -> DataFrame:
    """C2 + F20: `op,recipient,email[,type]`; missing type -> user."""
    p = _fields(F.col("line"))
    d = routed.where(F.col("file_type") == "email").withColumn("_p", p)
    d = d.select("*", _op(F.col("_p")).alias("op"), F.get(F.col("_p"), 1).alias("recipient"),
                 F.get(F.col("_p"), 2).alias("email"),
                 F.coalesce(F.get(F.col("_p"), 3), F.lit(USER_TYPE)).alias("type"))
    d = d.withColumn("reject_reason", F.coalesce(
        F.col("reject_reason"), F.when(F.size("_p") < 3, F.lit("Malformed line"))))  # Q31
    return _finish(d, F.trim("line")).drop("_p")


def apply_email(changes: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Final e-mail table after applying the accepted changes in order."""
    acc = changes.where(F.col("status") == "accepted").select(
        "uid", F.col("user_name").alias("username"), "recipient", "email", "type", "op", "seq")
    if existing is not None:
        acc = existing.select("uid", "username", "recipient", "email", "type",
                              F.lit(ADD).alias("op"), F.lit(-1).cast("long").alias("seq")).unionByName(acc)
    return survivors(acc, ["uid", "email"]).drop("op", "seq")


# ------------------------------------------------------------------- C3

def keyword_changes(routed: DataFrame, bonds: DataFrame, institutions: DataFrame) -> DataFrame:
    """C3 + J9 + J10 (+Q14, Q15): resolve every keyword line to
    (securityid, institutionid).

    type 2: bonds with the line's symbol; one -> it, several -> the first whose
            short name equals the keyword; none or NULL institution -> reject;
    type 0: institution by full name, else by short name (first of each);
            a NULL id -> reject, no second try;
    other:  reject `Unsupported type`."""
    p = _fields(F.col("line"))
    d = routed.where(F.col("file_type") == "keyword").withColumn("_p", p)
    sym = F.get(F.col("_p"), 3)
    d = d.select("*", _op(F.col("_p")).alias("op"), F.get(F.col("_p"), 1).alias("keyword"),
                 F.get(F.col("_p"), 2).alias("type"),
                 F.when(sym.isNull() | (sym == ""), F.lit(None).cast("string")).otherwise(sym).alias("symbol"))
    d = d.withColumn("reject_reason", F.coalesce(
        F.col("reject_reason"), F.when(F.size("_p") < 3, F.lit("Malformed line"))))
    # One row per symbol (count of its bonds, the first) and one per symbol
    # and short name, so that a line meets two rows, however many bonds share
    # its symbol; lines of one `seq` count together
    b = bonds.select("symbol", F.col("shortname").alias("keyword"), F.struct(F.col("securityid").alias("b_sec"), F.col("institutionid").alias("b_inst")).alias("bond"))
    first = lambda bond: F.min_by(bond, F.col(f"{bond}.b_sec"))
    named = b.groupBy("symbol", "keyword").agg(F.count(F.lit(1)).alias("_count"), first("bond").alias("_named"))
    every = named.groupBy("symbol").agg(F.sum("_count").alias("_count"), first("_named").alias("_only"))
    cand = (d.where(F.col("type") == "2").select("seq", "symbol", "keyword")
             .join(every, "symbol").join(named.drop("_count"), ["symbol", "keyword"], "left"))
    bond_pick = cand.groupBy("seq").agg(F.sum("_count").alias("_n"), first("_only").alias("_only"), first("_named").alias("_named"))
    bond_pick = bond_pick.select("seq", F.when(F.col("_n") == 1, F.col("_only"))
                                 .otherwise(F.col("_named")).alias("_bond"))
    # One row per name (first = smallest id, NULL ids last)
    inst = institutions.select("institutionid", "shortname", "fullname")
    by_full = inst.groupBy(F.col("fullname").alias("keyword")).agg(
        F.min_by("institutionid", F.struct(F.col("institutionid").isNull(), "institutionid")).alias("_full_id"),
        F.lit(True).alias("_full_hit"))
    by_short = inst.groupBy(F.col("shortname").alias("keyword")).agg(
        F.min_by("institutionid", F.struct(F.col("institutionid").isNull(), "institutionid")).alias("_short_id"),
        F.lit(True).alias("_short_hit"))
    d = (d.join(bond_pick, "seq", "left").join(by_full, "keyword", "left").join(by_short, "keyword", "left"))
    company_id = F.when(F.col("_full_hit").isNotNull(), F.col("_full_id")).otherwise(F.col("_short_id"))
    sec = (F.when(F.col("type") == "2", F.col("_bond.b_sec")).when(F.col("type") == "0", F.lit("0")))
    inst_id = (F.when(F.col("type") == "2", F.col("_bond.b_inst")).when(F.col("type") == "0", company_id))
    reason = (F.when(F.col("type") == "2", F.when(inst_id.isNull(), F.lit("Error bond info")))
               .when(F.col("type") == "0", F.when(inst_id.isNull(), F.lit("Error company keyword!")))
               .otherwise(F.lit("Unsupported type")))
    d = (d.withColumn("securityid", sec).withColumn("institutionid", inst_id.cast("bigint"))
          .withColumn("reject_reason", F.coalesce(F.col("reject_reason"), reason)))
    out_line = F.concat_ws(",", "op", "keyword", "type", F.coalesce("symbol", F.lit("null")), "securityid",
                           F.col("institutionid").cast("string"))
    return _finish(d, out_line).drop("_p", "_bond", "_full_id", "_full_hit", "_short_id", "_short_hit")


def apply_keywords(changes: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    acc = changes.where(F.col("status") == "accepted").select(
        "uid", F.col("user_name").alias("username"), "keyword", F.col("type").cast("int").alias("type"),
        "symbol", "securityid", "institutionid", "op", "seq")
    if existing is not None:
        acc = existing.select("uid", "username", "keyword", "type", "symbol", "securityid", "institutionid",
                              F.lit(ADD).alias("op"), F.lit(-1).cast("long").alias("seq")).unionByName(acc)
    return survivors(acc, ["uid", "keyword", "securityid"]).drop("op", "seq")


# ------------------------------------------------------------------- C4

def manager_changes(routed: DataFrame, managers: DataFrame) -> DataFrame:
    """C4 + J11: `op,id-or-name`: an integer is looked up by id (needs a name),
    anything else by name (needs an id)."""
    p = _fields(F.col("line"))
    d = routed.where(F.col("file_type") == "manager").withColumn("_p", p)
    ref = F.get(F.col("_p"), 1)
    d = d.select("*", _op(F.col("_p")).alias("op"), ref.alias("_ref"), ref.try_cast("bigint").alias("_ref_id"))
    by_id = managers.groupBy(F.col("id").alias("_ref_id")).agg(F.min("name").alias("_name_of_id"))
    by_name = managers.groupBy(F.col("name").alias("_ref")).agg(F.min("id").alias("_id_of_name"))
    d = d.join(by_id, "_ref_id", "left").join(by_name, "_ref", "left")
    is_id = F.col("_ref_id").isNotNull()
    mid = F.when(is_id, F.col("_ref_id")).otherwise(F.col("_id_of_name"))
    mname = F.when(is_id, F.col("_name_of_id")).otherwise(F.col("_ref"))
    reason = (F.when(F.size("_p") < 2, F.lit("Malformed line"))
               .when(is_id & F.col("_name_of_id").isNull(), F.lit("Error manager id"))
               .when(~is_id & F.col("_id_of_name").isNull(), F.lit("Error manager name")))
    d = (d.withColumn("managerid", mid).withColumn("manager_name", mname)
          .withColumn("reject_reason", F.coalesce(F.col("reject_reason"), reason)))
    out_line = F.concat_ws(",", "op", F.col("managerid").cast("string"), "manager_name")
    return _finish(d, out_line).drop("_p", "_ref", "_ref_id", "_name_of_id", "_id_of_name")


def apply_managers(changes: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    acc = changes.where(F.col("status") == "accepted").select(
        "uid", F.col("user_name").alias("username"), "managerid", "op", "seq")
    if existing is not None:
        acc = existing.select("uid", "username", "managerid",
                              F.lit(ADD).alias("op"), F.lit(-1).cast("long").alias("seq")).unionByName(acc)
    return survivors(acc, ["uid", "managerid"]).drop("op", "seq")


# ----------------------------------------------------------- J12 / U5 / C6

def orphan_users(file_users: DataFrame, organisations: DataFrame) -> DataFrame:
    """User names of the data files absent from the organisations."""
    return (file_users.select("user_name").distinct()
            .join(organisations.select(F.col("name").alias("user_name")), "user_name", "left_anti"))


def subscription_change_lines(subscriptions: DataFrame, staff_alias: DataFrame) -> DataFrame:
    """C6 + P16 + P17 + P18 + T6: the ADD lines that recreate every user's
    subscriptions: keyword, e-mail and the constant manager line.
    subscriptions: (user_name, key_word, symbol, institutionid, email)."""
    kw = subscriptions.select("user_name", "key_word", "symbol", "institutionid").distinct()
    n_rows = kw.groupBy("user_name").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.when(F.col("key_word").isNotNull() | F.col("symbol").isNotNull()
                     | F.col("institutionid").isNotNull(), 1)).alias("_any"))
    kw = kw.join(n_rows, "user_name").where(~((F.col("_n") == 1) & F.col("_any").isNull()))  # P16
    k = F.coalesce(F.col("key_word"), F.lit(""))
    t = keyword_type(k)
    kw_line = F.concat_ws(",", F.lit(ADD), k, t.cast("string"),
                          F.when(t == 0, F.lit("")).otherwise(F.coalesce("symbol", F.lit(""))),
                          F.coalesce(F.col("institutionid").cast("string"), F.lit("")))
    kw_lines = kw.select("user_name", F.lit("keyword").alias("file_type"), kw_line.alias("line")).distinct()
    em = subscriptions.select("user_name", "email").where(F.col("email").isNotNull()).distinct()
    local = F.split_part("email", F.lit("@"), F.lit(1))
    domain = F.split_part(F.split_part("email", F.lit("@"), F.lit(2)), F.lit("."), F.lit(1))
    alias = staff_alias.select(F.col("login").alias("_login"), F.col("name").alias("_alias"))
    em = em.join(alias, local == F.col("_login"), "left")
    staff = domain == STAFF_DOMAIN
    em_line = F.concat_ws(",", F.lit(ADD), F.when(staff, F.coalesce("_alias", local)).otherwise(local),
                          "email", F.when(staff, F.lit(STAFF_TYPE)).otherwise(F.lit(USER_TYPE)))
    em_lines = em.select("user_name", F.lit("email").alias("file_type"), em_line.alias("line"))
    users = subscriptions.select("user_name").distinct()
    mg_lines = users.select("user_name", F.lit("manager").alias("file_type"), F.lit(MANAGER_LINE).alias("line"))
    return kw_lines.unionByName(em_lines).unionByName(mg_lines)


def write_change_files(lines: DataFrame, path: str, date: str, mode: str = "overwrite") -> None:
    """One folder per (user, type); lines sorted (T6).  A range shuffle
    on (user, type, line) spreads a user with many lines over several tasks;
    each task writes a sorted, contiguous range, so the part files of a folder
    taken in name order are the user's whole sorted file."""
    (lines.withColumn("date", F.lit(date))
          .repartitionByRange("user_name", "file_type", "line")
          .sortWithinPartitions("user_name", "file_type", "line")
          .write.mode(mode).partitionBy("user_name", "file_type", "date").text(path))
