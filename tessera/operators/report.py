"""Weekly negative-news report (S7 S8 S9 S14 P5 P13 P14 F9 F10 F11 F17 J13 J14
J15 J16 J19 J21 A14 A15 A16 A17 A18 A20 U4 W5 W7 Q16-Q19 Q32).

Lookup tables (divisions, industry maps) are reference data bounded by the
administrative / classification code lists, so they are broadcast.  The
address match (J16) is an equi join: every 1..3 character substring of the
first 6 address characters is exploded (at most 15 rows per address) and
joined to the division prefixes; ties go to the lowest division code, then to
the prefix position (Q16).  Roll-ups are grouped aggregates; the member lists
of a roll-up are returned as rows (a province can hold a third of all
institutions, so its list is never collected into one value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage
from tessera.functions.scoring import log_count
from tessera.functions.text import empty_to_null, strip_parentheses

# Fixed values of the reference jobs.
EXCLUDED_AREA_NAMES = ["市辖区", "县", "自治区直辖县级行政区划"]
LONG_PREFIX_STARTS = ["内蒙", "黑龙"]
INDUSTRY_SYSTEM = "P0207"
INSTITUTION_CATEGORY_PATTERN = r"^P041[4-5]$"
INSTITUTION_CATEGORY_EXTRA = "P0499"
INSTITUTION_FILES = 1000
WEEKLY_COLUMNS = ["location", "location_name", "industry", "industry_name", "news_count",
                  "news_count_neg", "neg_top_flag", "neg_news_id", "shortname", "fullname"]


# ---------------------------------------------------------------- sources

def with_line_order(lines: DataFrame, with_file: bool = False) -> DataFrame:
    """Line order of text input (`spark.read.text`): increasing ids follow the
    file splits in order and the rows inside each split, and are recomputed
    identically when a task is retried.  `with_file` adds the source `file`."""
    out = lines.withColumn("seq", F.monotonically_increasing_id())
    return out.withColumn("file", F.col("_metadata.file_path")) if with_file else out


def parse_institution_counts(lines: DataFrame, keep: str = "first") -> DataFrame:
    """S7 (first row per id wins, neg = column 5 as int) / S8 (last row wins,
    count = column 4).  Malformed lines (too few fields, non-integer count)
    are skipped.  lines: (value, seq)."""
    parts = F.split(F.col("value"), "\t")
    rows = lines.select("seq", parts.alias("p")).where(F.size("p") >= 4)
    rows = rows.select(
        "seq",
        F.get(F.col("p"), 0).try_cast("bigint").alias("institutionid"),
        F.get(F.col("p"), 1).alias("shortname"), F.get(F.col("p"), 2).alias("fullname"),
        F.get(F.col("p"), 3).try_cast("bigint").alias("news_count"),
        F.when(F.size("p") >= 5, F.get(F.col("p"), 4)).try_cast("bigint").alias("news_count_neg"))
    need = "news_count_neg" if keep == "first" else "news_count"
    rows = rows.where(F.col("institutionid").isNotNull() & F.col(need).isNotNull())
    pick = F.min_by if keep == "first" else F.max_by
    cols = ["shortname", "fullname", "news_count", "news_count_neg"]
    return rows.groupBy("institutionid").agg(
        *[pick(F.col(c), F.col("seq")).alias(c) for c in cols])


def parse_key_values(lines: DataFrame, section: str = "general") -> DataFrame:
    """`key = value` lines of one INI section -> (institutionid, news_id)."""
    v = F.trim(F.col("value"))
    sec = F.when(v.startswith("["), F.regexp_extract(v, r"^\[(.*)\]", 1))
    # the running section marker needs line order inside one file; with a
    # `file` column each file is its own window partition (files are small config)
    by = ["file"] if "file" in lines.columns else []
    w = Window.partitionBy(*by).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    tagged = lines.select(*by, "seq", v.alias("v"), sec.alias("sec")) \
        .withColumn("section", F.last("sec", ignorenulls=True).over(w))
    kv = tagged.where((F.col("section") == section) & F.col("v").contains("=")
                      & ~F.col("v").startswith(";") & ~F.col("v").startswith("#"))
    return kv.select(F.trim(F.split_part("v", F.lit("="), F.lit(1))).cast("bigint").alias("institutionid"),
                     F.trim(F.split_part("v", F.lit("="), F.lit(2))).cast("bigint").alias("neg_news_id"))


# ------------------------------------------------------------------ geo

def province_prefixes(divisions: DataFrame, excluded=EXCLUDED_AREA_NAMES) -> DataFrame:
    """P14 + F10: (province_code, pos, prefix).  pos 0 is the province's own
    name prefix (3 characters for 内蒙.. / 黑龙..), then its cities' 2-character
    prefixes in code order; city rows are codes ending in 00 (not 0000),
    excluded names dropped."""
    d = divisions.select("code", "name")
    prov = d.where(F.substring("code", 3, 4) == "0000")
    long = None
    for s in LONG_PREFIX_STARTS:
        c = F.col("name").startswith(s)
        long = c if long is None else long | c
    prov = prov.select(F.col("code").alias("province_code"), F.lit(0).alias("pos"),
                       F.when(long, F.substring("name", 1, 3)).otherwise(F.substring("name", 1, 2)).alias("prefix"))
    city = d.where((F.substring("code", 5, 2) == "00") & (F.substring("code", 3, 4) != "0000")
                   & ~F.col("name").isin(*excluded))
    city = city.select(F.concat(F.substring("code", 1, 2), F.lit("0000")).alias("province_code"),
                       "code", F.substring("name", 1, 2).alias("prefix")).where(F.col("prefix") != "")
    city = city.withColumn("pos", F.row_number().over(Window.partitionBy("province_code").orderBy("code"))) \
        .select("province_code", "pos", "prefix")
    return prov.unionByName(city)


_SUBSTRINGS = [(s, n) for n in (1, 2, 3) for s in range(1, 8 - n)]  # 15 (start, length) of 6 chars


def match_addresses(addresses: DataFrame, prefixes: DataFrame, addr: str = "address") -> DataFrame:
    """(institutionid, province_code) for addresses whose first 6
    characters contain a division prefix; lowest (code, pos) wins."""
    a6 = F.substring(F.col(addr), 1, 6)
    subs = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.lit(n).alias("n")) for s, n in _SUBSTRINGS]))
    cand = (addresses.select("institutionid", a6.alias("a6")).select("institutionid", "a6", subs.alias("x"))
            .select("institutionid", F.substring("a6", F.col("x.s"), F.col("x.n")).alias("prefix"),
                    F.col("x.n").alias("n"))
            .where(F.length("prefix") == F.col("n")))
    hit = cand.join(F.broadcast(prefixes), "prefix")  # division list: bounded reference data
    best = hit.groupBy("institutionid").agg(F.min(F.struct("province_code", "pos")).alias("b"))
    return best.select("institutionid", F.col("b.province_code").alias("province_code"))


def assign_provinces(negatives: DataFrame, institutions: DataFrame, listed: DataFrame,
                     prefixes: DataFrame, fallback: bool = False) -> DataFrame:
    """Listed province first, else the register address, else the office
    address (a non-empty unmatched register address does not fall back unless
    `fallback`, Q17).  status: listed / matched / unmatched / no_address / error."""
    lst = listed.where(F.col("institutionid").isNotNull() & F.col("province_code").isNotNull()) \
        .groupBy("institutionid").agg(F.min("province_code").alias("listed_code"))  # Q32
    inst = institutions.select("institutionid", F.col("registeraddress").alias("reg"),
                               F.col("officeaddress").alias("off"), F.lit(True).alias("_known"))
    base = negatives.select("institutionid").join(lst, "institutionid", "left").join(inst, "institutionid", "left")
    nonempty = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    reg_m = match_addresses(base.where(nonempty("reg")).select("institutionid", F.col("reg").alias("address")),
                            prefixes).withColumnRenamed("province_code", "reg_code")
    off_m = match_addresses(base.where(nonempty("off")).select("institutionid", F.col("off").alias("address")),
                            prefixes).withColumnRenamed("province_code", "off_code")
    j = base.join(reg_m, "institutionid", "left").join(off_m, "institutionid", "left")
    use_off = ~nonempty("reg") | F.lit(fallback)
    code = (F.when(F.col("listed_code").isNotNull(), F.col("listed_code"))
             .when(F.col("_known").isNull(), F.lit(None))
             .when(nonempty("reg") & F.col("reg_code").isNotNull(), F.col("reg_code"))
             .when(use_off & nonempty("off"), F.col("off_code")))
    status = (F.when(F.col("listed_code").isNotNull(), "listed")
               .when(F.col("_known").isNull(), "error")
               .when(~nonempty("reg") & ~nonempty("off"), "no_address")
               .when(code.isNotNull(), "matched")
               .otherwise("unmatched"))
    return j.select("institutionid", code.alias("province_code"), status.alias("status"))


def province_names(prefixes: DataFrame) -> DataFrame:
    """location_name = the province's first prefix (pos 0)."""
    return prefixes.groupBy("province_code").agg(F.min_by("prefix", "pos").alias("location_name"))


def province_rollup(assigned: DataFrame, negatives: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Per province total negatives, ln(1 + total), institution count."""
    m = assigned.where(F.col("province_code").isNotNull()).join(negatives, "institutionid")
    agg = m.groupBy("province_code").agg(F.sum("news_count_neg").cast("bigint").alias("total_neg"),
                                         F.count(F.lit(1)).alias("n_institutions"))
    return (agg.join(F.broadcast(province_names(prefixes)), "province_code", "left")
               .withColumn("log_neg", log_count(F.col("total_neg").cast("double"))))


def province_members(assigned: DataFrame, negatives: DataFrame) -> DataFrame:
    """A14 member list as rows: `id:short:neg` per institution of a province."""
    m = assigned.where(F.col("province_code").isNotNull()).join(negatives, "institutionid")
    return m.select("province_code", "institutionid", "shortname", "news_count_neg",
                    F.format_string("%d:%s:%d", "institutionid", F.coalesce("shortname", F.lit("")),
                                    "news_count_neg").alias("entry"))


def match_counters(assigned: DataFrame) -> DataFrame:
    """Counts per status plus the total."""
    per = assigned.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    total = assigned.agg(F.count(F.lit(1)).alias("n")).select(F.lit("total").alias("status"), "n")
    return per.unionByName(total)


# --------------------------------------------------------------- industry

def institution_industries(listed: DataFrame, industry_class: DataFrame, industry_set: DataFrame,
                           base_to_new: DataFrame) -> DataFrame:
    """J13 + J14 + F17: listed institution -> classified base industry (system
    P0207) -> new industry code via the (upper-cased) map; unmapped dropped;
    one industry per institution (min code, Q32)."""
    ic = industry_class.where(F.col("classification_id") == INDUSTRY_SYSTEM)
    s = industry_set.where(F.col("system_code") == INDUSTRY_SYSTEM)
    j = (listed.select("institutionid", "shortname", "industry_code")
               .join(ic.select("industry_code", "classification_id"), "industry_code", "left")
               .join(s.select(F.col("industry_code"), F.col("system_code").alias("classification_id"),
                              "industry_name"), ["industry_code", "classification_id"])
               .select("institutionid", "shortname", "industry_code", "industry_name").distinct())
    m = base_to_new.select(F.upper("base_code").alias("_base"), F.upper("new_code").alias("industry"))
    j = j.join(m, F.upper(F.col("industry_code")) == F.col("_base"))
    return j.groupBy("institutionid").agg(F.min("industry").alias("industry"),
                                          F.min("shortname").alias("shortname"))


def industry_rollup(ind: DataFrame, negatives: DataFrame, new_names: DataFrame) -> DataFrame:
    """A16 + U4: per new industry that has institutions: negatives of its
    institutions that have negatives (0 when none), ln(1 + total)."""
    j = ind.join(negatives.select("institutionid", "news_count_neg"), "institutionid", "left")
    agg = j.groupBy("industry").agg(
        F.coalesce(F.sum("news_count_neg"), F.lit(0)).cast("bigint").alias("total_neg"),
        F.count("news_count_neg").alias("n_institutions"))
    names = new_names.select(F.upper("code").alias("industry"), F.col("name").alias("industry_name"))
    return (agg.join(names, "industry", "left")
               .withColumn("log_neg", log_count(F.col("total_neg").cast("double"))))


# ----------------------------------------------------------------- J19

def weekly_upsert(existing: DataFrame | None, updates: list[DataFrame], report_date) -> DataFrame:
    """Merge update sources into the weekly table for one report date.

    Every source holds (institutionid, <some weekly columns>); later sources
    win per column; a NULL does not overwrite; rows are inserted when absent.
    One union + one grouped aggregate (max_by on the source priority), so the
    merge is a single shuffle however many sources there are.  Applying the
    same updates twice gives the same table."""
    rd = F.to_date(F.lit(report_date))
    frames = []
    if existing is not None:
        frames.append(existing.where(F.col("report_date") == rd).drop("report_date"))
    frames += updates
    aligned = []
    for prio, f in enumerate(frames):
        cols = [F.col(c) if c in f.columns else F.lit(None) for c in WEEKLY_COLUMNS]
        aligned.append(f.select("institutionid", *[c.alias(n) for c, n in zip(cols, WEEKLY_COLUMNS)],
                                F.lit(prio).alias("_prio")))
    u = aligned[0]
    for a in aligned[1:]:
        u = u.unionByName(a, allowMissingColumns=True)
    agg = u.groupBy("institutionid").agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_prio"))).alias(c) for c in WEEKLY_COLUMNS])
    return agg.select("institutionid", rd.alias("report_date"), *WEEKLY_COLUMNS)


def combined_updates(updates: list[DataFrame], report_date) -> DataFrame:
    """The update sources of a date as one row per institution: the later
    source wins, a NULL does not overwrite."""
    return weekly_upsert(None, updates, report_date)


def weekly_merge(old: DataFrame, update: DataFrame) -> DataFrame:
    """J19 for the touched rows of a stored table: values of `update` replace
    those of the same (institutionid, report_date) unless NULL, new keys are
    inserted, all other rows stay."""
    key = ["institutionid", "report_date"]
    both = old.select(*key, F.struct(*WEEKLY_COLUMNS).alias("_old")).join(
        update.select(*key, F.struct(*WEEKLY_COLUMNS).alias("_new")), key, "full")
    return both.select(*key, *[F.coalesce(F.col(f"_new.{c}"), F.col(f"_old.{c}")).alias(c) for c in WEEKLY_COLUMNS])


def conflict_counts(old: DataFrame, update: DataFrame) -> DataFrame:
    """Per column of the weekly table: keys of `update` that are in the
    table (`existing`), of these how many bring another value than the stored
    one (`replaced`), fill a NULL (`filled`) or agree (`same`)."""
    key = ["institutionid", "report_date"]
    j = old.select(*key, *[F.col(c).alias(f"o_{c}") for c in WEEKLY_COLUMNS]).join(update, key)
    rows = j.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"o_{c}").cast("string").alias("o"), F.col(c).cast("string").alias("n")) for c in WEEKLY_COLUMNS])).alias("x")).select("x.*")
    return rows.groupBy("column").agg(
        F.count(F.lit(1)).alias("existing"), F.count_if(F.col("o").isNotNull() & F.col("n").isNotNull() & (F.col("o") != F.col("n"))).alias("replaced"),
        F.count_if(F.col("o").isNull() & F.col("n").isNotNull()).alias("filled"), F.count_if(F.col("o") == F.col("n")).alias("same"))


def geo_updates(assigned: DataFrame, negatives: DataFrame, prefixes: DataFrame) -> DataFrame:
    m = assigned.where(F.col("province_code").isNotNull()).join(negatives, "institutionid")
    return (m.join(F.broadcast(province_names(prefixes)), "province_code", "left")
             .select("institutionid", F.col("province_code").alias("location"), "location_name",
                     "news_count_neg", empty_to_null(F.col("shortname")).alias("shortname"),
                     empty_to_null(F.col("fullname")).alias("fullname")))


def industry_updates(ind: DataFrame, negatives: DataFrame, new_names: DataFrame) -> DataFrame:
    names = new_names.select(F.upper("code").alias("industry"), F.col("name").alias("industry_name"))
    return (ind.join(negatives, "institutionid").join(names, "industry", "left")
               .select("institutionid", "industry", "industry_name", "news_count_neg",
                       empty_to_null(negatives["shortname"]).alias("shortname"),
                       empty_to_null(F.col("fullname")).alias("fullname")))


def media_updates(attention: DataFrame) -> DataFrame:
    return attention.select("institutionid", "news_count", empty_to_null(F.col("shortname")).alias("shortname"),
                            empty_to_null(F.col("fullname")).alias("fullname"))


def lead_news_updates(lead: DataFrame) -> DataFrame:
    return lead.select("institutionid", F.lit(1).alias("neg_top_flag"), "neg_news_id")


# ------------------------------------------------------------- S14 / W7

def global_row_index(df: DataFrame, order_cols, n_parts: int | None = None) -> DataFrame:
    """0-based row index in the order of `order_cols` (a name, or a list of names
    and columns) without a single-partition
    window: range-partition, number rows inside each partition, then add the
    row count of all earlier partitions (a table with one row per partition).

    The numbered rows are checkpointed: numbers and counts must come from one
    and the same partitioning, and a range exchange samples its bounds anew
    each time it runs."""
    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    ranged = df.repartitionByRange(n_parts, *cols) if n_parts else df.repartitionByRange(*cols)
    # the generated id holds the partition in its upper bits and the row's
    # position in the lower 33: the local index needs no window
    r = cut_lineage(ranged.sortWithinPartitions(*cols).withColumn("_mid", F.monotonically_increasing_id()))
    r = (r.withColumn("_pid", F.shiftright("_mid", 33))
          .withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
          .drop("_mid"))
    counts = r.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offs = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row per partition
    return r.join(F.broadcast(offs.select("_pid", "_off")), "_pid") \
        .withColumn("row_index", F.col("_off") + F.col("_local")).drop("_pid", "_local", "_off")


def institution_parts(institutions: DataFrame, n_files: int = INSTITUTION_FILES) -> DataFrame:
    """S14 + P5 + P13 + F9 + A17 + W7 (Q19 corrected): institutions of the
    categories P0414/P0415/P0499 numbered in id order, part = index / disp with
    disp = max(1, floor(distinct ids / n_files)); rows whose names are both
    empty are skipped after numbering."""
    sel = institutions.where(F.col("categoryid").rlike(INSTITUTION_CATEGORY_PATTERN)
                             | (F.col("categoryid") == INSTITUTION_CATEGORY_EXTRA))
    total = sel.agg(F.countDistinct("institutionid").alias("_total"))  # A17
    disp = F.greatest(F.lit(1), F.floor(F.col("_total") / F.lit(float(n_files))))
    idx = global_row_index(sel, "institutionid").withColumn("_total", total.select("_total").scalar())
    out = idx.select("institutionid",
                     strip_parentheses(F.coalesce("shortname", F.lit(""))).alias("shortname"),
                     strip_parentheses(F.coalesce("fullname", F.lit(""))).alias("fullname"),
                     F.floor(F.col("row_index") / disp).cast("bigint").alias("part"))
    return out.where((F.col("shortname") != "") | (F.col("fullname") != ""))


def write_institution_parts(parts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S14 sink: one folder per part (`part=k`), TSV `id\\tshort\\tfull`."""
    (parts.select("part", F.concat_ws("\t", F.col("institutionid").cast("string"), "shortname", "fullname")
                  .alias("value"))
          .repartition("part").write.mode(mode).partitionBy("part").text(path))
