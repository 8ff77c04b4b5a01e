"""Line dedup by a deletion-neighbourhood join.

A line is a sequence of words; two lines are near copies when one edit of a
word (insert, delete or replace) turns one into the other, and both have
`MIN_WORDS` words or more.  A line goes when an equal line, or a near copy,
stands earlier: in a document of a smaller id or further up.

Every line within the edit bound of another has a variant in common with it:
the line less one word.  Variants are hashed with the place of the word left
out kept beside them.  Lines whose variants of one place are equal differ in
that word alone; a line equal to another line's variant lacks one word.  That is
verified on the words: what is left of them must have the same SHA-256.

What keeps it small: equal lines are one line throughout; only lines that share
their first or second half with another line can be near copies, so only those
emit variants (nothing is lost: one edit leaves one half as it was).  Bloom
filters of bits set twice stand before each shuffle: of lines, halves and
variants only those go on that may meet another.  A variant's hash is an
exclusive or over (word, place), so all variants of a line come from prefixes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (WHITE, bit_words, bound, filter_width, join_to_groups, packed, rows_with, text_or_empty, top_bits,
                                with_bit, written)

MIN_WORDS = 8


def _document_key(id_: Column, text: Column) -> list[Column]:
    """128 bits for a row's id and text: rows that repeat both are one document."""
    return [F.xxhash64(id_.cast("string"), text).alias("k1"), F.xxhash64(text, id_.cast("string"), F.lit(1)).alias("k2")]


def _lines(docs: DataFrame) -> DataFrame:
    """(k1, k2, id, place, text_line) of every line of docs (id, text)."""
    return docs.select(*_document_key(F.col("id"), F.col("text")), "id", F.posexplode(F.split("text", "\n")).alias("place", "text_line"))


def _words(line: Column) -> Column:
    """The words of a line; a split at one plain space needs no regular expression."""
    for white in WHITE[1:]:
        line = F.replace(line, F.lit(white), F.lit(" "))
    return F.array_remove(F.split(line, " "), "")


def _line_table(docs: DataFrame) -> DataFrame:
    """(k1, k2, id, place, words) of every line of docs (id, text) that has a word."""
    rows = _lines(docs).where(F.trim(F.col("text_line"), F.lit(WHITE)) != "")
    return rows.select("k1", "k2", "id", "place", _words(F.col("text_line")).alias("words"))


def _halves() -> list[Column]:
    """Hashes of the first and the last half, as a line of its own length and
    as a line of one word less, which it is but for an inserted word."""
    out = []
    for less in (0, 1):
        n = F.size("words") - less
        h = F.floor(n / 2).cast("int")
        out.append(F.xxhash64(F.lit(0), n, F.slice("words", F.lit(1), h)))
        out.append(F.xxhash64(F.lit(1), n, F.slice("words", F.size("words") - (n - h) + 1, n - h)))
    return out


def _order() -> Column:
    return F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2", "place")


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))


def _variants(w: Column) -> Column:
    """Of an array of words: for each word left out the hash of the rest, then
    the hash of the whole.  Prefixes are taken from blocks of about the root of
    the length, so a long line costs its length to the power 1.5."""
    def of(s):
        block = lambda k: F.slice(s["turned"], k * s["b"] + 1, s["b"])
        blocks = F.transform(F.sequence(F.lit(0), s["b"]), lambda k: _xor(block(k)))
        starts = bound(blocks, lambda xs: F.transform(xs, lambda _, k: _xor(F.slice(xs, F.lit(1), k))))

        def all_of(ahead):
            def less(x, i):
                k = F.floor(i / s["b"]).cast("int")
                before = F.get(ahead, k).bitwiseXOR(_xor(F.slice(s["turned"], k * s["b"] + 1, i - k * s["b"])))
                return s["moved"].bitwiseXOR(before).bitwiseXOR(F.xxhash64(x, i - 1))
            return F.transform(s["w"], less)
        return F.concat(bound(starts, all_of), F.array(_xor(F.transform(s["w"], lambda x, i: F.xxhash64(x, i)))))

    turned = F.transform(w, lambda x, i: F.xxhash64(x, i).bitwiseXOR(F.xxhash64(x, i - 1)))
    moved = _xor(F.transform(w, lambda x, i: F.xxhash64(x, i - 1)))
    return bound(F.struct(w.alias("w"), turned.alias("turned"), moved.alias("moved"),
                          F.ceil(F.sqrt(F.size(w))).cast("int").alias("b")), of)


def _twice(keys: DataFrame, n_keys: int) -> tuple[int, DataFrame]:
    """(bits, words) of a filter of the bits that two or more of `keys` (one
    column) set."""
    bits = filter_width(n_keys)
    at = keys.select(top_bits(bits, keys.columns[0]).alias("at"))
    return bits, written(bit_words(at.groupBy("at").agg(F.count("*").alias("n")).where("n > 1")), "filter")


def _met(rows: DataFrame, key: str, twice: tuple[int, DataFrame]) -> DataFrame:
    """`rows` whose key repeats: the filter lets few others pass, which are
    counted."""
    maybe = written(with_bit(rows, top_bits(twice[0], key), twice[1], "_met").where("_met").drop("_met"), "met")
    groups = maybe.groupBy(key).agg(F.count("*").alias("size")).where("size > 1")
    return join_to_groups(maybe, groups, key, "size", maybe.count()).drop("size")


def dropped_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(k1, k2, place, near) of the lines of docs (id, text) to drop; `near`
    marks those that are no equal copies."""
    names = ["line", "line2"]
    line = [F.xxhash64("words").alias("line"), F.xxhash64(F.lit(2), "words").alias("line2")]
    halves = [f"half{k}" for k in range(4)]
    lines = written(_line_table(docs).select("k1", "k2", "id", "place", *line, F.size("words").alias("n"),
                                             *[h.alias(c) for h, c in zip(_halves(), halves)]), "lines")
    n_lines = lines.count()

    # equal lines are one; lines whose bit no other sets are not shuffled
    bits, bloom = _twice(lines.select("line"), n_lines)
    marked = with_bit(lines, top_bits(bits, "line"), bloom, "_met")
    repeated = written(marked.where("_met").groupBy(*names).agg(
        F.min(_order()).alias("first"), F.count("*").alias("times"), F.min("n").alias("n"), *[F.min(h).alias(h) for h in halves]), "repeated-lines")
    distinct = marked.where("NOT _met").select(*names, _order().alias("first"), F.lit(1).cast("long").alias("times"), "n", *halves).unionByName(repeated)

    # lines that share a half, each with its words, read again at its first place
    at_first = F.xxhash64("first.k1", "first.k2", "first.place").alias("at_first")
    keyed = distinct.where(F.col("n") >= min_words).select(at_first, F.explode(F.array_distinct(F.array(*halves))).alias("half"))
    shared = _met(keyed, "half", _twice(keyed.select("half"), 4 * n_lines))
    near = written(shared.select("at_first").distinct(), "near-lines")
    again = _lines(docs).select("*", F.xxhash64("k1", "k2", "place").alias("at_first"))
    # only these are cut into words; of rows that repeat, or whose hash collides, the first stays
    texts = rows_with(again, "at_first", near, near.count(), "left_semi").select(_order().alias("first"), _words(F.col("text_line")).alias("words"))
    texts = texts.select(*line, "first", "words").groupBy(*names).agg(F.min(F.struct("first", "words")).alias("at")).select(*names, "at.first", "at.words")
    texts = written(texts.select("*", _variants(F.col("words")).alias("variants")), "variants")

    # what is left of the words of variants (`at` the word left out) and whole lines (`at` -1) that may meet
    n_variants = texts.agg(F.coalesce(F.sum(F.size("variants")), F.lit(0))).first()[0]
    twice = _twice(texts.select(F.explode(F.array_distinct("variants")).alias("variant")), n_variants)
    parts = _met(texts.select(*names, F.posexplode("variants").alias("at", "variant")), "variant", twice).select(*names, "at")
    n = F.size("words")
    rest = F.when(F.col("at") == n, F.col("words")).otherwise(F.concat(F.slice("words", F.lit(1), F.col("at")), F.slice("words", F.col("at") + 2, n)))
    marks = written(parts.join(texts.drop("variants"), names).select(
        *names, "first", F.when(F.col("at") == n, -1).otherwise(F.col("at")).alias("at"), F.unhex(F.sha2(F.array_join(rest, " "), 256)).alias("rest")), "marks")
    n_marks = marks.count()

    # one word replaced: later lines than the first of the same place and rest go
    place = F.struct("rest", "at").alias("key")
    cut = marks.where("at >= 0").select(place, *names, "first")
    groups = cut.groupBy("key").agg(F.min("first").alias("earliest"), F.count("*").alias("size")).where("size > 1")
    replaced = join_to_groups(cut, groups, "key", "size", n_marks).where(F.col("first") > F.col("earliest"))
    # one word inserted: of a line and another's equal rest, the later goes
    groups = marks.groupBy("rest").agg(F.min(F.when(F.col("at") < 0, F.col("first"))).alias("whole"),
                                       F.min(F.when(F.col("at") >= 0, F.col("first"))).alias("part"), F.count("*").alias("size"))
    inserted = join_to_groups(marks, groups.where("whole IS NOT NULL AND part IS NOT NULL"), "rest", "size", n_marks).where(
        F.col("first") > F.when(F.col("at") < 0, F.col("part")).otherwise(F.col("whole")))
    gone = replaced.select(*names).unionByName(inserted.select(*names)).distinct().withColumn("near", F.lit(True))

    judged = repeated.where("times > 1").select(*names, "first", "times").join(gone, names, "full")
    judged = written(judged.select(*names, "first", F.coalesce("times", F.lit(1)).alias("times"), F.coalesce("near", F.lit(False)).alias("near")), "judged-lines")
    # lines without a copy or near copy are not shuffled again
    key = F.struct(*names).alias("key")
    rows = rows_with(lines.select(*names, "k1", "k2", "id", "place"), "line", judged.select("line").distinct(), judged.count(), "left_semi")
    rows = join_to_groups(rows.select(key, "k1", "k2", "place", _order().alias("order")), judged.select(key, "first", "near", "times"), "key", "times", n_lines)
    return rows.where(F.col("near") | (F.col("order") > F.col("first"))).select("k1", "k2", "place", "near")


def _cleaned(docs: DataFrame, id_: Column, text: Column, min_words: int) -> DataFrame:
    """`docs` with `cleaned` (the text less its dropped lines), n_lines,
    n_dropped and n_near."""
    gone = dropped_lines(docs.select(id_.alias("id"), text.alias("text")), min_words)
    lists = written(gone.distinct().groupBy("k1", "k2").agg(
        F.collect_set("place").alias("places"), F.sum(F.col("near").cast("long")).alias("near")), "dropped-lines")
    keyed = docs.select(*docs.columns, *_document_key(id_, text))
    touched = lists.select("k1").distinct()
    bits = filter_width(touched.count())
    bloom = written(bit_words(touched.select(top_bits(bits, "k1").alias("at")).distinct()), "filter")
    keyed = with_bit(keyed, top_bits(bits, "k1"), bloom, "_maybe")
    all_lines = F.split(text, "\n")
    n_lines = F.size(F.filter(all_lines, lambda x: F.trim(x, F.lit(WHITE)) != "")).cast("long").alias("n_lines")
    none = F.lit(0).cast("long")
    whole = keyed.where("NOT _maybe").select(*docs.columns, text.alias("cleaned"), n_lines, none.alias("n_dropped"), none.alias("n_near"))
    cut = keyed.where("_maybe").join(lists, ["k1", "k2"], "left")
    places = F.coalesce("places", F.array().cast("array<int>"))
    stay = bound(all_lines, lambda xs: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(xs) - 1), places), lambda k: F.get(xs, k)))
    cut = cut.select(*docs.columns, F.array_join(stay, "\n").alias("cleaned"), n_lines,
                     F.size(places).cast("long").alias("n_dropped"), F.coalesce("near", none).alias("n_near"))
    return whole.unionByName(cut)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per row: doc_id, cleaned (the text without its dropped lines), n_lines
    (lines with a word), n_dropped, n_near (dropped as near copies).

    Lines are what `\\n` splits; words are `[^\\x20\\x09-\\x0D]+`; lines are equal
    when their words are.  Lines without a word stay.  A null text counts as
    empty; a null id comes after all others.  Rows that repeat id and text are
    one document: each gets the same result.  Only id and text are read."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return _cleaned(rows, F.col("doc_id"), F.col("text"), min_words).drop("text")


def without_copied_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of `docs` with the text column cleaned; the others as they are."""
    out = _cleaned(packed(docs), F.col("row")[id_col], text_or_empty(F.col("row")[text_col]), min_words)
    return out.select(*[F.col("cleaned").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
