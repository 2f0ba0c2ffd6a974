r"""Line-first quality rules (DataFrame functions only).

Every ``\n``-split line with a word is judged on its own; failing lines are removed; a document that loses too much of
its text that way, or fails the base rules, is rejected. All sums are over whole texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicell.llm.base import SPACE, table, text_or_empty

#: Base rules: fewest words, and the most words (per cent) that may lie in repeated 3-word windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A document is rejected when more than this part (per cent) of the characters of its lines was removed.
MAX_LOST_PERCENT = 50
#: Lower-case phrases that mark a line as boilerplate, in the languages of the corpus (English, German, French, Spanish).
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of service", "terms of use", "enable javascript", "lorem ipsum", "sign up for our newsletter", "skip to content", "click here to subscribe",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "newsletter abonnieren", "zum inhalt springen",
    "tous droits réservés", "politique de confidentialité", "conditions d’utilisation", "mentions légales", "aller au contenu",
    "todos los derechos reservados", "política de privacidad", "política de cookies", "términos de uso", "saltar al contenido",
)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _without(col: Column, chars: str) -> Column:
    """Without some ASCII characters: a byte search for each is far cheaper than a look-up for each code point."""
    for c in chars:
        col = F.replace(col, F.lit(c), F.lit(""))
    return col


def _count(col: Column, chars: str) -> Column:
    return F.octet_length(col) - F.octet_length(_without(col, chars))


def _words(col: Column) -> Column:
    """Words of a line that has one: its inner separators plus one, where no two of them are neighbours."""
    inner = F.trim(col, F.lit(SPACE))
    return F.when(inner.rlike(r"[\x20\x09-\x0D]{2}"), F.size(F.split(inner, r"[\x20\x09-\x0D]+", -1))).otherwise(_count(inner, SPACE) + 1)


def line_fails(line: Column) -> Column:
    """Navigation, punctuation, shouting and boilerplate rules for one line that has a word; the cheap tests come first."""
    words, pipes = _words(line), _count(line, "|")
    navigation = ((pipes >= 2) & (pipes * 4 >= words)) | (~line.rlike("[.!?:;,]") & (words <= 3))
    punctuation = line.rlike("[#*$%&<>!]") & (_count(line, "#*$%&<>!") * 3 > words)
    upper = F.length(line) - F.length(F.regexp_replace(line, "[A-Z]+", ""))
    shouting = (upper * 2 > F.length(line)) & (words >= 5)
    # One element, so that the lower-case line is made once for all phrases.
    boilerplate = F.exists(F.array(F.lower(line)), lambda low: reduce(lambda a, b: a | b, (low.contains(p) for p in BOILERPLATE)))
    return navigation | punctuation | shouting | boilerplate


def _has_word(line: Column) -> Column:
    return F.trim(line, F.lit(SPACE)) != ""


def judge_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    r"""Add clean_text (the text without failing lines), n_chars_kept, n_chars_lines and lost_too_much.

    Lines without a word pass and stay where they are. A null text stays null and loses nothing; a text without words
    loses nothing; the input's other columns pass through (its columns of the four new names are replaced).
    """
    out = docs.withColumn("_lines", F.split(text_or_empty(text_col), "\n", -1))
    out = out.withColumn("_kept_lines", F.filter("_lines", lambda x: ~_has_word(x) | ~line_fails(x)))
    size = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda n, x: n + F.when(_has_word(x), F.length(x)).otherwise(0))
    out = out.withColumns(
        {
            "clean_text": F.when(F.col(text_col).isNotNull(), F.array_join("_kept_lines", "\n")),
            "n_chars_lines": size("_lines"),
            "n_chars_kept": size("_kept_lines"),
        }
    ).drop("_kept_lines", "_lines")
    lost = F.col("n_chars_lines") - F.col("n_chars_kept")
    return out.withColumn("lost_too_much", lost * 100 > F.col("n_chars_lines") * MAX_LOST_PERCENT)


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    r"""Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    n_repeat_words counts the words covered by 3-word windows found twice or more in the text. Windows are told apart
    by a 64-bit hash; a text without repeats (the distinct hashes are as many as the hashes) skips the sort that finds
    where the repeats are. Null and empty texts: all counts 0, base_failed true.
    """
    text = text_or_empty(text_col)
    inner = F.trim(text, F.lit(SPACE))
    out = docs.withColumn("_words", F.when(inner != "", F.split(inner, r"[\x20\x09-\x0D]+", -1)).otherwise(F.array().cast("array<string>")))
    out = out.withColumn("_n", F.size("_words"))
    # Neighbours meet by zipping shifted slices: a lambda that reached outside its own arrays would be evaluated anew
    # for every element once the optimizer has merged these projections.
    shifted = ", ".join(f"slice(_words, {k}, _n - 2)" for k in (1, 2, 3))
    out = out.withColumn("_grams", F.expr(f"if(_n < 3, array(), transform(arrays_zip({shifted}), z -> xxhash64(z.`0`, z.`1`, z.`2`)))"))
    out = out.withColumn("_sorted", F.expr("if(size(array_distinct(_grams)) < size(_grams), sort_array(transform(_grams, (h, i) -> struct(h AS h, i AS i))), NULL)"))
    pairs = "zip_with(slice(_sorted, 1, size(_sorted) - 1), slice(_sorted, 2, size(_sorted) - 1), (x, y) -> if(x.h = y.h, array(x.i, y.i), array()))"
    out = out.withColumn("_starts", F.expr(f"sort_array(flatten(filter({pairs}, x -> size(x) > 0)))"))
    covered = F.expr("aggregate(_starts, struct(-3 AS last, 0 AS n), (a, i) -> struct(i AS last, a.n + least(3, i - a.last) AS n), a -> a.n)")
    out = out.withColumn("_lines", F.filter(F.split(text, "\n", -1), _has_word))
    out = out.withColumns(
        {
            "n_words": F.col("_n").cast("long"),
            "word_chars": F.length(_without(text, SPACE)).cast("long"),
            "n_symbols": _count(text, "#*$%&|<>").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        }
    ).drop("_words", "_n", "_grams", "_sorted", "_starts", "_lines")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def clean_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Both judgements: base_counts, judge_lines and kept (passes both). Rows are never dropped here."""
    judged = judge_lines(base_counts(docs, text_col), text_col).withColumn("_row", F.monotonically_increasing_id())
    # The row number (never negative) keeps a later filter on kept above these projections; pushed below them, it would
    # evaluate every array expression once for each mention.
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.col("lost_too_much") & (F.col("_row") >= 0)).drop("_row")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _sql_count(x: str, chars: str) -> str:
    return f"(length({x}) - length(translate({x}, '{chars}', '')))"


_SP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_TRIM = f"trim(x, {_SP})"
_W = r"len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))"
_LOW = "lower(x)"
_FAILS = f"""(({_sql_count("x", "|")} >= 2 AND {_sql_count("x", "|")} * 4 >= {_W}) OR ({_W} <= 3 AND {_sql_count("x", ".!?:;,")} = 0)
  OR ({_sql_count("x", "#*$%&<>")} + {_sql_count("x", "!")}) * 3 > {_W}
  OR ({_W} >= 5 AND {_sql_count("x", UPPER)} * 2 > length(x))
  OR {" OR ".join(f"contains({_LOW}, '{p}')" for p in BOILERPLATE)})"""
#: One row for each document: t (its text, null as empty), the counts, and its lines with a word.
RULES_CTE = f"""
texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {{docs}}),
lined AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: {_TRIM} <> '') AS wl,
    list_filter(string_split(t, chr(10)), lambda x: {_TRIM} = '' OR NOT {_FAILS}) AS kl,
    regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM texts),
grams AS (SELECT rid, i, w[i:i + 2] AS g, len(w) AS n FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM lined)),
twice AS (SELECT rid, i, n FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
counted AS (SELECT l.*, len(w)::BIGINT AS n_words, length(translate(t, {_SP}, ''))::BIGINT AS word_chars,
    {_sql_count("t", "#*$%&|<>")}::BIGINT AS n_symbols, (len(wl) - len(list_distinct(wl)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(list_sum(list_transform(wl, lambda x: length(x))), 0) AS c_all,
    coalesce(list_sum(list_transform(kl, lambda x: CASE WHEN {_TRIM} = '' THEN 0 ELSE length(x) END)), 0) AS c_kept
  FROM lined l LEFT JOIN covered USING (rid)),
ruled AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
    (c_all - c_kept) * 100 > c_all * {MAX_LOST_PERCENT} AS lost FROM counted)
"""
OP5_SQL = f"""
WITH {RULES_CTE.replace("{docs}", "documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT lost AS kept FROM ruled
"""
