r"""Benchmark decontamination: size-partitioned MinHash containment search (DataFrame functions only).

A test item is found in a document when at least 0.8 of the item's distinct 5-word shingles occur in the document,
however long the document is. An item of 1 to 4 words has one shingle, of all its words. Words are runs of letters and
digits of the lower-cased text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicell.llm.base import materialize, table, text_or_empty

WIDTH, THRESHOLD_PERCENT = 5, 80
#: Broadcast the items' side of a join up to this many rows (about 100 bytes each); beyond it the join is a shuffle.
BROADCAST_ROWS = 500_000


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def _zipped(width: int) -> str:
    return "arrays_zip(" + ", ".join(f"slice(_w, {k}, size(_w) - {width - 1})" for k in range(1, width + 1)) + ")"


def with_shingle_hashes(df: DataFrame, out: str, width: int = WIDTH, text_col: str = "text") -> DataFrame:
    """Add the distinct 64-bit hashes of the text's shingles; texts of fewer words have none."""
    args = ", ".join(f"z.`{k}`" for k in range(width))
    return (
        df.withColumn("_w", _words(F.col(text_col)))
        .withColumn(out, F.expr(f"if(size(_w) < {width}, array(), array_distinct(transform({_zipped(width)}, z -> xxhash64({args}))))"))
        .drop("_w")
    )


def with_shingles(df: DataFrame, out: str, width: int = WIDTH, text_col: str = "text") -> DataFrame:
    """Add the distinct shingles as strings."""
    args = ", ".join(f"z.`{k}`" for k in range(width))
    return (
        df.withColumn("_w", _words(F.col(text_col)))
        .withColumn(out, F.expr(f"if(size(_w) < {width}, cast(array() AS array<string>), array_distinct(transform({_zipped(width)}, z -> concat_ws(' ', {args}))))"))
        .drop("_w")
    )


def _sized(df: DataFrame) -> DataFrame:
    """A broadcast hint for a small side, once its rows have been counted."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def item_sketches(items: DataFrame, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """(item, n, size_class, h): the bottom-k MinHash sketch of every item, k by the item's size class.

    Size class c holds items of 2^(c-1) < n <= 2^c shingles. An item that is contained to ``percent`` lacks at most
    (1 - percent) of 2^c shingles, so of the k smallest hashes, k being one more than that, at least one occurs in the
    document: the search misses nothing.
    """
    sized = items.withColumn("n", F.size("_h")).filter("n > 0").withColumn("size_class", F.ceil(F.log2("n")).cast("int"))
    k = F.expr(f"shiftleft(1, size_class) * {100 - percent} div 100 + 1").cast("int")
    return sized.withColumn("_k", k).select("item", "n", "size_class", F.explode(F.expr("slice(sort_array(_h), 1, least(n, _k))")).alias("h"))


def find_contaminated(docs: DataFrame, items: DataFrame, percent: int = THRESHOLD_PERCENT, width: int = WIDTH, doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """Pairs (doc_id, fp, item_id, n_shingles, n_found, containment) with containment of at least ``percent``.

    fp is a hash of the document's text, which tells apart rows that share an id; repeated rows give one pair. First
    every document's shingle hashes probe the items' sketches, within the size classes that the document can hold
    (it needs ``percent`` of the item's shingles itself). Then only the documents with a candidate are read again and
    their shingles compared with the items' as strings. Shuffled are hits, candidate texts and pairs; a document's
    shingles are exploded where they are and meet the small side of the join there. Items of fewer than ``width`` words
    are searched by shingles of their own width, with a pass over the documents for each width that occurs.

    Null and empty texts have no words and are in no pair, as documents or as items; null ids are kept as ids; tables
    without rows give no pairs; other columns are ignored.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_or_empty()).alias("fp"), text_or_empty().alias("text"))
    tests = items.select(F.struct(F.col(item_id).alias("id"), F.xxhash64(text_or_empty()).alias("fp")).alias("item"), text_or_empty().alias("text")).distinct()
    tests = materialize(tests.withColumn("_width", F.least(F.size(_words(F.col("text"))), F.lit(width))).filter("_width > 0"), "benchmark-items")
    widths = sorted(r[0] for r in tests.select("_width").distinct().collect())  # at most ``width`` of them
    found = [_find(own, tests.filter(F.col("_width") == w).drop("_width"), percent, w) for w in widths or [width]]
    return reduce(DataFrame.unionByName, found)


def _find(own: DataFrame, tests: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs of items that have at least ``width`` words, by shingles of that width."""
    sketches = materialize(item_sketches(with_shingle_hashes(tests, "_h", width), percent), "item-sketches")
    # explode_outer: for explode, the optimizer would add a filter on the array and evaluate the array twice.
    hashed = with_shingle_hashes(own, "_h", width).select("doc_id", "fp", F.size("_h").alias("_n"), F.explode_outer("_h").alias("h"))
    hits = hashed.join(_sized(sketches), "h").filter(F.col("_n") * 100 >= F.col("n") * percent)
    candidates = materialize(hits.select("doc_id", "fp").distinct(), "contamination-candidates").withColumnsRenamed({"doc_id": "_doc", "fp": "_fp"})
    read_again = own.join(candidates, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("fp") == F.col("_fp")), "left_semi").dropDuplicates(["doc_id", "fp"])
    exact = with_shingles(tests, "_s", width).select("item", F.size("_s").alias("n_shingles"), F.explode("_s").alias("shingle"))
    shingles = with_shingles(read_again, "_s", width).select("doc_id", "fp", F.explode_outer("_s").alias("shingle"))
    counted = shingles.join(_sized(exact), "shingle").groupBy("doc_id", "fp", "item", "n_shingles").agg(F.count("*").alias("n_found"))
    return counted.filter(F.col("n_found") * 100 >= F.col("n_shingles") * percent).select(
        "doc_id", "fp", F.col("item.id").alias("item_id"), F.col("n_shingles").cast("long").alias("n_shingles"), "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no item is found, all columns as they are."""
    found = find_contaminated(docs, items).select(F.col("doc_id").alias("_doc"), F.col("fp").alias("_fp")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64(text_or_empty()) == F.col("_fp"))
    return docs.join(materialize(found, "contaminated"), same, "left_anti")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("fp")


def contamination_ctes(docs: str) -> str:
    """CTEs up to found(doc_id, text, item_id, n_shingles, n_found)."""
    grams = "list_distinct(list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i:i + width - 1], ' ')))"
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
    return f"""
item_lists AS (SELECT *, {grams} AS s FROM (SELECT *, least(len(w), {WIDTH}) AS width FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text, {words} AS w FROM benchmark)) WHERE width > 0),
item_grams AS (SELECT item_id, text AS item_text, width, len(s)::BIGINT AS n_shingles, unnest(s) AS g FROM item_lists),
doc_grams AS (SELECT doc_id, text, width, unnest({grams}) AS g FROM (SELECT DISTINCT doc_id, coalesce(text, '') AS text, {words} AS w FROM {docs}), (SELECT DISTINCT width FROM item_lists)),
found AS (SELECT doc_id, text, item_id, n_shingles, count(*)::BIGINT AS n_found FROM doc_grams JOIN item_grams USING (width, g)
  GROUP BY doc_id, text, item_id, item_text, n_shingles HAVING count(*) * 100 >= n_shingles * {THRESHOLD_PERCENT})"""


OP8_SQL = f"WITH {contamination_ctes('documents')} SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment FROM found"
