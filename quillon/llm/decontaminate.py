"""Benchmark decontamination: prefix-filtered set join of word shingles, exact check of item-sized windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import lower_ascii, table, text_or_empty

#: Fixed value: what stands between words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: More windows than this are joined in several passes, so that what is broadcast stays bounded.
MAX_WINDOWS = 100_000


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), GAP, -1), "")


def shingle_key(words: Column, at: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(width)])


def benchmark_windows(items: DataFrame, window: int, width: int, item_col: str, text_col: str) -> DataFrame:
    """(_item, _start, _words, _len, _width): every run of window words of an item; a shorter item is one window."""
    words = items.select(F.col(item_col).alias("_item"), split_words(text_or_empty(text_col)).alias("_all")).filter(F.size("_all") > 0)
    runs = words.withColumn("_len", F.least(F.size("_all"), F.lit(window))).select(
        "_item", "_all", "_len", F.explode(F.sequence(F.lit(0), F.size("_all") - F.col("_len"))).alias("_start")
    )
    return runs.select(
        "_item", "_start", F.slice("_all", F.col("_start") + 1, F.col("_len")).alias("_words"), "_len",
        F.least(F.col("_len"), F.lit(width)).alias("_width"),
    )


def window_shingles(windows: DataFrame, width: int) -> DataFrame:
    """A row for each shingle of each window: _key and its offset _off."""
    spread = windows.filter(F.col("_width") == width).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("_len") - width)).alias("_off")
    )
    return spread.withColumn("_key", shingle_key(F.col("_words"), F.col("_off"), width))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    width: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, item_ids, contaminated.

    A window must occur whole, so all its shingles of width words (or of its own length, if it is
    shorter) must; the prefix that has to be joined is the one shingle that is rarest over all
    documents. Document shingles meet those prefixes by key; the window must then lie inside the
    document at the place that the shingle's offset gives (position and length bounds), and its
    words must equal the document's there. Shingles, join and check run in one pass over the
    documents, without a shuffle of texts: what is broadcast has max_windows windows at most, and a
    larger benchmark takes more passes.

    item_ids are the items with an occurring window, as strings in order. A null text or item has
    no words. Items without words never occur. Rows that repeat both id and text give one row. Other
    columns of either input are not read. Without items all documents are clean; an empty table
    gives an empty result.
    """
    windows = benchmark_windows(items, window, width, item_col, item_text_col)
    shape = windows.groupBy("_width").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each width, so width rows at most
    texts = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text_or_empty(text_col)).alias("_row"), split_words(text_or_empty(text_col)).alias("_doc")
    )
    spots = texts.select("_id", "_row", "_doc", F.posexplode_outer("_doc").alias("_pos", "_word"))
    found = None
    for w, count in sorted((r["_width"], r["n"]) for r in shape):
        parts = -(-count // max_windows)
        key = shingle_key(F.col("_doc"), F.col("_pos"), w)
        inside = F.col("_pos") <= F.size("_doc") - w
        for part in range(parts):
            own = windows.filter(F.pmod(F.xxhash64("_item", "_start"), F.lit(parts)) == part)
            shingles = window_shingles(own, w)
            seen = (
                spots.filter(inside).select(key.alias("_key"))
                .join(F.broadcast(shingles.select("_key").distinct()), "_key")
                .groupBy("_key").agg(F.count(F.lit(1)).alias("_df"))
            )
            rarest = (
                shingles.join(seen, "_key", "left")
                .groupBy("_item", "_start")
                .agg(F.min(F.struct(F.coalesce("_df", F.lit(0)).alias("_df"), "_off", "_key", "_words", "_len")).alias("_p"))
                .filter(F.col("_p._df") > 0)
                .select("_item", F.col("_p._off").alias("_off"), F.col("_p._key").alias("_key"), F.col("_p._words").alias("_words"), F.col("_p._len").alias("_len"))
            )
            at = F.col("_pos") - F.col("_off")
            same = (
                (F.col("_spot") == F.col("_key")) & (at >= 0) & (at + F.col("_len") <= F.size("_doc"))
                & (F.slice("_doc", F.greatest(at, F.lit(0)) + 1, F.col("_len")) == F.col("_words"))
            )
            hits = (
                spots.withColumn("_spot", F.when(inside, key))
                .join(F.broadcast(rarest), same, "left")
                .filter(F.col("_item").isNotNull() | F.coalesce(F.col("_pos") == 0, F.lit(True)))
                .select(
                    "_id", "_row", F.size("_doc").alias("_n"), F.col("_item").cast("string").alias("_item"),
                    F.when(F.col("_item").isNotNull(), F.struct(at.alias("s"), (at + F.col("_len")).alias("e"))).alias("_span"),
                )
            )
            found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = texts.select(
            "_id", "_row", F.size("_doc").alias("_n"), F.lit(None).cast("string").alias("_item"),
            F.lit(None).cast("struct<s:int,e:int>").alias("_span"),
        )
    per_doc = found.groupBy("_id", "_row").agg(
        F.max("_n").alias("_n"), F.collect_set("_item").alias("_items"), F.collect_set("_span").alias("_spans")
    )
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum"))
    joined = lambda acc, x: F.struct(
        F.greatest(acc["end"], x["e"]).alias("end"), (acc["sum"] + F.greatest(F.lit(0), x["e"] - F.greatest(acc["end"], x["s"]))).alias("sum")
    )
    covered = F.aggregate(F.array_sort("_spans"), start, joined, lambda acc: acc["sum"])
    return per_doc.select(
        F.col("_id").alias(id_col),
        F.col("_n").cast("long").alias("n_words"),
        covered.cast("long").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.array_sort("_items").alias("item_ids"),
        (F.size("_items") > 0).alias("contaminated"),
    )


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    got = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated"
    )


OP7_SQL = r"""
with low as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
items as (
  select item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
wins as (
  select distinct item_id, n, array_to_string(w[s:s + n - 1], ' ') as win
  from (select item_id, w, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as s from items where len(w) > 0)),
lens as (select distinct n from wins),
spots as (
  select doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as s from low cross join lens where len(w) >= n)),
hits as (select distinct doc_id, s, spots.n as n, item_id from spots join wins on spots.win = wins.win and spots.n = wins.n),
words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from hits) group by doc_id),
own as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
        from hits group by doc_id)
select low.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from low left join words on low.doc_id = words.doc_id left join own on low.doc_id = own.doc_id
"""
