"""Benchmark decontamination: containment search with MinHash, documents partitioned by size.

A test item is short and a document may be long, so their Jaccard similarity is low even where the item is wholly
contained. The documents are therefore partitioned by the number of their shingles, and each partition gets a
MinHash signature as long as its size asks for: a one-permutation signature, which deals the hash values into
``bins`` equal ranges and keeps the least value of each. ``bins`` is a power of two times the partition's upper
size, chosen so that an item which is contained just as far as the threshold asks, and as short as the shortest item, is
missed with a probability of ``miss`` at most. Items get one signature for each partition's ``bins``. A
document and an item that agree in any bin are a candidate pair; exact sets of shingles decide.

Shingles are of ``width`` words; words are runs of letters and digits, in lower case. Everything is DataFrame
expressions: the documents' signatures are never shuffled where the items' are small enough to broadcast
(``broadcast_rows``, checked), and are joined by a shuffle where they aren't.

An item of fewer than ``width`` words is one shingle of its own length, and is looked up among the documents' runs of that length; the
documents are cut into such runs only where there are such items.

Defined cases: a null text has no words, and an item without words is never found;
a null id is an id like others; equal ids are kept apart by text; empty tables give no rows; columns other than those named are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquilt.llm.common import let, materialize, table

#: The largest size that the size partitions tell apart, as a power of two.
MOST = 40


def plain_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(words: Column, width: int) -> Column:
    """The distinct 64-bit hashes of all runs of ``width`` words."""
    return let(
        words,
        lambda w: F.array_distinct(
            F.transform(
                F.when(F.size(w) >= width, F.sequence(F.lit(1), F.size(w) - (width - 1))).otherwise(F.array().cast("array<int>")),
                lambda i: F.xxhash64(F.slice(w, i, width)),
            )
        ),
    )


def shingle_texts(words: Column, width: int) -> Column:
    return let(
        words,
        lambda w: F.array_distinct(
            F.transform(
                F.when(F.size(w) >= width, F.sequence(F.lit(1), F.size(w) - (width - 1))).otherwise(F.array().cast("array<int>")),
                lambda i: F.array_join(F.slice(w, i, width), " "),
            )
        ),
    )


def bins_shift(shortest: int, threshold: float, miss: float) -> int:
    """By how many powers of two the bins outnumber the largest size of a partition.

    With ``x`` = shingles a bin, a shingle is the least of its bin with probability (1 - e^-x) / x at least; ``shared``
    of them must all fail for a miss.
    """
    shared = max(1, math.ceil(threshold * shortest))
    for shift in range(0, 16):
        x = 2.0**-shift
        if (1 - (1 - math.exp(-x)) / x) ** shared <= miss:
            return shift
    return 16


def signature(hashes: Column, log_bins: Column) -> Column:
    """The least hash of each of ``2 ** log_bins`` ranges that holds any."""
    return let(
        F.sort_array(hashes),
        lambda s: F.filter(s, lambda h, i: (i == 0) | (F.call_function("shiftright", h, F.lit(64) - log_bins) != F.call_function("shiftright", F.get(s, i - 1), F.lit(64) - log_bins))),
    )


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = 5,
    threshold: float = 0.8,
    miss: float = 1e-5,
    broadcast_rows: int = 500_000,
    keep_hash: bool = False,
) -> DataFrame:
    """Pairs of document and item: ``doc_id``, ``item_id``, ``shared``, ``item_shingles`` and ``containment``; with ``keep_hash`` also ``hash``,
    xxhash64 of the document's text, which tells documents of one id apart."""
    item = materialize(
        items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("t")).distinct()
        .select("item_id", shingle_texts(plain_words(F.col("t")), width).alias("item_set"), shingle_hashes(plain_words(F.col("t")), width).alias("h"))
        .where(F.size("h") > 0),
        "items",
    )
    n_items, shortest = item.agg(F.count("*"), F.min(F.size("h"))).first()
    shift = bins_shift(shortest or 1, threshold, miss)
    size_class = lambda n: F.ceil(F.log2(n.cast("double"))).cast("int")  # noqa: E731  sizes in (2^(c-1), 2^c]

    doc = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("t"))
    signed = (
        doc.select("doc_id", F.xxhash64("t").alias("v"), shingle_hashes(plain_words(F.col("t")), width).alias("h"))
        .select("doc_id", "v", "h", size_class(F.size("h")).alias("c"))
        .select("doc_id", "v", "c", F.explode(signature(F.col("h"), F.least(F.col("c") + shift, F.lit(MOST)))).alias("m"))
    )
    keys = item.select("item_id", "h", F.explode(F.sequence(F.lit(0), F.lit(MOST - shift))).alias("c")).select(
        "item_id", "c", F.explode(signature(F.col("h"), F.least(F.col("c") + shift, F.lit(MOST)))).alias("m")
    )
    keys = materialize(keys.groupBy("c", "m").agg(F.collect_set("item_id").alias("item_ids")), "item-keys")
    small = keys.count() <= broadcast_rows
    pairs = materialize(
        signed.join(F.broadcast(keys) if small else keys, ["c", "m"]).select("doc_id", "v", F.explode("item_ids").alias("item_id")).distinct(), "candidates"
    )
    # only documents with a candidate are read with their texts again
    per_doc = materialize(pairs.groupBy("doc_id", "v").agg(F.collect_set("item_id").alias("item_ids")), "candidate-docs")
    n_docs = per_doc.count()
    with_text = doc.join(
        F.broadcast(per_doc) if n_docs <= broadcast_rows // 10 else per_doc,
        doc["doc_id"].eqNullSafe(per_doc["doc_id"]) & (F.xxhash64(doc["t"]) == per_doc["v"]),
    )
    held = with_text.select(doc["doc_id"].alias("doc_id"), "v", shingle_texts(plain_words(doc["t"]), width).alias("doc_set"), F.explode("item_ids").alias("item_id"))
    sized = F.size(F.array_intersect("doc_set", "item_set"))
    found = (
        held.join(F.broadcast(item) if n_items <= broadcast_rows // 10 else item, "item_id")
        .select("doc_id", "v", "item_id", sized.cast("long").alias("shared"), F.size("item_set").cast("long").alias("item_shingles"))
        .where(F.col("shared") >= F.ceil(F.lit(threshold) * F.col("item_shingles") - 1e-9))
    )
    brief = items.select(F.col(item_id).alias("item_id"), plain_words(F.col(item_text)).alias("w")).where(F.size("w").between(1, width - 1))
    brief = materialize(brief.select("item_id", F.size("w").alias("n"), F.array_join("w", " ").alias("s")).distinct(), "brief-items")
    n_brief = brief.count()
    for n in sorted(r["n"] for r in brief.select("n").distinct().collect()):  # below ``width``
        runs = doc.select("doc_id", F.xxhash64("t").alias("v"), F.explode(shingle_texts(plain_words(F.col("t")), n)).alias("s"))
        own = brief.where(F.col("n") == n).select("item_id", "s")
        one = F.lit(1).cast("long")
        found = found.unionByName(runs.join(F.broadcast(own) if n_brief <= broadcast_rows else own, "s").select("doc_id", "v", "item_id", one.alias("shared"), one.alias("item_shingles")))
    found = found.withColumn("containment", F.col("shared") / F.col("item_shingles"))
    return (found.withColumnRenamed("v", "hash") if keep_hash else found.drop("v")).distinct()


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item of which it holds 0.8 of the five-word shingles or more."""
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item; rows that share an id, or have none, are judged each by its own text."""
    found = contained_items(docs, table(spark, sf_dir, "benchmark"), keep_hash=True).select(F.col("doc_id").alias("leak_id"), F.col("hash").alias("leak_hash")).distinct()
    found = materialize(found, "leaks")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["leak_id"]) & (F.xxhash64(docs["text"]) == found["leak_hash"]), "left_anti")


_SHINGLES = """
  SELECT DISTINCT {id}, unnest(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i+4], ' '))) AS s
  FROM (SELECT {id}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {table})
"""
LEAKS_SQL = f"""
WITH d AS ({_SHINGLES.format(id="doc_id", table="DOCS")}),
b AS ({_SHINGLES.format(id="item_id", table="benchmark")}),
n AS (SELECT item_id, count(*) AS item_shingles FROM b GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, any_value(item_shingles) AS item_shingles,
       count(*) / any_value(item_shingles)::DOUBLE AS containment
FROM d JOIN b USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id
HAVING count(*) >= 0.8 * any_value(item_shingles) - 1e-9
UNION SELECT doc_id, item_id, 1, 1, 1.0
FROM (SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> ''), ' ') AS dw FROM DOCS) x
JOIN (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM benchmark) y
ON len(w) BETWEEN 1 AND 4 AND contains(' ' || dw || ' ', ' ' || array_to_string(w, ' ') || ' ')
"""
OP3_SQL = LEAKS_SQL.replace("DOCS", "documents")
