"""Benchmark decontamination: SimHash item-sized windows, multi-index Hamming search, exact check.

Texts become words (lower case; runs of white space and ASCII punctuation part words). A shingle is five
consecutive words, or the whole item if it is shorter. A document leaks an item if one of its windows of
the item's length has a weighted shingle similarity of ``similarity`` at least: the sum of the smaller
multiplicities over the sum of the larger ones. Of a document shorter than the item, the whole is the window.

Which windows are looked at: two multisets of m and n shingles with similarity t share x >= t(m + n) / (1 + t) of
them, so a window that can pass holds x known shingles of an item of its length, and the first of them
is among its first n - x + 1. Only documents with x shingles of an item, and there only the windows that
begin that close before a known shingle with x - 1 others within reach, are cut out.

Which items they are compared with: every such window gets a SimHash of its shingles, and :func:`search` finds all items
of its length within ``radius`` bits: the 64 bits are eight blocks, fingerprints within the radius agree in one block up
to ``radius // 8`` bits, so the items' blocks are entered with all such neighbours and the windows' blocks are looked up
by equality; nothing within the radius is missed. As windows at the threshold can differ in any number of bits, the
item whose shingles led to a window is compared with it too (``counted``), and so is every document shorter than the
item. All these pairs are verified on their shingles, so no window that can pass is lost.

DataFrame expressions only. The items' shingles are broadcast if
there are at most ``most_broadcast``, and joined by shuffle beyond it. Null and empty texts and items leak
nothing. Equal rows are one document and get equal results; rows sharing an id but not the text are
judged apart; items sharing an id are searched apart and reported under it.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.llm.common import written
from streamlens.llm.simhash import distance, fingerprint, lanes

WIDTH = 5
_BLOCKS, _BLOCK = 8, 8


def words(text: Column) -> Column:
    """Array of words; empty for null or blank text."""
    norm = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\s\p{Punct}]+", " "))
    return F.when(norm == "", F.array().cast("array<string>")).otherwise(F.split(norm, " "))


def _shingles(df: DataFrame, width: int, keep: list[str]) -> DataFrame:
    """Rows (keep..., pos, h): hashes of the shingles of the array column ``words``."""
    n = F.size("words") - (width - 1)
    own = df.where(F.size("words") >= width)
    zipped = F.arrays_zip(*[F.slice("words", F.lit(i + 1), n).alias(f"w{i}") for i in range(width)])
    each = own.select(*keep, F.posexplode(zipped).alias("pos", "z"))
    fields = each.schema["z"].dataType.fieldNames()
    return each.select(*keep, "pos", F.xxhash64(*[F.col("z").getField(f) for f in fields]).alias("h"))


def _blocks(p: Column) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(p, i * _BLOCK).bitwiseAND(F.lit((1 << _BLOCK) - 1)).cast("int").alias("key")) for i in range(_BLOCKS)])


def search(prints: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """Pairs of the rows of ``prints`` and ``items`` (key, size, print) with equal size and at most
    ``radius`` differing bits: rows (the columns of prints, key)."""
    flips = [sum(1 << b for b in bits) for r in range(radius // _BLOCKS + 1) for bits in combinations(range(_BLOCK), r)]
    entries = items.select("key", F.col("size").alias("size_"), F.col("print").alias("print_"), F.explode(_blocks(F.col("print"))).alias("at"))
    entries = entries.select("key", "size_", "print_", F.col("at.block").alias("block_"), F.explode(F.lit(flips)).alias("flip"), F.col("at.key").alias("k_"))
    entries = entries.select("key", "size_", "print_", "block_", F.col("k_").bitwiseXOR(F.col("flip").cast("int")).alias("k_"))
    asked = prints.select("*", F.explode(_blocks(F.col("print"))).alias("at"))
    # each item has hundreds of entries, which the planner does not see: no broadcast
    found = asked.join(entries.hint("merge"), (F.col("at.block") == F.col("block_")) & (F.col("at.key") == F.col("k_")) & (F.col("size") == F.col("size_"))
                       & (distance(F.col("print"), F.col("print_")) <= radius))
    return found.select(*prints.columns, "key").distinct()


def _prints(grams: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., print) from the rows (keys..., h, c) of distinct shingles and their counts."""
    sums = grams.groupBy(*keys).agg(F.sum("c").alias("n"), *lanes(F.col("h"), F.col("c")))
    return sums.select(*keys, fingerprint("n").alias("print"))


def leaks(docs: DataFrame, items: DataFrame, similarity: float = 0.75, most_broadcast: int = 2_000_000, radius: int = 23, counted: bool = True,
          doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (doc_id, row, item_id, start, n_words, similarity): for each document and item it leaks, the
    most similar window (the first of equals), by word position. ``row`` is the hash of the text. Without ``counted``
    only the fingerprints choose the pairs that are verified."""
    own = items.select(F.col(item_id).alias("item_id"), words(F.col(item_text)).alias("words")).where(F.size("words") > 0)
    own = own.withColumn("key", F.xxhash64("item_id", "words")).withColumn("size", F.size("words"))
    own = written(own.dropDuplicates(["key"]), "items")
    read = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("row"), words(F.col(text)).alias("words"))
    read = read.withColumn("length", F.size("words"))
    widths = sorted({min(WIDTH, r.w) for r in own.select(F.least("size", F.lit(WIDTH)).alias("w")).distinct().collect()})
    windows = pairs = None
    for width in widths:
        mine = own.where(F.least("size", F.lit(WIDTH)) == width)
        known = _shingles(mine, width, ["key", "size"]).select("key", F.col("size"), "h").distinct()
        if known.count() <= most_broadcast:
            known = F.broadcast(known)
        hits = _shingles(read, width, ["id", "row", "length"]).withColumnRenamed("h", "h_").join(known, F.col("h_") == F.col("h"))
        n = F.col("size") - (width - 1)
        window_n = F.least("length", "size") - (width - 1)
        need = F.ceil((window_n + n) * (similarity / (1 + similarity)) - 1e-9).cast("int")
        by = hits.groupBy("id", "row", "length", "key", "size").agg(F.collect_set("pos").alias("at")).where(F.size("at") >= need)
        by = by.withColumn("at", F.sort_array("at")).withColumn("n", n).withColumn("need", need)
        first = F.filter("at", lambda p, i: F.get("at", i + F.col("need") - 1) - p <= F.col("n") - 1)
        begins = F.flatten(F.transform(first, lambda p: F.sequence(F.greatest(F.lit(0), p - (F.col("n") - F.col("need"))), p)))
        begins = F.when(F.col("length") < F.col("size"), F.array(F.lit(0))).otherwise(F.array_distinct(begins))
        some = by.select("id", "row", F.explode(begins).alias("start"), F.least("length", "size").alias("size"), "key")
        windows = some if windows is None else windows.unionByName(some)
        counts = _shingles(mine, width, ["key"]).groupBy("key", "h").agg(F.count("*").alias("c"))
        pairs = counts if pairs is None else pairs.unionByName(counts)
    out = "doc_id long, row long, item_id {}, start int, n_words int, similarity double".format(own.schema["item_id"].dataType.simpleString())
    if windows is None:
        return docs.sparkSession.createDataFrame([], out)
    windows = written(windows, "candidates")
    # the words of the windows, cut from their documents
    places = windows.groupBy("id", "row").agg(F.collect_set(F.struct("start", "size")).alias("places"))
    places = places.select(F.col("id").alias("id_"), F.col("row").alias("row_"), "places")
    cut = read.join(places, F.col("id").eqNullSafe(F.col("id_")) & (F.col("row") == F.col("row_"))).select("id", "row", "words", F.explode("places").alias("p"))
    cut = cut.select("id", "row", F.col("p.start").alias("start"), F.col("p.size").alias("size"), F.slice("words", F.col("p.start") + 1, F.col("p.size")).alias("words"))
    cut = written(cut.where(F.size("words") == F.col("size")).distinct(), "windows")
    window = ["id", "row", "start", "size"]
    held = None
    for width in widths:
        some = _shingles(cut.where(F.least("size", F.lit(WIDTH)) == width), width, window).groupBy(*window, "h").agg(F.count("*").alias("c_"))
        held = some if held is None else held.unionByName(some)
    held = written(held, "shingles")
    near = search(_prints(held.select(*window, "h", F.col("c_").alias("c")), window),
                  _prints(pairs, ["key"]).join(own.select(F.col("key").alias("key_"), "size"), F.col("key") == F.col("key_")).drop("key_"), radius)
    found = near.select(*window, "key")
    if counted:
        found = found.unionByName(windows.select(*window, "key")).distinct()
    return _verified(found, held, pairs, own, window, similarity)



def _verified(found: DataFrame, held: DataFrame, pairs: DataFrame, own: DataFrame, window: list[str], similarity: float) -> DataFrame:
    """Of the candidates (window, key), the best that pass on their shingles."""
    asked = found.select(F.struct(*window).alias("w"), F.col("key").alias("key_"))
    grams = held.select(F.struct(*window).alias("w_"), F.col("h").alias("h_"), "c_")
    both = asked.join(grams, F.col("w").eqNullSafe(F.col("w_"))).join(pairs, (F.col("key_") == F.col("key")) & (F.col("h_") == F.col("h")))
    common = both.groupBy("w", "key").agg(F.sum(F.least("c", "c_")).alias("x"))
    named = common.join(own.select(F.col("key").alias("key_"), "item_id", "size"), F.col("key") == F.col("key_"))
    n = F.col("w.size") + F.col("size") - 2 * (F.least("size", F.lit(WIDTH)) - 1)
    named = named.withColumn("similarity", F.col("x") / (n - F.col("x"))).where(F.col("similarity") >= similarity - 1e-12)
    best = named.groupBy("w.id", "w.row", "item_id").agg(F.max(F.struct("similarity", (-F.col("w.start")).alias("s"), F.col("w.size").alias("n"))).alias("best"))
    return best.select(F.col("id").alias("doc_id"), "row", "item_id", (-F.col("best.s")).alias("start"), F.col("best.n").alias("n_words"), F.col("best.similarity").alias("similarity"))


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without the documents that leak an item; all columns stay."""
    bad = leaks(docs, items, doc_id=doc_id, text=text, **how).select(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).distinct()
    return docs.join(bad, F.col(doc_id).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__row")), "left_anti")
