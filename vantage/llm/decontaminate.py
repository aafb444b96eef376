"""Benchmark decontamination by winnowing, in DataFrame functions alone.

The windows of an item are its runs of ``n`` words (an item of fewer words is one
window).  Fingerprints: every run of ``k`` words is hashed; of every window the least
of its ``n - k + 1`` hashes is taken, and neighbouring windows mostly take the same.
Two texts that share a window share its fingerprint, so joining the fingerprints
of documents and items misses no shared window.  A fingerprint that hits is then
extended: the windows that took it are cut out of the document and joined to the
items' windows as whole strings, which makes the result exact.  Items shorter
than ``n`` words are looked up by the hash of all their words.

Fingerprints are exploded from arrays within the row, so the only rows that move are
those that hit; the fingerprints of the items are a written table, so Spark knows its
size and broadcasts it only below its threshold.

Cases: null texts have no words and hit nothing; items without words have no window;
an item without an id marks words but is not listed; items with the same id are one
item; rows with the same id and text get the same result each; empty tables give
no hits (or no rows); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.common import materialize

#: words of a fingerprint
GRAM = 6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once a row even where a lambda inside
    ``body`` names it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _starts(array: Column, size: int) -> Column:
    """0, 1, ...: where a run of ``size`` elements may start."""
    return F.when(F.size(array) >= size, F.sequence(F.lit(0), F.size(array) - size)).otherwise(
        F.array().cast("array<int>"))


def _marks(text: Column, n: int, short: list[int], whole: bool = False) -> Column:
    """Array of (fp, a, b, size): windows a to b of ``size`` words took ``fp``.  ``short``:
    further sizes, looked up as they are; ``whole``: only if they are all of the words."""
    mark = lambda fp, a, b, size: F.struct(
        fp.alias("fp"), a.alias("a"), b.alias("b"), F.lit(size).alias("size"))

    def of_size(w: Column, size: int) -> Column:
        return F.transform(_starts(w, size), lambda i: mark(
            F.xxhash64(*(F.get(w, i + j) for j in range(size))), i, i, size))

    def of_words(w: Column) -> Column:
        grams = F.transform(_starts(w, GRAM), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(GRAM))))
        winnowed = _let(grams, lambda g: _let(
            F.transform(_starts(w, n), lambda i: F.least(*(F.get(g, i + j) for j in range(n - GRAM + 1)))),
            lambda least: _let(
                F.filter(_starts(w, n), lambda i: (i == 0) | (F.get(least, i) != F.get(least, i - 1))),
                lambda first: F.transform(first, lambda a, x: mark(
                    F.get(least, a), a, F.coalesce(F.get(first, x + 1), F.size(least)) - 1, n)))))
        plain = [of_size(w, size) for size in short]
        if whole:
            plain = [F.when(F.size(w) == size, p).otherwise(F.slice(p, 1, 0)) for size, p in zip(short, plain)]
        return F.concat(winnowed, *plain) if plain else winnowed

    return _let(words(text), of_words)


def _windows(text: Column, marks: Column) -> Column:
    """Array of (at, size, span): the marked windows as strings."""
    return _let(words(text), lambda w: F.flatten(F.transform(marks, lambda m: F.transform(
        F.sequence(m["a"], m["b"]), lambda i: F.struct(
            i.alias("at"), m["size"].alias("size"), F.array_join(F.slice(w, i + 1, m["size"]), " ").alias("span"))))))


def decontaminate(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", n: int = 10) -> DataFrame:
    """Per row of ``df``: id, text_hash (xxhash64 of the text), n_words, n_hit, n_items, ``items`` (ids as sorted strings),
    ``contaminated``."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.select(F.struct("id", F.xxhash64("text").alias("hash")).alias("key"), "text")  # equal also on null ids

    tests = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    sizes = tests.select(F.least(F.size(words(F.col("text"))), F.lit(n)).alias("size")).distinct()
    short = sorted(r["size"] for r in sizes.collect() if 0 < r["size"] < n)  # at most n - 1 numbers
    of_items = _marks(F.col("text"), n, short, whole=True)
    prints = materialize(tests.select(F.explode(of_items).alias("m")).select("m.fp", "m.size").distinct(), "prints")
    spans = materialize(tests.select("item", F.explode(_windows(F.col("text"), of_items)).alias("s"))
                        .select("s.span", "s.size", "item").distinct(), "spans")

    marks = docs.select("key", F.explode(_marks(F.col("text"), n, short)).alias("m")).select("key", "m.*")
    hits = (marks.join(prints, ["fp", "size"]).groupBy("key")
            .agg(F.collect_set(F.struct("a", "b", "size")).alias("marks")))  # equal rows add nothing
    near = docs.join(hits, "key").select("key", F.explode(_windows(F.col("text"), F.col("marks"))).alias("s"))
    found = materialize(near.select("key", "s.*").join(spans, ["span", "size"])
                        .select("key", "at", "size", "item").distinct(), "found")

    order = Window.partitionBy("key").orderBy("at", "size")
    before = F.max(F.col("at") + F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("at") + F.col("size") - F.greatest(F.coalesce(before, F.lit(0)), F.col("at"))
    covered = (found.select("key", "at", "size").distinct()
               .withColumn("fresh", F.greatest(fresh, F.lit(0)))
               .groupBy("key").agg(F.sum("fresh").alias("n_hit")))
    listed = found.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))

    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listing = F.coalesce("items", F.array().cast("array<string>"))
    return (docs.select("key", F.size(words(F.col("text"))).cast("long").alias("n_words"))
            .join(covered.join(listed, "key"), "key", "left")
            .select(F.col("key.id").alias(id_col), F.col("key.hash").alias("text_hash"), "n_words", hit.alias("n_hit"),
                    F.size(listing).cast("long").alias("n_items"), listing.alias("items"),
                    (hit > 0).alias("contaminated")))
