"""Bottom-k sketches of texts' word shingles, by DataFrame operations only.

A text's sketch is the `size` smallest 64-bit hashes of its distinct shingles of five words, in ascending order. The sketch of
a text made of parts is the smallest hashes of the parts' sketches, so sketches are merged without the texts. Of two sketches
the resemblance, the containment and the number of distinct shingles are estimated; they are exact where a text has fewer than
`size` shingles.

Words are runs of anything but white space, in lower case. A text of fewer than five words, but some, has one shingle, the
whole of it. A text without words (empty, blank or null) has an empty sketch: it resembles only its like.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import in_ranges, table

SHINGLE, SIZE = 5, 128
WHITE = " \t\n\x0b\f\r"
_RANGE = float(1 << 64)


def with_sketch(df: DataFrame, text: str, name: str, size: int = SIZE, shingle: int = SHINGLE) -> DataFrame:
    """`df` and its column `name`, the sketch (array of long) of column `text`. A column of that name is replaced.

    A task holds the words of one text at a time.
    """
    words, row = F.col("__words"), F.col("__row")
    plain = F.btrim(F.lower(F.coalesce(row[text], F.lit(""))), F.lit(WHITE))
    hashed = F.when(plain != "", F.transform(F.split(plain, f"[{WHITE}]+"), lambda w: F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
    last = F.size(words) - shingle
    # A word's hash is looked up by its place; the array of hashes is a column, so that it is made once.
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(shingle)]))
    whole = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
    out = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")).select("__row", hashed.alias("__words"))
    found = F.when(last >= 0, runs).otherwise(whole)
    kept = [row[c].alias(c) for c in df.columns if c != name]
    return out.select(*kept, _smallest(found, size).alias(name))


def _smallest(hashes: Column, size: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def merged(sketches: DataFrame, keys: list[str], name: str, size: int = SIZE) -> DataFrame:
    """One sketch of all rows of each key: of a text's parts, or of a source's documents.

    Hashes are counted once and ranked before they are shuffled, so no task gathers more than `size` of them for a key. A key
    whose sketches are all empty has an empty one. Null keys are a key.
    """
    hashes = sketches.select(*keys, F.explode_outer(name).alias("__hash")).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("__hash").asc_nulls_last()))
    least = hashes.withColumn("__rank", rank).where(F.col("__rank") <= size)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("__hash")).alias(name))


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of common shingles among all of two texts, 0 to 1; two texts without words have 1."""
    union = _smallest(F.concat(a, b), size)
    shared = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, 1.0).otherwise(shared / F.size(union))


def distinct_shingles(sketch: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles (double)."""
    span = (F.element_at(sketch, size).cast("double") + F.lit(_RANGE / 2)) / _RANGE
    return F.when(F.size(sketch) < size, F.size(sketch).cast("double")).otherwise((size - 1) / span)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of the first text's shingles that the second one has, 0 to 1; 1 where the first has none."""
    both = resemblance(a, b, size) * distinct_shingles(_smallest(F.concat(a, b), size), size)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, size)))


def as_text(sketch: Column) -> Column:
    """16 hexadecimal digits for each hash; equal sketches give equal strings."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def from_text(text: Column) -> Column:
    """The sketch that `as_text` wrote."""
    places = F.sequence(F.lit(0), F.floor(F.length(text) / 16).cast("int") - 1)
    # A negative base gives a signed number.
    hashes = F.transform(places, lambda i: F.conv(F.substring(text, i * 16 + 1, F.lit(16)), 16, -10).cast("long"))
    return F.when(text != "", hashes).otherwise(F.array().cast("array<bigint>"))


def _following(keys: DataFrame) -> DataFrame:
    """keys (key, id, ...) and `after`: the next key by descending id (nulls last), then by key; the first one's for the last.

    Only the keys are put in order, in ranges; each range's first key is the one after the range before.
    """
    order = [F.col("id").desc_nulls_last(), F.col("key")]
    ranged = in_ranges(keys, *order)
    down = -F.col("id").cast("decimal(20,0)")
    first = F.min_by("key", F.struct(F.col("id").isNull().alias("none"), down.alias("down"), "key"))
    heads = ranged.groupBy("range").agg(first.alias("head"))
    ring = Window.orderBy("range")  # one row for each range
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("range", F.coalesce(F.lead("head").over(ring), F.first("head").over(whole)).alias("beyond"))
    after = F.lead("key").over(Window.partitionBy("range").orderBy(*order))
    return ranged.withColumn("after", after).join(F.broadcast(heads), "range").withColumn("after", F.coalesce("after", "beyond")).drop("range", "beyond")


def edited(documents: DataFrame, size: int = SIZE) -> DataFrame:
    """Each document beside its edited text, whose last third is the first code points of the next document.

    documents: doc_id, text (null: empty); other columns are not read. The next document is the one with the next smaller
    doc_id; null ids follow all others, and the first document follows the last. Rows of one id with different texts follow
    each other in the order of their digests; rows alike in id and text are one document, given once.
    Returns doc_id, copies (rows alike), text, edited, sketch (of text), edited_sketch, next_sketch. An empty table gives no rows.

    The texts are shuffled once, by a digest of id and text, after map-side merging of equal rows. Both the join that cuts the
    next document's beginning and the one that brings it to the edited document read that shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), text)
    # Never null, so that no join has to look for nulls by digesting once more.
    key = F.coalesce(F.unhex(F.sha2(name.cast("binary"), 256)), F.lit(b""))
    rows = documents.select(key.alias("key"), F.col("doc_id").alias("id"), text.alias("text"))
    keys = rows.groupBy("key").agg(F.max("id").alias("id"), F.max(F.length("text")).alias("n"), F.count("*").alias("copies"))
    links = table(_following(keys).withColumn("third", F.expr("n div 3").cast("int")), "links")
    # Both joins take the same columns, so that the second one reads the first one's shuffle.
    once = rows.groupBy("key").agg(F.first("text").alias("text"))
    nexts = once.select(F.col("key").alias("after"), F.col("text").alias("next")).join(links, "after")
    nexts = nexts.select("key", "id", "copies", "third", F.substring("next", F.lit(1), F.col("third")).alias("head"), "next")
    nexts = with_sketch(nexts, "next", "next_sketch", size).drop("next")
    kept = F.substring("text", F.lit(1), F.length("text") - F.col("third"))
    pairs = once.join(nexts, "key").select(F.col("id").alias("doc_id"), "copies", "text", F.concat(kept, "head").alias("edited"), "next_sketch")
    return with_sketch(with_sketch(pairs, "text", "sketch", size), "edited", "edited_sketch", size)


def repeated(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Each row as often as its column `copies` says, without that column; 65,536 of them are made at a time."""
    others = [c for c in df.columns if c != copies]
    block = df.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / 65536))))
    count = F.least(F.lit(65536), F.col(copies) - 65536 * F.col("__block")).cast("int")
    return block.withColumn("__copy", F.explode(F.sequence(F.lit(1), count))).select(*others)
