"""Document fingerprints: a threshold-scaled sketch of word shingles, in DataFrame functions only.

The sketch of a text keeps the hash of every distinct five-word shingle that lies below a fixed fraction of the hash
range, whatever the text's length. Sketches merge by union, and the share of one sketch's hashes found in another
estimates the containment of very unequal documents without bias. A short text may keep no hash at all; beside the
sketch stands one hash of all its shingles, so equal texts are known as equal and other short ones as different.

Scale: hashing is per row; neighbours in id order come from one shuffle of the texts into ranges of ids (several per
shuffle partition, cut at percentiles), each with a copy of the first row of the next range, so no task and no window
ever holds the whole order. An id that holds more than a range's share of rows is cut further by its texts' hashes.
Cuts and borders are one-row and one-row-per-range tables that never pass through the driver's plan.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm._shared import fresh, table

SHINGLE = 5
SCALE = 4
_LOW = -(1 << 63)
#: Ranges of ids per shuffle partition.
RANGES = 8


def threshold(scale: int = SCALE) -> int:
    """The signed hash below which 1/scale of all hashes lie."""
    return _LOW + (1 << 64) // scale


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t-\\r]+"), "")


def shingle_hashes(word_hashes: Column, shingle: int = SHINGLE) -> Column:
    """Distinct hashes, ascending, of the runs of ``shingle`` words; the whole sequence if it is shorter; none of none."""
    n = F.size(word_hashes)
    runs = F.transform(F.sequence(F.lit(1), n - shingle + 1), lambda i: F.xxhash64(*[F.get(word_hashes, i + (j - 1)) for j in range(shingle)]))
    short = F.when(n > 0, F.array(F.xxhash64(word_hashes))).otherwise(F.array().cast("array<bigint>"))
    return F.sort_array(F.array_distinct(F.when(n > shingle, runs).otherwise(short)))


def with_sketch(df: DataFrame, text: str, name: str, shingle: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """df with struct ``name`` of hashes (array of long, ascending) and whole (a hash of all shingles' hashes; 0 for none).

    Null counts as the empty text. ``name`` takes the place of a column so named; other columns stay.
    """
    word_hashes, hashes = fresh(df.columns, "word_hashes", "hashes")
    hashed = df.withColumn(word_hashes, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)))
    hashed = hashed.withColumn(hashes, shingle_hashes(F.col(word_hashes), shingle)).drop(word_hashes)
    whole = F.when(F.size(hashes) > 0, F.xxhash64(hashes)).otherwise(F.lit(0).cast("long"))
    kept = F.filter(hashes, lambda h: h < threshold(scale))
    return hashed.withColumn(name, F.struct(kept.alias("hashes"), whole.alias("whole"))).drop(hashes)


def _estimate(a: Column, b: Column, shared: Column, of: Column) -> Column:
    """shared / of; sketches with nothing to compare are alike only if they are of the same shingles."""
    same = a["whole"] == b["whole"]
    return F.when(same, F.lit(1.0)).when(of > 0, shared / of).otherwise(F.lit(0.0))


def similarity(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketched texts; 1 for two texts without words, 0 for one such text."""
    both = F.size(F.array_intersect(a["hashes"], b["hashes"]))
    return _estimate(a, b, both, F.size(a["hashes"]) + F.size(b["hashes"]) - both)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; 1 for a text without words."""
    shared = F.size(F.array_intersect(a["hashes"], b["hashes"]))
    return F.when(a["whole"] == 0, F.lit(1.0)).otherwise(_estimate(a, b, shared, F.size(a["hashes"])))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two texts together; which whole texts it stands for is told by the xor of theirs."""
    return F.struct(F.sort_array(F.array_union(a["hashes"], b["hashes"])).alias("hashes"), a["whole"].bitwiseXOR(b["whole"]).alias("whole"))


def printed(sketch: Column) -> Column:
    """The sketch as text: the whole's hash and the kept hashes in hexadecimal."""
    return F.concat_ws(":", F.hex(sketch["whole"]), F.array_join(F.transform(sketch["hashes"], lambda h: F.hex(h)), ""))


def with_next(docs: DataFrame, columns: list[str], by: str = "doc_id", ranges: int | None = None) -> DataFrame:
    """docs with next_<column>: that column of the next row in descending order of ``by``, after the last the first's.

    Rows of one id go by their texts' hash, descending, then by text; null ids are last. A single row is its own next.
    Ids are read twice beforehand: for the percentiles at which ranges are cut, and for the first row of each range.
    """
    spark = docs.sparkSession
    n = ranges or RANGES * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    key, tie, cut, place, first, into, to, led = fresh([*docs.columns, *(f"next_{c}" for c in columns)], "key", "tie", "cuts", "place", "first", "into", "to", "led")
    keyed = docs.withColumn(key, F.coalesce(F.col(by).cast("long"), F.lit(_LOW)))
    steps = F.lit(np.arange(1, max(2, n)) / n)
    cuts = keyed.agg(F.coalesce(F.percentile_approx(key, steps, F.lit(max(10_000, 20 * n))), F.array(F.lit(0).cast("long"))).alias(cut))

    def below(equal: bool) -> Column:
        """How many cuts lie below the key (or not above it), by halving."""
        size = F.size(cut)
        fits = lambda at: F.get(F.col(cut), at) <= F.col(key) if equal else F.get(F.col(cut), at) < F.col(key)
        halves = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length() + 1))])
        return F.aggregate(halves, F.lit(0), lambda at, step: F.when((at + step <= size) & fits(at + step - 1), at + step).otherwise(at))

    # an id that holds several cuts has as many ranges, dealt by the texts' hashes
    share = (F.xxhash64("text").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    spans = below(True) - below(False)
    at = below(False) + F.when(spans > 1, F.least(F.floor(share * spans).cast("int"), spans - 1)).otherwise(0)
    # one row of n cuts at most
    ranged = keyed.crossJoin(F.broadcast(cuts)).withColumn(place, at).withColumn(tie, F.xxhash64("text")).drop(cut)
    firsts = ranged.groupBy(place).agg(F.max(F.struct(key, tie)).alias(first))
    everything = Window.partitionBy(F.lit(0))
    up = F.lead(place).over(everything.orderBy(place))
    # one row for each of the n ranges at most
    borders = firsts.withColumn(into, F.coalesce(up, F.min(place).over(everything)))
    own, ghost = (F.struct(F.col(c).alias("at"), F.lit(c == into).alias("ghost")) for c in (place, into))
    is_first = F.struct(key, tie) == F.col(first)
    dealt = ranged.join(F.broadcast(borders), place).withColumn(to, F.explode(F.when(is_first, F.array(own, ghost)).otherwise(F.array(own))))
    dealt = dealt.drop(first, into, place)
    order = Window.partitionBy(f"{to}.at").orderBy(F.col(f"{to}.ghost"), F.col(key).desc(), F.col(tie).desc(), F.col("text").asc_nulls_first())
    followed = dealt.withColumn(led, F.lead(F.struct(*columns)).over(order)).filter(~F.col(f"{to}.ghost"))
    return followed.select(*docs.columns, *[F.col(led)[c].alias(f"next_{c}") for c in columns])


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its text with the last third overwritten, and their likeness.

    Output: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (Jaccard), and
    the containments in_edited and in_next. Null counts as the empty text; rows of one id go as with_next() says;
    repeated rows stay; extra columns are ignored; an empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    both = with_next(with_sketch(texts, "text", "sketch"), ["text", "sketch"])
    sized = both.withColumn("n_chars", F.length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - third), F.substring("next_text", F.lit(1), third))
    done = with_sketch(sized.withColumn("edited", edited).drop("text", "next_text"), "edited", "edited_sketch")
    return done.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        similarity(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        similarity(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("in_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("in_next"),
    )


def op7_fingerprint(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint next to that of its edited text and of the next document."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))
