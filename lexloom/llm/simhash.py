"""SimHash near-duplicates found by covering locality-sensitive hashing.

A fingerprint is the bitwise majority over the XXH64 hashes of a text's word shingles. Two fingerprints link when
they differ in at most ``radius`` bits. Each bit position gets a non-zero vector of radius+1 bits; each of the
2^(radius+1)-1 non-zero vectors v makes one table that keeps the bits whose vector has an odd product with v. Any
``radius`` positions leave some v orthogonal to all of their vectors, so every linked pair agrees on all kept bits
of at least one table: candidates are complete, not probable.

Scale: exact copies meet in one row per distinct fingerprint before any table is built. Buckets of one fingerprint
are dropped by a count that is summed before the shuffle. A bucket above ``bucket_limit`` is refined by a second set
of masks over the bits that the first one left free, again covering, after which a bucket can hold 2^(free bits)
fingerprints at most, so no task ever gathers an unbounded group. A bucket yields a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm._shared import scratch, small_batches, table, written
from lexloom.llm.components import connected_components
from lexloom.llm.shingles import shingle_hashes

SHINGLE, RADIUS, BUCKET_LIMIT = 4, 4, 4096


def majority(hashes: np.ndarray) -> int:
    """The unsigned 64-bit number with the bits set that over half the hashes set; 0 without hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 15):
        block = hashes[start : start + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE, distinct: bool = False) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text; 0 for null and for a text without words."""
    return majority(shingle_hashes(text, shingle, distinct))


def fingerprint_udf(shingle: int = SHINGLE, distinct: bool = False):
    """Arrow UDF text -> fingerprint as a signed long."""

    @F.arrow_udf(T.LongType())
    def simhash(text: pa.Array) -> pa.Array:
        values = (fingerprint_of(x.as_py(), shingle, distinct) for x in text.cast(pa.binary()))
        return pa.array(np.fromiter(values, dtype=np.uint64, count=len(text)).view(np.int64))

    return simhash


def covering_masks(radius: int, turn: int = 0, bits: int = 64) -> list[int]:
    """The covering masks over ``bits`` positions as unsigned integers; ``turn`` deals the vectors out differently."""
    vectors = (1 << (radius + 1)) - 1
    step = next(s for s in range(1 + 2 * turn, 10 * vectors) if np.gcd(s, vectors) == 1)
    of = [1 + (i * step + turn * (i // vectors + 1)) % vectors for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (of[i] & v).bit_count() & 1) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(ids: np.ndarray, fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest (id, id that took it along) of the links within one bucket.

    Breadth first: a vertex takes along all unvisited ones that link to it, so a dense group costs one pass.
    """
    _, left = np.unique(ids, return_index=True)
    edges = []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop(0)
            near = np.bitwise_count(fps[left] ^ fps[at]) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                edges += [(int(ids[x]), int(ids[at])) for x in found]
                queue += list(found)
    return edges


def _forest_batches(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            ends = lists.offsets.to_numpy()
            ids, fps = (x.to_numpy(zero_copy_only=False) for x in lists.values.flatten())
            edges = []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                edges += forest(ids[a:b], fps[a:b].view(np.uint64), radius)
            u, v = zip(*edges, strict=True) if edges else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def _repeated(keys: DataFrame) -> DataFrame:
    """keys(bucket, ...) of the buckets that more than one row has, with the number n of their rows."""
    counts = keys.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    return keys.join(written(counts, "simhash-buckets"), "bucket")


def links(nodes: DataFrame, radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """nodes(id, fp), each fp once -> edges (u, v) of ids whose components are those of all links."""
    first, second = covering_masks(radius), covering_masks(radius, turn=1)
    full = (1 << 64) - 1
    keys = [F.struct(F.lit(i).alias("turn"), F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))).alias("bucket")) for i, m in enumerate(first)]
    # ids are distinct; the tables multiply rows, so they are dealt out evenly first
    spread = nodes.repartition(max(1, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "id")
    keyed = spread.select("id", "fp", F.explode(F.array(*keys)).alias("k")).select("id", "fp", "k.turn", "k.bucket")
    members = written(_repeated(keyed), "simhash-members")
    # masks of the second turn over what the table of the first turn left free, by table
    finer = F.array(*[F.array(*[F.lit(_signed(m | (s & (full ^ m)))) for s in second]) for m in first])
    refined = (
        members.filter(F.col("n") > bucket_limit)
        .select("id", "fp", "bucket", F.posexplode(F.element_at(finer, F.col("turn") + 1)).alias("turn", "mask"))
        .select("id", "fp", F.xxhash64("bucket", "turn", F.col("fp").bitwiseAND(F.col("mask"))).alias("bucket"))
    )
    small, large = members.filter(F.col("n") <= bucket_limit), _repeated(refined)
    groups = [x.groupBy("bucket").agg(F.collect_list(F.struct("id", "fp")).alias("members")).select("members") for x in (small, large)]
    return groups[0].union(groups[1]).mapInArrow(_forest_batches(radius), "u long, v long").distinct()


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE, distinct: bool = False, text: str = "text", name: str = "fp") -> DataFrame:
    """docs with a long column ``name``: the fingerprint of ``text``. Other columns pass through untouched."""
    small_batches(docs.sparkSession)
    return docs.withColumn(name, fingerprint_udf(shingle, distinct)(F.col(text)))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id (smallest doc_id reachable over links).

    Null and empty texts have fingerprint 0 and so form one group. Repeated rows stay repeated. A null doc_id is
    kept and only names a group (as null) where no member has an id. An empty table gives an empty result. Extra
    columns are ignored.
    """
    spark = docs.sparkSession
    marked = written(with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"), "simhash-fp")
    with scratch(spark):
        distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
        reach = written(connected_components(links(distinct.select(F.col("fp").alias("id"), "fp"), radius, bucket_limit)), "simhash-reach")
        rooted = distinct.join(reach.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
        rooted = written(rooted.select("fp", "first_id", "component"), "simhash-rooted")
        least = written(rooted.groupBy("component").agg(F.min("first_id").alias("component_id")), "simhash-least")
        classes = written(rooted.join(least, "component").select("fp", "component_id"), "simhash-classes", keep=True)
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    """Every document with its 4-word-shingle fingerprint and its group at 4 bits or less."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
