"""Near copies among documents: SimHash links first, then whatever else is alike, by exact Jaccard similarity.

Two texts link when the sets of their shingles have a Jaccard similarity of ``similarity`` or more. The fingerprints of
the sets and their covering tables (see simhash) give most links; large groups less alike than these reach are joined
where minima over their sets agree, in buckets cut to ``JOIN_LIMIT`` rows. Every such link is decided on the whole sets.
A fingerprint's radius can't reach all pairs of that similarity, so a complete search follows for pairs that no link
joins yet: in any one order of all shingles, two such sets of n and m share a shingle among their first
n - ceil(similarity * n) + 1 and m - ceil(similarity * m) + 1, and so many of them that the rest can still make up the
similarity. What it finds is decided on the whole sets too, so the groups are exact.

Scale: texts of one set are one row from the start. Shingles that are frequent in a sample come last in the order, which
changes no result, so common passages make few candidates. Shingles of one text are dropped by a count that is summed
before the shuffle. Only ids meet in a shingle's bucket; one above ``bucket_limit`` is dealt out as pairs of parts, so no
task gathers more than two parts. Whole sets are made only of the texts that some link or candidate names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm._shared import fresh, scratch, small_batches, written
from lexloom.llm.components import connected_components
from lexloom.llm.shingles import shingle_hashes
from lexloom.llm.simhash import links, majority

SHINGLE = 5
#: One text in SAMPLE is read for frequent shingles, those of at least OFTEN texts of it; the most frequent HOT of them count.
SAMPLE, OFTEN, HOT = 16, 4, 200_000
#: Minima over each set for joining beforehand, the least bucket that is worth it, and the rows it is cut to.
TURNS, JOIN_FROM, JOIN_LIMIT = 4, 32, 1000
#: Rows of a shingle's bucket that one task pairs up at most; larger ones are dealt out.
BUCKET_LIMIT = 4096
_EPS = 1e-9


def shingle_set(text: bytes | None) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    return np.unique(shingle_hashes(text, SHINGLE, True))


def prefix(hashes: np.ndarray, similarity: float, hot: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set in the common order, hot ones last, as many as complete candidates need."""
    n = len(hashes)
    size = n - int(np.ceil(similarity * n - _EPS)) + 1 if n else 0
    late = np.zeros(n, dtype=bool)
    if len(hot):
        late = hot[np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)] == hashes
    return np.concatenate([hashes[~late], hashes[late]])[:size]


def minima(hashes: np.ndarray) -> list[int]:
    out = []
    for turn in range(1, TURNS + 1):
        x = (hashes ^ np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        out.append(int((x ^ (x >> np.uint64(32))).min().view(np.int64)))
    return out


_NODE = "struct<key:long,size:int,fp:long,prefix:array<long>,minima:array<long>>"


def _node_udf(similarity: float, hot: np.ndarray):
    longs = pa.list_(pa.int64())
    kind = pa.struct([("key", pa.int64()), ("size", pa.int32()), ("fp", pa.int64()), ("prefix", longs), ("minima", longs)])

    @F.arrow_udf(_NODE)
    def node(text: pa.Array) -> pa.Array:
        rows: list[list] = [[], [], [], [], []]
        for x in text.cast(pa.binary()):
            found = shingle_set(x.as_py())
            key, fp = (np.uint64(v).view(np.int64) for v in (xxhash.xxh64_intdigest(found.tobytes()), majority(found)))
            for column, value in zip(rows, (key, len(found), fp, prefix(found, similarity, hot).view(np.int64), minima(found) if len(found) else []), strict=True):
                column.append(value)
        return pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(rows, kind, strict=True)], fields=list(kind))

    return node


@F.arrow_udf(T.LongType())
def key_of(text: pa.Array) -> pa.Array:
    """The key of each text's shingle set, as in the nodes."""
    keys = (xxhash.xxh64_intdigest(shingle_set(x.as_py()).tobytes()) for x in text.cast(pa.binary()))
    return pa.array(np.fromiter(keys, dtype=np.uint64, count=len(text)).view(np.int64))


@F.arrow_udf(T.ArrayType(T.LongType()))
def shingles_of(text: pa.Array) -> pa.Array:
    return pa.array([shingle_set(x.as_py()).view(np.int64) for x in text.cast(pa.binary())], pa.list_(pa.int64()))


def _hot(texts: DataFrame) -> np.ndarray:
    """Hashes of the shingles that are frequent in a sample of the texts, sorted; HOT at most."""
    some = texts.filter(F.pmod("tid", F.lit(SAMPLE)) == 0).select("tid", "text")
    counts = some.select(F.explode(shingles_of("text")).alias("s")).groupBy("s").agg(F.count("*").alias("n")).filter(F.col("n") >= OFTEN)
    found = counts.orderBy(F.desc("n"), "s").limit(HOT).select("s").toArrow().column("s")
    return np.sort(np.array(found.to_numpy(), dtype=np.int64).view(np.uint64))


def join_alike(ids: np.ndarray, flat: np.ndarray, sizes: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Spanning forest of the links within one bucket of sets, which lie one after another in ``flat``; breadth first."""
    _, codes = np.unique(flat, return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    marked, edges, left = np.zeros(len(flat), dtype=bool), [], np.arange(len(ids))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop(0)
            mine = codes[starts[at] : starts[at + 1]]
            marked[mine] = True
            both = np.array([np.count_nonzero(marked[codes[starts[x] : starts[x + 1]]]) for x in left])
            marked[mine] = False
            near = both >= similarity * (sizes[left] + sizes[at] - both) - _EPS
            edges += [(int(ids[x]), int(ids[at])) for x in left[near]]
            queue += list(left[near])
            left = left[~near]
    return edges


def _join_batches(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members in batch.column(0):
                ids, sets = members.values.field("key").to_numpy(), members.values.field("hashes")
                sizes = sets.value_lengths().to_numpy().astype(np.int64)
                edges = join_alike(ids, sets.flatten().to_numpy(), sizes, similarity)
                u, v = zip(*edges, strict=True) if edges else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def _pooled(nodes: DataFrame) -> DataFrame:
    """(key, bucket) of the sets in large buckets of one minimum, cut to parts."""
    keyed = nodes.select("key", F.posexplode("minima").alias("turn", "least"))
    counts = written(keyed.groupBy("turn", "least").agg(F.count("*").alias("n")).filter(F.col("n") >= JOIN_FROM), "similar-minima")
    part = F.pmod(F.xxhash64("key", "turn"), F.ceil(F.col("n") / JOIN_LIMIT))
    return written(keyed.join(counts, ["turn", "least"]).select("key", F.xxhash64("turn", "least", part).alias("bucket")), "similar-large")


def _joined(pooled: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Some of the links: those found within the buckets."""
    groups = pooled.join(sets, "key").groupBy("bucket").agg(F.collect_list(F.struct("key", "hashes")).alias("members"))
    return written(groups.select("members").mapInArrow(_join_batches(similarity), "u long, v long"), "similar-joined")


def _simhash_links(nodes: DataFrame) -> DataFrame:
    """Links of sets by their fingerprints: those of one fingerprint with its least key, these with each other."""
    least = written(nodes.groupBy("fp").agg(F.min("key").alias("id")), "similar-fingerprints")
    same = nodes.select("key", "fp").join(least, "fp").filter("key <> id").select(F.col("key").alias("u"), F.col("id").alias("v"))
    return written(same.union(links(least)), "similar-near")


def _sets(texts: DataFrame, nodes: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, hashes) of the nodes that keys name; copies of a text meet in one row before the shuffle."""
    needed = written(nodes.select("key", "tid").join(keys.distinct(), "key", "left_semi"), "similar-needed")
    once = texts.select("tid", "text").join(needed.select("tid"), "tid", "left_semi").groupBy("tid").agg(F.first("text").alias("text"))
    return written(once.join(needed, "tid").select("key", shingles_of("text").alias("hashes")), "similar-sets")


def _decided(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (u, v) whose sets are similar enough. Groups share their v, so v is joined while rows are small."""
    whole = pairs.select("u", "v").join(sets.select(F.col("key").alias("v"), F.col("hashes").alias("b")), "v").join(sets.select(F.col("key").alias("u"), F.col("hashes").alias("a")), "u")
    both = F.size(F.array_intersect("a", "b"))
    enough = F.lit(similarity) * (F.size("a") + F.size("b") - both) - F.lit(_EPS)
    return written(whole.filter(both >= enough).select("u", "v"), "similar-linked")


def _pair_batches(similarity: float, at_once: int = 1 << 17):
    """Pairs of each bucket whose roots differ and whose sizes allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            members = lists.flatten()
            key, root, size, part, across = (members.field(n).to_numpy(zero_copy_only=False) for n in ("key", "root", "size", "part", "across"))
            bucket = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            order = np.lexsort((key, root, bucket))
            key, root, size, part, across, bucket = (x[order] for x in (key, root, size, part, across, bucket))
            last = np.concatenate([np.flatnonzero((root[1:] != root[:-1]) | (bucket[1:] != bucket[:-1])) + 1, [len(key)]])
            ends = last[np.searchsorted(last, np.arange(len(key)), side="right")]
            rest, done = np.searchsorted(bucket, bucket, side="right") - ends, 0
            total = np.cumsum(rest)
            while done < len(key):
                # as many rows as pair up to about at_once times with what comes after their root in their bucket
                upto = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + at_once, side="right")))
                n = rest[done:upto]
                i = np.repeat(np.arange(done, upto), n)
                j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[done:upto], n)
                keep = np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j]) - _EPS
                keep &= ~across[i] | (part[i] != part[j])
                i, j = i[keep], j[keep]
                swap = key[i] > key[j]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[i], key[j], size[i], size[j])], names=["u", "v", "n", "m"])
                done = upto

    return run


def _least_shared(n: Column, m: Column, similarity: float) -> Column:
    """How many shingles of their prefixes two sets of n and m share at least if they are similar enough."""
    shared = F.ceil(F.lit(similarity / (1 + similarity)) * (n + m) - F.lit(_EPS))
    return shared - F.ceil(F.lit(similarity) * F.greatest(n, m) - F.lit(_EPS)) + 1


def _candidates(members: DataFrame, joined: DataFrame, similarity: float, bucket_limit: int) -> DataFrame:
    """members(key, size, s), joined(node, component) -> pairs (u, v, n, m) that no root joins and that share enough of their prefixes."""
    rooted = members.join(joined.withColumnRenamed("node", "key"), "key", "left").select("s", "key", "size", F.coalesce("component", "key").alias("root"))
    rooted = written(rooted, "similar-rooted")
    counts = rooted.groupBy("s").agg(F.count("*").alias("n"), F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
    mixed = rooted.join(written(counts.select("s", F.ceil(F.col("n") / bucket_limit).cast("int").alias("parts")), "similar-mixed"), "s")
    dealt = mixed.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = F.xxhash64("s", F.least("part", "other"), F.greatest("part", "other"))
    member = F.struct("key", "root", "size", "part", (F.col("part") != F.col("other")).alias("across"))
    groups = dealt.groupBy(cell.alias("cell")).agg(F.collect_list(member).alias("members")).select("members")
    pairs = groups.mapInArrow(_pair_batches(similarity), "u long, v long, n int, m int")
    shared = pairs.groupBy("u", "v", "n", "m").agg(F.count("*").alias("shared"))
    return written(shared.filter(F.col("shared") >= _least_shared(F.col("n"), F.col("m"), similarity)).drop("shared"), "similar-pairs")


def _grouped(docs: DataFrame, similarity: float, bucket_limit: int) -> DataFrame:
    """(doc_id, key, component, component_id) of each document; ``component`` tells groups apart, with ids or without."""
    with scratch(small_batches(docs.sparkSession)):
        texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tid", F.xxhash64("text"))
        marked = texts.select("doc_id", "tid", _node_udf(similarity, _hot(texts))("text").alias("node")).select("doc_id", "tid", "node.*")
        marked = written(marked, "similar-marked")
        nodes = marked.groupBy("key").agg(F.min("doc_id").alias("first_id"), *[F.first(c).alias(c) for c in ("tid", "size", "fp", "prefix", "minima")])
        nodes = written(nodes, "similar-nodes")
        near, pooled = _simhash_links(nodes), _pooled(nodes)
        some = _sets(texts, nodes, near.select(F.explode(F.array("u", "v")).alias("key")).union(pooled.select("key")))
        edges = _decided(near, some, similarity).union(_joined(pooled, some, similarity))
        shingles = nodes.select("key", "size", F.explode("prefix").alias("s"))
        repeated = written(shingles.groupBy("s").agg(F.count("*").alias("n")).filter("n > 1").select("s"), "similar-shingles")
        members = shingles.join(repeated, "s")
        pairs = _candidates(members, connected_components(edges), similarity, bucket_limit)
        more = _sets(texts, nodes, pairs.select(F.explode(F.array("u", "v")).alias("key")).join(some.select("key"), "key", "left_anti"))
        linked = _decided(pairs, some.union(more), similarity)
        reach = connected_components(edges.union(linked))
        rooted = nodes.select("key", "first_id").join(reach.withColumnRenamed("node", "key"), "key", "left")
        rooted = written(rooted.select("key", "first_id", F.coalesce("component", "key").alias("component")), "similar-rooted")
        least = written(rooted.groupBy("component").agg(F.min("first_id").alias("component_id")), "similar-least")
        classes = written(rooted.join(least, "component").select("key", "component", "component_id"), "similar-classes")
        found = marked.select("doc_id", "key").join(classes, "key").select("doc_id", "key", "component", "component_id")
        return written(found, "similar-found", keep=True)


def similar_documents(docs: DataFrame, similarity: float = 0.8, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row per document: doc_id, key, component_id (smallest doc_id reachable over links).

    ``key`` stands for the set of the text's five-word shingles. Null and empty texts have the empty set and so form one
    group. Repeated rows stay repeated. A null doc_id is kept and only names a group (as null) where no member has an id.
    """
    return _grouped(docs, similarity, bucket_limit).drop("component")


def deduplicate(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """docs with one row of each group of similar documents: that of the smallest doc_id.

    A row with a null doc_id stays only where its group has no other id. Rows of one doc_id in several groups stay once
    for each group that has no smaller id, and rows without an id likewise. Of a group's rows of one doc_id that stays,
    texts of the least key stay, of these the least row by its text. Columns are those of docs.
    """
    columns = docs.columns
    key, id_, kept_key, row = fresh(columns, "key", "id", "kept_key", "row")
    found = _grouped(docs, similarity, BUCKET_LIMIT)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    kept = written(found.groupBy("component").agg(first.alias("first")).select("first.doc_id", "first.key"), "similar-kept")
    known = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    repeated = written(known.filter("n > 1").select("doc_id"), "similar-repeated")
    # ids are told apart before texts are joined, so texts are shuffled once; only ids that don't name one row need keys
    once = docs.join(kept.filter("doc_id is not null").join(repeated, "doc_id", "left_anti").select("doc_id"), "doc_id", "left_semi")
    several = docs.join(repeated, "doc_id", "left_semi").select(*columns).unionByName(docs.filter("doc_id is null"))
    # written, as a join on the key makes a filter on it that Spark moves below the join above: keys of all texts, by a second worker for each task
    several = written(several.withColumn(key, key_of(F.coalesce("text", F.lit("")))), "similar-several")
    wanted = kept.select(F.col("doc_id").alias(id_), F.col("key").alias(kept_key))
    again = several.join(wanted, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(key) == F.col(kept_key)), "left_semi")
    least = again.groupBy("doc_id", key).agg(F.min(F.struct("text", *[c for c in columns if c not in ("doc_id", "text")])).alias(row))
    return once.select(*columns).unionByName(least.select("doc_id", f"{row}.*").select(*columns))
