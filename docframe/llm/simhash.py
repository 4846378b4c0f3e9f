"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most two bits share a variant at distance one from each. Every distinct fingerprint
emits itself and all its one-bit flips; variants are shuffled, those that several fingerprints emit give candidate pairs,
which are deduplicated and verified. A variant has at most bits + 1 senders, so no bucket grows with the data: equal
fingerprints are merged beforehand, with pre-aggregation, and never expanded into pairs. Members of a bucket are kept as
a bit mask (which bit each of them flipped), an aggregate of fixed size.

``link_fingerprints`` works on one 64-bit block (exact for two differing bits). ``keep_one`` takes the classes of the
fingerprints, all of them, and adds what lies beyond two bits: ``near_duplicates`` starts from the classes and finds all
copies whose five-word shingles have a similarity of 0.8 or more, by an exact prefix filter. With shingles in one fixed
order, two such texts share one of the first n - ceil(0.8 n) + 1 of each. Any order is exact; shingles that are common in
a bounded sample come last, which keeps buckets small. Each bucket first links its members to its most shared text (an
original with many different edits is that text) and in parts of about eight; pairs are then verified only between
members that are not linked yet.

Defined results: null and empty texts have fingerprint zero and are linked like any other; repeated rows fall into one
class; a row without doc_id links and gets a component like any other, which is null where no row of it has a doc_id; an
empty table gives no rows; texts of any length are hashed whole. ``ball_candidates`` ignores repeated values and nulls.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm.common import discard, fresh, give_back, maybe_broadcast, read_table, sampled, stage
from docframe.llm.components import connected_components

SEED = 42
ORDER_SAMPLE = 4000
ORDER_SHINGLES = 200_000


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of each shingle of ``width`` words (A-Z lower-cased); fewer words: one shingle of them all; none: empty."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[width - 1 :].tolist() or [len(joined)]
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=False)), np.uint64, len(stops))


def majority_bits(hashes: np.ndarray) -> np.ndarray:
    """For (n, k) 64-bit hashes the k words whose bits are set in over half the rows."""
    n, k = hashes.shape
    if not n:
        return np.zeros(k, np.uint64)
    ones = np.zeros(64 * k, np.int64)
    for i in range(0, n, 4096):
        part = np.ascontiguousarray(hashes[i : i + 4096].astype(">u8"))
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8 * k), axis=1).sum(axis=0, dtype=np.int32)
    return np.packbits(ones * 2 > n).view(">u8").astype(np.uint64)


def fingerprint(text: str | None, width: int = 3) -> int:
    return int(majority_bits(shingle_hashes(text, width)[:, None])[0])


def fingerprint_column(text: Column, width: int = 3) -> Column:
    """The 64-bit fingerprint as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter((fingerprint(t, width) for t in texts), np.uint64, len(texts)).view(np.int64))

    return of(text)


def ball_candidates(values: DataFrame, bits: int) -> DataFrame:
    """Distinct (block, value) rows -> candidate pairs (block, value, other) that share a variant one flip from each.

    Pairs form a chain and a star within a bucket, which has at most ``bits`` + 1 members.
    """
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    flip = F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("bit")
    one = F.lit(1).cast("long")
    mask = F.expr("if(bit = %d, 0L, shiftleft(1L, bit))" % bits)
    # a small table can be a single file: its expansion is spread over tasks first
    sent = values.select("block", "value").repartition(tasks).select("block", "value", flip).select("block", F.col("value").bitwiseXOR(mask).alias("variant"), "bit")
    # dealt out before the aggregate, since hardly any variant meets itself within a task
    met = sent.repartition("variant").groupBy("block", "variant").agg(F.bit_or(mask).alias("flips"), F.max(F.when(F.col("bit") == bits, 1).otherwise(0)).alias("self")).where(F.bit_count("flips") + F.col("self") >= 2)
    flipped = F.transform(F.filter(F.sequence(F.lit(0), F.lit(bits - 1)), lambda b: F.getbit("flips", b) == 1), lambda b: F.col("variant").bitwiseXOR(F.call_function("shiftleft", one, b)))
    members = F.array_sort(F.concat(flipped, F.when(F.col("self") == 1, F.array("variant")).otherwise(F.array().cast("array<bigint>"))))
    pairs = F.expr("flatten(transform(sequence(1, size(m) - 1), i -> if(i = 1, array(struct(m[0] as value, m[1] as other)), array(struct(m[0] as value, m[i] as other), struct(m[i - 1] as value, m[i] as other)))))")
    return met.select("block", members.alias("m")).select("block", F.explode(pairs).alias("p")).select("block", "p.value", "p.other").distinct()


def fingerprint_roots(classes: DataFrame) -> DataFrame:
    """Distinct fingerprints ``fp`` -> (node, root) of those that have another one within two bits: the smallest that steps of two bits reach."""
    found = ball_candidates(classes.select(F.lit(0).alias("block"), F.col("fp").alias("value")), 64)
    linked = found.where(F.bit_count(F.col("value").bitwiseXOR(F.col("other"))) <= 2)
    return stage(connected_components(linked.select(F.col("value").alias("a"), F.col("other").alias("b"))), "roots")


def link_fingerprints(prints: DataFrame) -> DataFrame:
    """(fp, doc_id) rows -> (fp, component_id): the smallest doc_id that a class reaches by steps of two bits at most.

    Classes are the nodes, so one without any doc_id still links its neighbours.
    """
    classes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = fingerprint_roots(classes)
    firsts = roots.join(classes, roots["node"] == classes["fp"]).groupBy("root").agg(F.min("first_id").alias("least"))
    named = roots.join(firsts, "root").select(F.col("node").alias("fp"), "least")
    return classes.join(named, "fp", "left").select("fp", F.coalesce("least", "first_id").alias("component_id"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row."""
    prints = stage(docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(F.col(text_col), width).alias("fp")), "fingerprints")
    joined = prints.join(link_fingerprints(prints), "fp")
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# Near copies by shingle similarity


def needed(size: int, similarity: float) -> int:
    """How many of a text's ``size`` distinct shingles a copy shares at least."""
    return math.ceil(similarity * size - 1e-9)


def common_shingles(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingle hashes that occur three times or more in a sample of (text_hash, text) rows, and their counts.

    They only set the order of the prefix filter, which is exact for any order.
    """

    @F.pandas_udf("array<long>")
    def of(batch: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingle_hashes(t, width)).view(np.int64) for t in batch])

    counts = sampled(texts, F.col("text_hash"), ORDER_SAMPLE).select(F.explode(of("text")).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")
    top = counts.orderBy(F.desc("n"), "h").limit(ORDER_SHINGLES).toPandas()
    keys = top["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], top["n"].to_numpy(np.int64)[order]


def prefix_of(shingles: np.ndarray, similarity: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first of sorted distinct shingles, rare ones first, one of which every copy has among its own first."""
    keys, counts = common
    rank = np.zeros(len(shingles), np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
        rank = np.where(keys[at] == shingles, counts[at], 0)
    return shingles[np.lexsort((shingles, rank))][: len(shingles) - needed(len(shingles), similarity) + 1]


#: Least and most bits of a set's parity signature: the power of two from its size on.
PARITY_BITS = (256, 1 << 15)


def parity_signature(shingles: np.ndarray) -> bytes:
    """Which of the signature's bins hold an odd number of the shingles. Half of one XOR the other half is the signature of half as many bins."""
    bits = min(max(PARITY_BITS[0], 1 << max(0, len(shingles) - 1).bit_length()), PARITY_BITS[1])
    bins = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % bits, minlength=bits)
    return np.packbits(bins & 1).tobytes()


def sketch_column(text: Column, width: int, similarity: float, common: tuple[np.ndarray, np.ndarray], print_width: int | None = None) -> Column:
    """struct(node, n, prefix, parity, fp): a hash of the shingle set, its size, its prefix (no shingles: none), its signature, and the fingerprint if it has a width."""

    @F.pandas_udf("node long, n int, prefix array<long>, parity binary, fp long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh64_intdigest

        for texts in batches:
            rows = []
            for t in texts:
                h = np.unique(shingle_hashes(t, width))
                fp = None if print_width is None else int(np.uint64(fingerprint(t, print_width)).astype(np.int64))
                rows.append((xxh64_intdigest(h.tobytes(), SEED) - (1 << 63), len(h), prefix_of(h, similarity, common).view(np.int64) if len(h) else [], parity_signature(h), fp))
            out = pd.DataFrame(rows, columns=["node", "n", "prefix", "parity", "fp"], dtype=object)
            yield out.astype({"node": "int64", "n": "int32", "fp": "Int64"})
        give_back()

    return of(text)


def shingle_set_column(text: Column, width: int) -> Column:
    """struct(shingles, parity, n): sorted distinct shingle hashes as bytes, their signature, how many."""

    @F.pandas_udf("shingles binary, parity binary, n int")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                h = np.unique(shingle_hashes(t, width))
                rows.append((h.tobytes(), parity_signature(h), len(h)))
            yield pd.DataFrame(rows, columns=["shingles", "parity", "n"])
        give_back()

    return of(text)


def odd_bins(a: Column, b: Column) -> Column:
    """In how many bins two parity signatures differ, the longer one folded: no more than the shingles that only one of the sets holds."""

    @F.pandas_udf("int")
    def of(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right, strict=True):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            k = min(len(p), len(q))
            p, q = (np.bitwise_xor.reduce(v.reshape(-1, k)) if len(v) > k else v for v in (p, q))
            out.append(int(np.bitwise_count(p ^ q).sum()))
        return pd.Series(out, dtype="int32")

    return of(a, b)


def jaccard(a: Column, b: Column) -> Column:
    @F.pandas_udf("double")
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            out = []
            for x, y in zip(left, right, strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                out.append(both / max(1, len(p) + len(q) - both) if len(p) + len(q) else 1.0)
            yield pd.Series(out, dtype=float)
        give_back()

    return of(a, b)


def print_links(prints: DataFrame) -> DataFrame:
    """(node, fp) rows -> edges (a, b) that join the nodes of each class of linked fingerprints, as a star; a null ``fp`` has no class."""
    known = prints.where("fp is not null").select("node", "fp").distinct()
    classes = stage(known.select("fp").distinct(), "classes")
    roots = fingerprint_roots(classes).select(F.col("node").alias("fp"), "root")
    placed = stage(known.join(roots, "fp", "left").select("node", F.coalesce("root", "fp").alias("class")).distinct(), "placed")
    least = placed.groupBy("class").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("class", "low")
    edges = stage(placed.join(least, "class").where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b")), "seeds")
    discard(classes, placed)
    return edges


def near_duplicates(docs: DataFrame, similarity: float = 0.8, width: int = 5, id_col: str = "doc_id", text_col: str = "text", print_width: int | None = None) -> DataFrame:
    """(doc_id, text_hash, component) for every row; rows of one component are copies of each other, in steps.

    ``text_hash`` is a hash of the text. Texts of equal shingle sets are one node from the start: null and empty texts are
    copies of each other, repeated rows too. With ``print_width`` texts are copies if their fingerprints over so many words
    link by ball hashing (two bits at most, in steps); those links come first. Every pair of texts at ``similarity`` or
    above ends in one component too, also those whose fingerprints are farther apart.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    common = common_shingles(rows, width)
    sketched = rows.select("doc_id", "text_hash", F.monotonically_increasing_id().alias("row"), sketch_column(F.col("text"), width, similarity, common, print_width).alias("p"))
    prints = stage(sketched.select("doc_id", "text_hash", "row", "p.*"), "prefixes")
    nodes = stage(prints.groupBy("node").agg(F.min("row").alias("row"), F.min("text_hash").alias("text_hash"), F.min("n").alias("n"), F.min("parity").alias("parity")), "nodes")
    seeds = print_links(prints)
    start = stage(connected_components(seeds), "start")
    firsts = prints.join(maybe_broadcast(nodes.select("row")), "row", "left_semi")
    # size and place travel as one number
    entries = firsts.select("node", "n", F.posexplode("prefix").alias("pos", "key")).select("node", "key", F.expr("shiftleft(cast(n as bigint), 32) | pos").alias("at"))
    # counts and hubs are aggregates joined back, not windows: a key that very many texts have is never sorted in one task
    met = entries.groupBy("key").agg(F.count(F.lit(1)).alias("met")).where("met > 1")
    shared = stage(entries.join(met, "key").select("key", "node", F.shiftright("at", 32).cast("int").alias("n"), F.col("at").bitwiseAND((1 << 31) - 1).cast("int").alias("pos"), "met"), "shared")

    def can_reach(n_a: str, pos_a: str, n_b: str, pos_b: str) -> Column:
        # what two copies share at least, and at most if this is the first shingle they have in common
        least = (F.col(n_a) + F.col(n_b)) * (similarity / (1 + similarity)) - 1e-6
        return F.least(F.col(n_a) - F.col(pos_a), F.col(n_b) - F.col(pos_b)) >= least

    def verified(pairs: DataFrame, but: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = stage(pairs if but is None else pairs.join(but, ["a", "b"], "left_anti"), "pairs")
        # narrow signatures meet first; whole sets are made only for pairs that they leave possible
        sides = [nodes.select(*(F.col(c).alias(f"{c}_{side}") for c in ("parity", "n")), F.col("node").alias(side)) for side in "ab"]
        near = sides[0].join(maybe_broadcast(pairs), "a").join(sides[1], "b")
        near = near.where(odd_bins(F.col("parity_a"), F.col("parity_b")) <= (F.col("n_a") + F.col("n_b")) * ((1 - similarity) / (1 + similarity)) + 1e-6)
        close = stage(near.select("a", "b"), "close")
        wanted = close.select(F.col("a").alias("node")).union(close.select(F.col("b").alias("node"))).distinct()
        wanted = stage(wanted.join(nodes, "node").select("node", "text_hash"), "wanted")
        texts = rows.join(maybe_broadcast(wanted), "text_hash").select("node", shingle_set_column(F.col("text"), width)["shingles"].alias("shingles"))
        sets = stage(texts.groupBy("node").agg(F.min("shingles").alias("shingles")), "shingles")
        found = maybe_broadcast(close)
        second = sets.join(found.select(F.col("b").alias("node")), "node", "left_semi").select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
        both = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")).join(found, "a").join(second, "b")
        edges = stage(both.where(jaccard(F.col("sa"), F.col("sb")) >= similarity).select("a", "b"), "links")
        discard(wanted, sets, close)
        return edges, pairs

    # a text without words of its own stands in more buckets; each member meets the bucket's hub and one among about eight
    share = shared.groupBy("node").agg((F.count(F.lit(1)) / F.max("n")).alias("share")).join(start, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stage(shared.join(share, "node").withColumn("part", F.pmod(F.xxhash64("node", "key"), F.ceil(F.col("met") / 8))), "placed")
    best = F.max(F.struct("share", "node", "n", "pos", "root"))
    # a bucket of one part has one hub
    hubs = [some.join(some.groupBy(*by).agg(best.alias("o")), by) for some, by in ((placed.where("met > 8"), ["key"]), (placed, ["key", "part"]))]
    led = hubs[0].select("node", "n", "pos", "root", "o").union(hubs[1].select("node", "n", "pos", "root", "o")).where("o.root <> root")
    links, tested = verified(led.where(can_reach("n", "pos", "o.n", "o.pos")).select(F.col("node").alias("a"), F.col("o.node").alias("b")))

    # all other pairs of a bucket, unless they are linked already
    edges = seeds.union(links)
    linked = stage(connected_components(edges), "linked")
    named = shared.join(linked, "node", "left").select("key", "node", "n", "pos", F.coalesce("root", "node").alias("root"))
    open_keys = named.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    mixed = stage(named.join(open_keys, "key"), "mixed")
    left, right = (mixed.select(*(F.col(c).alias(f"{c}_{side}") for c in ("key", "node", "n", "pos", "root"))) for side in "ab")
    # what the first shingle in common still allows is part of the join's condition: other pairs of a bucket are never made
    near = (F.col("root_a") < F.col("root_b")) & can_reach("n_a", "pos_a", "n_b", "pos_b")
    rest = left.join(right, [F.col("key_a") == F.col("key_b"), near]).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    more, retested = verified(rest, tested)
    roots = stage(connected_components(edges.union(more)), "roots")
    discard(nodes, seeds, start, shared, placed, links, tested, linked, mixed, more, retested)
    return prints.select("doc_id", "text_hash", "node").join(roots, "node", "left").select("doc_id", "text_hash", F.coalesce("root", "node").alias("component"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", print_width: int = 3) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest doc_id (nulls last) stays.

    Links are those of ``simhash_components``, and beyond them those of texts at a shingle similarity of 0.8 or more.
    """
    found = stage(near_duplicates(docs, id_col=id_col, text_col=text_col, print_width=print_width), "near")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    kept = found.groupBy("component").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias("k_id"), F.col("k.text_hash").alias("k_hash"))
    counts = found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    hash_col, g_id, g_hash = fresh("hash"), fresh("id"), fresh("hash")
    marked = counts.join(kept, counts["doc_id"].eqNullSafe(F.col("k_id")) & (counts["text_hash"] == F.col("k_hash")), "left")
    decided = stage(marked.select(F.col("doc_id").alias(g_id), F.col("text_hash").alias(g_hash), F.col("k_hash").isNull().alias("gone"), "copies").where("gone or copies > 1"), "decisions")
    discard(found)
    hashed = docs.withColumn(hash_col, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    key = hashed[id_col].eqNullSafe(F.col(g_id)) & (F.col(hash_col) == F.col(g_hash))
    out = hashed.join(maybe_broadcast(decided.where("gone").select(g_id, g_hash)), key, "left_anti")
    twice = decided.where("not gone").select(g_id, g_hash)
    if twice.isEmpty():
        return out.drop(hash_col)
    # the same row stands there several times: only those rows are shuffled
    twice = maybe_broadcast(twice)
    return out.join(twice, key, "left_anti").union(out.join(twice, key, "left_semi").dropDuplicates([id_col, hash_col])).drop(hash_col)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"))


QUERIES = {"op9_simhash": op9_simhash}
ORACLE_SQL: dict[str, str] = {}
