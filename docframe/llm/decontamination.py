"""Benchmark decontamination by spaced-seed hashing.

Three fixed masks of five cared-for positions run over the tokens of benchmark items and documents. Equal masked hashes
join; around each hit the document is aligned with the item and every window of ``WINDOW`` tokens is compared. An item is
found if some aligned window has at least four fifths of its tokens in common with the document, so substituted tokens are
tolerated. The masks are lossless: every window with up to a fifth of its tokens substituted holds a seed hit.

Items under ``MIN_TOKENS`` tokens, too short for the masks, are found where all their tokens stand in a row: a mask over
all positions of each such length that the benchmark has.

Tokens are runs of letters and digits in lower case, compared by 64-bit hashes. Only DataFrame expressions are used:
positions are exploded and hashed inside generated code, joined to the seeds, and nothing but hits leaves a task. A seed
is joined with the window of tokens around it, not with its items: a question that many items share is compared once, and
items are looked up for the windows that were found. The table of windows is broadcast only if a count shows it to be
small; beyond that Spark shuffles both sides. A passage that very many documents share gives one row for each of them.

Defined results: null and empty texts have no tokens and are clean; items without tokens are never found; repeated rows are
judged alike; an empty benchmark leaves all documents clean; very long texts are cut into overlapping chunks and judged whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm.common import fresh, maybe_broadcast, read_table, stage

#: Positions that each mask compares. For windows of 8 to 13 tokens every choice of up to a fifth of them leaves a hit.
MASKS = ((0, 1, 2, 4, 7), (0, 3, 4, 5, 6), (0, 1, 4, 5, 6))
WINDOW = 13
MIN_TOKENS = 8
STRIDE = 4
CHUNK = 256
AROUND = WINDOW + STRIDE
#: Bytes of a window row: at most 2 * AROUND + 1 tokens and its numbers.
WINDOW_BYTES = 8 * (2 * AROUND + 1) + 64


def token_hashes(text: Column) -> Column:
    tokens = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(tokens, lambda t: F.xxhash64(t))


def seed_rows(df: DataFrame, keys: Sequence[str], tokens: str, masks: Sequence[Sequence[int]] = MASKS) -> DataFrame:
    """A row for each position and mask: keys, n (tokens of the text), at, mask, seed, near (the tokens around), p (place in them).

    Texts are cut into overlapping chunks first, so what a task holds does not grow with the length of a text. Outer
    explodes keep Spark from computing the tokens once more for an inferred filter.
    """
    shortest = min(m[-1] for m in masks)
    n, first, base, x = F.col("n"), F.col("first"), F.col("base"), F.col("x")
    sized = df.select(*keys, F.col(tokens).alias("h"), F.size(tokens).alias("n"))
    starts = F.when(n > shortest, F.sequence(F.lit(0), n - 1, F.lit(CHUNK)))
    chunks = sized.select(*keys, "n", "h", F.explode_outer(starts).alias("first")).where("first is not null")
    begin = F.greatest(first - AROUND, F.lit(0))
    chunks = chunks.select(*keys, "n", "first", begin.alias("base"), F.slice("h", begin + 1, F.lit(CHUNK + 3 * AROUND)).alias("h"))
    low, high = first - base, F.least(first - base + CHUNK, F.size("h") - shortest) - 1
    places = chunks.select(*keys, "n", "base", "h", F.explode_outer(F.when(high >= low, F.sequence(low, high))).alias("x")).where("x is not null")
    masked = [F.when(x + m[-1] < F.size("h"), F.xxhash64(F.lit(k), *[F.get("h", x + o) for o in m])) for k, m in enumerate(masks)]
    spread = places.select(*keys, "n", "base", "h", "x", F.posexplode_outer(F.array(*masked)).alias("mask", "seed")).where("seed is not null")
    left = F.greatest(x - AROUND, F.lit(0))
    return spread.select(*keys, "n", (base + x).alias("at"), "mask", "seed", F.slice("h", left + 1, F.lit(2 * AROUND + 1)).alias("near"), (x - left).alias("p"))


def item_windows(items: DataFrame, masks: Sequence[Sequence[int]] = MASKS) -> tuple[DataFrame, DataFrame]:
    """Distinct (seed, item_mask, around, o, window) rows, and (window, item_id, m) for the items that each window stands in."""
    names = {"n": "m", "near": "around", "p": "o", "mask": "item_mask"}
    rows = seed_rows(items, ["item_id"], "b", masks).withColumnsRenamed(names)
    rows = stage(rows.withColumn("window", F.xxhash64("item_mask", "o", "around")), "seeds")
    return stage(rows.select("seed", "item_mask", "around", "o", "window").distinct(), "windows"), rows.select("window", "item_id", "m").distinct()


def seed_hits(tokens: DataFrame, windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, window, window_tokens, best) of the windows that keep four fifths of their tokens around a hit."""
    hits = seed_rows(tokens, keys, "h").join(maybe_broadcast(windows, WINDOW_BYTES), "seed")
    same_at = lambda r: F.get("near", F.col("p") + r) == F.get("around", F.col("o") + r)
    # of a run of hits on one diagonal the first is verified and then each one whose position is a multiple of STRIDE
    again = F.lit(False)
    for k, m in enumerate(MASKS):
        again = again | ((F.col("mask") == k) & reduce(lambda a, b: a & b, [F.coalesce(same_at(o - 1), F.lit(False)) for o in m]))
    hits = hits.where(~again | (F.col("at") % STRIDE == 0))
    last = F.get(F.array(*[F.lit(m[-1]) for m in MASKS]), F.col("mask"))
    # what lies beyond AROUND tokens of a hit does not matter: a window around it begins and ends before
    size, wide = F.size("around"), F.least(F.size("around"), F.lit(WINDOW))
    low, high = F.greatest(-F.col("o"), last - wide + 1), F.least(size - wide - F.col("o"), F.lit(STRIDE - 1))
    framed = hits.select(*keys, "window", "near", "p", "around", "o", wide.alias("window_tokens"), low.alias("low"), high.alias("high"))
    same = F.transform(F.sequence(F.col("low"), F.col("high") + F.col("window_tokens") - 1), lambda r: F.when(same_at(r), 1).otherwise(0))
    verified = framed.select(*keys, "window", "window_tokens", (F.col("high") - F.col("low")).alias("steps"), same.alias("same"))
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.col("steps") + 1), lambda s: F.aggregate(F.slice("same", s, F.col("window_tokens")), F.lit(0), lambda a, x: a + x)))
    return verified.select(*keys, "window", "window_tokens", best.alias("best")).where(F.col("best") * 5 >= F.col("window_tokens") * 4)


def whole_hits(tokens: DataFrame, windows: DataFrame, keys: Sequence[str], lengths: Sequence[int]) -> DataFrame:
    """(keys, window, window_tokens, best) of short items that stand in a text whole; mask k has the k-th of ``lengths``."""
    hits = seed_rows(tokens, keys, "h", [range(n) for n in lengths]).join(maybe_broadcast(windows, WINDOW_BYTES), "seed")
    n = F.size("around")
    return hits.where(F.slice("near", F.col("p") + 1, n) == F.col("around")).select(*keys, "window", n.alias("window_tokens"), n.alias("best"))


def found_windows(docs: DataFrame, benchmark: DataFrame, keys: Sequence[str], text_col: str, item_id: str, item_text: str) -> list[tuple[DataFrame, DataFrame]]:
    """For long and short items: (keys, window, window_tokens, best) of what was found, and the items of each window."""
    tokens = docs.select(*[F.col(k) for k in keys], token_hashes(F.col(text_col)).alias("h"))
    items = stage(benchmark.select(F.col(item_id).alias("item_id"), token_hashes(F.col(item_text)).alias("b")).where(F.size("b") > 0), "items")
    windows, owners = item_windows(items.where(F.size("b") >= MIN_TOKENS))
    out = [(seed_hits(tokens, windows, keys), owners)]
    lengths = sorted(r.n for r in items.select(F.size("b").alias("n")).where(F.col("n") < MIN_TOKENS).distinct().collect())  # below MIN_TOKENS
    if lengths:
        windows, owners = item_windows(items.where(F.size("b") < MIN_TOKENS), [range(n) for n in lengths])
        whole = F.get(F.array(*map(F.lit, lengths)), F.col("item_mask")) == F.size("around")
        out.append((whole_hits(tokens, windows.where(whole), keys, lengths), owners))
    return out


def find_overlaps(docs: DataFrame, benchmark: DataFrame, keys: Sequence[str], text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(keys, item_id, window_tokens, best_match) for each document and item that overlap."""
    found = []
    for hits, owners in found_windows(docs, benchmark, keys, text_col, item_id, item_text):
        best = hits.groupBy(*keys, "window", "window_tokens").agg(F.max("best").alias("best"))
        named = best.join(maybe_broadcast(owners), "window")
        found.append(named.groupBy(*keys, "item_id", "window_tokens").agg(F.max("best").alias("best_match")))
    return reduce(DataFrame.union, found)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that overlap with no item. Rows are told apart by doc_id and a hash of the text, null-safe."""
    name, hash_col = fresh("id"), fresh("hash")
    keyed = docs.select(F.col(id_col).alias(name), F.xxhash64(text_col).alias(hash_col), F.col(text_col).alias("text"))
    hits = [hits.select(name, hash_col) for hits, _ in found_windows(keyed, benchmark, [name, hash_col], "text", "item_id", "text")]
    found = stage(reduce(DataFrame.union, hits).distinct(), "contaminated")
    own = fresh("hash")
    hashed = docs.withColumn(own, F.xxhash64(text_col))
    key = hashed[id_col].eqNullSafe(F.col(name)) & (F.col(own) == F.col(hash_col))
    return hashed.join(maybe_broadcast(found), key, "left_anti").drop(own)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), ["doc_id"])


SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
dt AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM d),
b AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark),
bt AS (SELECT item_id, len(w) AS n, unnest(w) AS t, generate_subscripts(w, 1) AS j FROM b),
m AS (SELECT doc_id, item_id, n, i - j AS diagonal, j FROM dt JOIN bt USING (t)),
r AS (SELECT doc_id, item_id, n, diagonal, j,
             count(*) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY j RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS c FROM m)
SELECT doc_id, item_id, CAST(least(n, 13) AS INTEGER) AS window_tokens, CAST(max(c) AS INTEGER) AS best_match
FROM r GROUP BY doc_id, item_id, n HAVING CASE WHEN n < 8 THEN max(c) = n ELSE max(c) * 5 >= least(n, 13) * 4 END"""

QUERIES = {"op5_decontamination": op5_decontamination}
ORACLE_SQL = {"op5_decontamination": SQL}
