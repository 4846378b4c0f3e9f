import base64
import hashlib
import itertools
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docframe.llm import bpe, components, decontamination, language_id, quality, simhash


def read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# SimHash


def brute_fingerprint(text):
    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots_of(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_match_union_find(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(100)] + [(7, 7)]
    edges_only = [e for e in edges if e[0] != e[1]]
    want = roots_of(edges_only, {x for e in edges_only for x in e})
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_links_like_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in read(spark, sf, "documents").collect()]
    docs += [(9000, None), (9001, ""), (9002, " \n"), (9003, "one"), (9003, "one"), (None, "one"), (None, "lonely words here only"), (9004, "É É x\x0by"), (9005, docs[0][1] + " tail")]
    fps = [brute_fingerprint(t) for _, t in docs]
    known = [(d, f) for (d, _), f in zip(docs, fps) if d is not None]
    pairs = [(a, b) for (a, x), (b, y) in itertools.combinations(known, 2) if bin(x ^ y).count("1") <= 2]
    root = roots_of(pairs, {d for d, _ in known})
    df = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id long, text string, fp int")
    got = sorted(map(str, simhash.simhash_components(df).collect()))
    of_fp = {f: root[d] for d, f in known}
    want = [(d, f"{f:016x}", root[d] if d is not None else of_fp.get(f)) for (d, _), f in zip(docs, fps)]
    from pyspark.sql import Row

    assert got == sorted(str(Row(doc_id=d, fingerprint=f, component_id=c)) for d, f, c in want)
    assert simhash.simhash_components(df.limit(0)).count() == 0


def test_ball_finds_all_pairs_within_two_bits(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**63), 2**63, 40)
    values = {int(v) for v in base}
    for v in base:
        for _ in range(6):
            i, j = rng.integers(0, 64, 2)
            values.add(int(np.int64(v) ^ np.int64(np.uint64(1 << int(i)).astype(np.int64)) ^ np.int64(np.uint64(1 << int(j)).astype(np.int64))))
    rows = [(0, v) for v in values]
    got = simhash.ball_candidates(spark.createDataFrame(rows, "block int, value long"), 64).collect()
    near = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= 2
    assert all(near(r.value, r.other) for r in got)
    want = roots_of([(a, b) for a, b in itertools.combinations(values, 2) if near(a, b)], values)
    assert roots_of([(r.value, r.other) for r in got], values) == want


def test_near_copies_go_and_one_stays(spark):
    rng = np.random.default_rng(8)
    vocab = ["w%d" % i for i in range(3000)]
    rows = []
    for g in range(30):
        words = list(rng.choice(vocab, 300))
        rows += [(10 * g, " ".join(words)), (10 * g + 1, " ".join(words))]
        for k in (2, 3):
            edited = list(words)
            for p in rng.integers(0, 300, 4):
                edited[p] = "edit%d" % p
            rows.append((10 * g + k, " ".join(edited)))
    rows += [(10 * g + 5, " ".join(rng.choice(vocab, 200))) for g in range(30)] + [(5, rows[-1][1])] * 0
    rows += [(900, "same row"), (900, "same row"), (901, None), (902, ""), (None, "no id")]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, text_hash string")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda d: (d is None, d))
    assert ids == sorted([10 * g for g in range(30)] + [10 * g + 5 for g in range(30)] + [900, 901]) + [None]


def similar_groups(texts, similarity=0.8, width=5):
    """Root of each text by brute force over all pairs."""
    sets = [{tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} for w in (t.split() for t in texts)]
    where = {}
    for k, x in enumerate(sets):
        for g in x:
            where.setdefault(g, []).append(k)
    both = np.zeros((len(texts), len(texts)), np.int32)
    for ks in where.values():
        both[np.ix_(ks, ks)] += 1
    sizes = np.array([len(x) for x in sets])
    near = both >= similarity * (sizes[:, None] + sizes[None, :] - both) - 1e-9
    return roots_of([(int(a), int(b)) for a, b in np.argwhere(np.triu(near, 1))], range(len(texts)))


def test_parity_signatures_never_exceed_the_difference(spark):
    rng = np.random.default_rng(13)
    texts = [" ".join(rng.choice(["w%d" % i for i in range(40)], int(n))) for n in rng.integers(0, 400, 40)] + ["", "one"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", simhash.shingle_set_column(F.col("text"), 2).alias("s"))
    pairs = df.alias("x").join(df.alias("y"), F.col("x.i") < F.col("y.i")).select("x.i", F.col("y.i").alias("j"), simhash.odd_bins(F.col("x.s.parity"), F.col("y.s.parity")).alias("d"))
    sets = {r.i: set(np.frombuffer(r.s.shingles, np.uint64).tolist()) for r in df.collect()}
    rows = pairs.collect()
    assert all(r.d <= len(sets[r.i] ^ sets[r.j]) for r in rows) and max(r.d for r in rows) > 100


def found_groups(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    first, got = {}, {}
    for r in sorted(simhash.near_duplicates(df).collect(), key=lambda r: r.doc_id):
        got[r.doc_id] = first.setdefault(r.component, r.doc_id)
    return got


def test_one_original_with_2000_different_edits(spark):
    rng = np.random.default_rng(11)
    vocab = ["w%d" % i for i in range(5000)]
    words = list(rng.choice(vocab, 200))
    texts = [" ".join(words)]
    for _ in range(2000):
        edited = list(words)
        for p in rng.choice(200, 4, replace=False):
            edited[p] = str(rng.choice(vocab))
        texts.append(" ".join(edited))
    texts += [" ".join(rng.choice(vocab, 200)) for _ in range(200)]
    want = similar_groups(texts)
    assert sum(r == 0 for r in want.values()) > 1900
    assert found_groups(spark, texts) == want


def test_copies_are_found_whatever_the_edit(spark):
    rng = np.random.default_rng(12)
    vocab = ["w%d" % i for i in range(20_000)]
    texts = []
    for kind in range(3):
        for _ in range(100):
            words = list(rng.choice(vocab, 200))
            at, cut = int(rng.integers(0, 180)), int(rng.integers(14, 44))
            scattered = [str(rng.choice(vocab)) if k in rng.choice(200, 4, replace=False) else w for k, w in enumerate(words)]
            block = words[:at] + list(rng.choice(vocab, 17)) + words[at + 17 :]
            texts += [" ".join(words), " ".join([words[: 200 - cut], scattered, block][kind])]
    want = similar_groups(texts)
    assert sum(k != r for k, r in want.items()) > 100
    assert found_groups(spark, texts) == want


def test_near_copies_are_the_classes_of_fingerprints_and_what_lies_beyond(spark):
    rng = np.random.default_rng(14)
    vocab = ["w%d" % i for i in range(20_000)]
    texts = []
    for _ in range(20):
        line, one, other = (list(rng.choice(vocab, k)) for k in (7, 40, 40))
        edited = [*other[:20], "edit", *other[21:]]
        # equal fingerprints, unlike shingle sets; the third is like the second in its shingles alone
        texts += [" ".join(t) for t in (line * 60 + one, line * 60 + other, line * 2 + edited)]
        texts.append(" ".join(rng.choice(vocab, 80)))
    fps = [brute_fingerprint(t) for t in texts]
    close = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if bin(fps[a] ^ fps[b]).count("1") <= 2]
    alike = similar_groups(texts)
    assert all((k, k + 1) in close and alike[k] != alike[k + 1] == alike[k + 2] and (k + 1, k + 2) not in close for k in range(0, 80, 4))
    want = roots_of([*close, *alike.items()], range(len(texts)))
    assert len(set(want.values())) == 40
    # an id that stands for two different texts links nothing
    rows = [*enumerate(texts), (3, " ".join(rng.choice(vocab, 50))), (None, None), (900, "")]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == sorted([*set(want.values()), 3, 900])


# Decontamination


def test_masks_lose_no_window():
    for length in range(decontamination.MIN_TOKENS, decontamination.WINDOW + 1):
        least = -(-length * 4 // 5)
        for bad in itertools.combinations(range(length), length - least):
            assert any(all(p + o not in bad for o in m) for m in decontamination.MASKS for p in range(length - m[-1]))


def brute_overlaps(docs, items):
    toks = lambda t: [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
    out = set()
    for d, text in docs:
        w = toks(text)
        for i, item in items:
            b = toks(item)
            n = min(13, len(b))
            best = max((sum(0 <= p + k < len(w) and w[p + k] == b[s + k] for k in range(n)) for s in range(len(b) - n + 1) for p in range(-n + 1, len(w))), default=0)
            if n and (best * 5 >= n * 4 if n >= 8 else best == n):
                out.add((d, i, n, best))
    return out


def test_decontamination_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    vocab = ["tok%d" % i for i in range(60)] + ["the"] * 20
    items = [(i, " ".join(rng.choice(vocab, n))) for i, n in enumerate([8, 9, 10, 11, 12, 13, 14, 30, 40, 5])] + [(77, None), (78, "")]
    items += [(20, "only"), (21, "tok1 tok2"), (22, items[6][1]), (23, items[6][1]), (24, items[8][1] + " and its own end"), (25, "changed; changed"), (26, items[0][1][: items[0][1].rindex(" ")])]
    docs = []
    for d in range(120):
        words = list(rng.choice(vocab, int(rng.integers(0, 60))))
        item = items[int(rng.integers(0, 10))][1].split()
        a = int(rng.integers(0, max(1, len(item) - 13)))
        cut = item[a : a + int(rng.integers(8, 20))]
        for p in rng.integers(0, len(cut), int(rng.integers(0, 4))):
            cut[p] = "changed"
        at = int(rng.integers(0, len(words) + 1))
        docs.append((d, " ".join(words[:at]) + " " + ", ".join(cut).upper() + "; " + " ".join(words[at:])))
    docs += [(503, "if only"), (504, "TOK1, tok2"), (505, "tok1 x tok2"), (506, "w " * 3000 + items[8][1] + " w" * 3000 + " tok1 tok2")]
    docs += [(500, None), (501, ""), (502, items[8][1]), (502, items[8][1]), (None, items[7][1])]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string").withColumn("seed", F.lit(1)), spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in decontamination.find_overlaps(df, bench, ["doc_id"]).select("doc_id", "item_id", "window_tokens", "best_match").collect()}
    assert got == brute_overlaps(docs, items)
    clean = decontamination.decontaminate(df, bench)
    assert clean.columns == df.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, t in docs if (d, t) not in {(d, t) for d, t in docs if d in {x[0] for x in got}})
    assert decontamination.decontaminate(df, bench.limit(0)).count() == len(docs)


# Byte-level BPE


def test_bpe_equals_tiktoken(spark, sf):
    import tiktoken

    path, pattern = bpe.vocabulary()
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = [r.text for r in read(spark, sf, "documents").collect()]
    texts += [None, "", " ", "\n\n  x", "é" * 300, "a" * 2000, "日本語のテキスト 🤖🤖", "\u0000ÿ", "1234567890 'll 'S", "<|endoftext|>", "x" * 70 + "yz" * 200]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    coded = df.select("doc_id", bpe.encode_column(F.col("text"), path, pattern).alias("ids"), bpe.digest_column(F.col("text"), path, pattern).alias("d"))
    for r in coded.withColumn("raw", bpe.decode_column(F.col("ids"), path, pattern)).collect():
        want = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.ids == want and bytes(r.raw) == (texts[r.doc_id] or "").encode()
        assert r.d.n_tokens == len(want) and r.d.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.d.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    bad = spark.createDataFrame([([70000],), (None,), ([],)], "ids array<int>").select(bpe.decode_column(F.col("ids"), path, pattern).alias("raw")).collect()
    assert [r.raw for r in bad] == [None, None, b""]


# Language ID


def test_forward_sums_all_segmentations():
    pieces = language_id.Pieces.of(language_id.default_vocabulary())
    probs = np.random.default_rng(0).random((pieces.unknown + 1, 2))

    def total(s, k):
        if not s:
            return 1.0
        out = probs[pieces.unknown, k] * total(s[1:], k) if s[0] not in pieces.number else 0.0
        return out + sum(probs[pieces.number[s[:j]], k] * total(s[j:], k) for j in range(1, len(s) + 1) if s[:j] in pieces.number)

    model = language_id.LanguageModel(["a", "b"], probs, language_id.default_vocabulary())
    words = ["the", "ungheit", "éあa"]
    got = model.word_scores(words)
    for w, row in zip(words, got):
        assert row == pytest.approx([math.log(total("▁" + w, k)) for k in (0, 1)])


def exact_total(s, pieces, probs):
    """The sum over all segmentations as an exact fraction, for words of any length."""
    from fractions import Fraction

    ways = [Fraction(1)]
    for j in range(1, len(s) + 1):
        found = sum((ways[i] * Fraction(float(probs[pieces.number[s[i:j]]])) for i in range(max(0, j - 40), j) if s[i:j] in pieces.number), Fraction(0))
        if s[j - 1] not in pieces.number:
            found += ways[j - 1] * Fraction(float(probs[pieces.unknown]))
        ways.append(found)
    return ways[-1]


def test_long_words_sum_all_segmentations():
    pieces = language_id.Pieces.of(language_id.default_vocabulary())
    probs = np.maximum(np.random.default_rng(1).random((pieces.unknown + 1, 2)) ** 8 * 1e-3, language_id.FLOOR)
    model = language_id.LanguageModel(["a", "b"], probs, language_id.default_vocabulary())
    words = ["internationalisation" * 5, "あ" * 100, "x" * 39, "x" * 38, "thequickbrownfox" * 30]
    for w, row in zip(words, model.word_scores(words)):
        want = [exact_total("▁" + w, pieces, probs[:, k]) for k in (0, 1)]
        assert row == pytest.approx([math.log(x.numerator) - math.log(x.denominator) for x in want])


def test_fit_by_logarithms_equals_plain_products():
    from collections import Counter

    pieces = language_id.Pieces.of(language_id.default_vocabulary())
    probs = np.full(pieces.unknown + 1, 1e-3)
    parts, weight = ["▁the", "▁ungheit", "▁日本"], np.array([3.0, 1.0, 2.0])
    plain, logs = (language_id.expected_pieces(parts, weight, pieces, probs, log) for log in (False, True))
    assert plain == pytest.approx(logs)
    sizes = np.ones(len(probs))
    for p, k in pieces.number.items():
        sizes[k] = len(p)
    assert (plain * sizes).sum() == pytest.approx(sum(w * len(s) for s, w in zip(parts, weight)))  # every letter is covered once
    fitted = language_id.fit_pieces(Counter({"the": 5, "a" * 300: 2}), pieces)
    assert np.isfinite(fitted).all() and fitted[pieces.number["▁the"]] > 100 * np.median(fitted)


def test_words_have_letters_and_marks():
    assert language_id.words_of("½ ² ① १२ 12 _") == [] and language_id.words_of("हिन्दी e\u0301té don't") == ["हिन्दी", "e\u0301té", "don", "t"]


def test_language_sample_is_bounded(spark):
    rows = [(1, "immer wieder der gleiche Text", "de")] * 3000 + [(i, f"some text number {i}", "en") for i in range(3000)] + [(i, "x", f"odd{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    chosen = language_id.sampled_by(df.select(F.col("doc_id").cast("string").alias("k"), F.col("text").alias("t"), F.col("lang").alias("l")), "l", {"de": 3000, "en": 3000}, 20)
    assert {r["l"]: r["count"] for r in chosen.groupBy("l").count().collect()} == {"de": 20, "en": 20}
    assert language_id.fit(df, language_id.default_vocabulary(), max_sample=20, max_languages=2).languages == ["de", "en"]


def test_sample_is_bounded(spark):
    from docframe.llm.common import sampled

    df = spark.createDataFrame([(7, "same") for _ in range(5000)] + [(i, f"t{i}") for i in range(500)], "k long, t string")
    for bound in (1, 80, 800):
        rows = sampled(df, F.struct("k", "t"), bound)
        assert rows.count() == bound and rows.columns == ["k", "t"]
        assert sorted(rows.collect()) == sorted(sampled(df.repartition(7), F.struct("k", "t"), bound).collect())
    assert sampled(df.limit(0), F.struct("k", "t"), 5).count() == 0


def test_language_is_found_on_held_out_rows(spark):
    from docframe.llm.common import fold

    docs = read(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in language_id.op10_language_id(spark, "/root/testdata/sf0.01").collect()}
    rows = docs.collect()
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if got[r.doc_id].held_out]
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) > 0.97
    model = language_id.fit(docs.where(fold(F.col("doc_id"), 4) != 2), language_id.default_vocabulary())
    odd = spark.createDataFrame([(None,), ("",), ("12 !?",), ("the and of " * 3,), ("x" * 500,)], "text string")
    p = [r.p for r in odd.select(language_id.predict_column(F.col("text"), model).alias("p")).collect()]
    assert [x.lang for x in p[:3]] == ["und"] * 3 and [x.score for x in p[:3]] == [0.0] * 3
    assert p[3].lang == "en" and all(0 <= x.score <= 1 for x in p)
    empty = language_id.fit(docs.limit(0), language_id.default_vocabulary())
    assert {r.p.lang for r in odd.select(language_id.predict_column(F.col("text"), empty).alias("p")).collect()} == {"und"}


# Quality


def auc(score, label):
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(order))
    ranks[order] = np.arange(len(order))
    pos = label == 1
    return (ranks[pos].mean() - (pos.sum() - 1) / 2) / (~pos).sum()


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in quality.op3_quality(spark, sf).collect()}
    labels = defaultdict(int, {r.doc_id: r.quality for r in read(spark, sf, "labels").collect()})
    held = [d for d in got if got[d].held_out and d in labels]
    s, y = np.array([got[d].score for d in held]), np.array([labels[d] for d in held])
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d in got)
    assert auc(s, y) > 0.9
    assert np.mean([got[d].predicted for d in held if labels[d] == 1]) > 0.9


def test_gradient_of_the_non_negative_risk():
    rng = np.random.default_rng(9)
    pos, unl = rng.normal(1, 1, (30, 4)), rng.normal(0, 1, (50, 4))
    w = [rng.normal(0, 0.5, (4, 3)), rng.normal(0, 0.5, 3), rng.normal(0, 0.5, 3), rng.normal(0, 0.5, 1)]
    loss = lambda z: math.log(1 + math.exp(-z))

    def out(weights, x):
        return float(sum(weights[2][j] * math.tanh(sum(x[i] * weights[0][i, j] for i in range(4)) + weights[1][j]) for j in range(3)) + weights[3][0])

    def parts(weights, prior):
        plus = prior * sum(loss(out(weights, x)) for x in pos) / len(pos)
        minus = sum(loss(-out(weights, x)) for x in unl) / len(unl) - prior * sum(loss(-out(weights, x)) for x in pos) / len(pos)
        return plus, minus

    for prior, sign in ((0.3, 1), (4.0, -1)):
        plus, minus = parts(w, prior)
        risk = (lambda weights: sum(parts(weights, prior))) if minus >= 0 else (lambda weights: -parts(weights, prior)[1])
        assert (minus >= 0) == (sign > 0)
        negative, grads = quality.pu_gradient(w, pos, unl, prior)
        assert negative == pytest.approx(minus)
        for k, g in enumerate(grads):
            for at in itertools.product(*map(range, g.shape)):
                up, down = ([a.copy() for a in w] for _ in range(2))
                up[k][at] += 1e-5
                down[k][at] -= 1e-5
                assert g[at] == pytest.approx((risk(up) - risk(down)) / 2e-5, abs=1e-6)


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(10)
    pos = rng.normal(2, 1, (2000, 3))
    unl = np.concatenate([rng.normal(2, 1, (800, 3)), rng.normal(-2, 1, (1200, 3))])
    assert quality.estimate_prior(pos, rng.permutation(unl)) == pytest.approx(0.4, abs=0.1)


def test_quality_sample_is_bounded(spark):
    docs = spark.createDataFrame([(2, "the same text", 1)] * 2000 + [(i, f"text {i} of its own", 0) for i in range(300)], "doc_id long, text string, x int")
    labels = spark.createDataFrame([(2, 1)] * 500, "doc_id long, quality int")
    model = quality.fit(docs, labels, max_sample=50)
    assert model.weights is not None


def test_quality_odd_rows(spark, sf):
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    odd = spark.createDataFrame([(1, None, 0), (None, "", 0), (3, "word " * 50_000, 0), (3, "word " * 50_000, 0)], "doc_id long, text string, x int")
    model = quality.fit(docs.select("doc_id", "text").union(odd.select("doc_id", "text")), labels)
    scores = [r.s for r in odd.select(quality.score_column(F.col("text"), model).alias("s")).collect()]
    assert scores[0] == scores[1] and scores[2] == scores[3] and all(0 <= s <= 1 for s in scores)
    none = quality.fit(docs, labels.limit(0))
    assert {r.s for r in odd.select(quality.score_column(F.col("text"), none).alias("s")).collect()} == {0.5}
    assert quality.drop_low_quality(odd, labels.limit(0)).columns == odd.columns
    assert quality.drop_low_quality(odd.limit(0), labels).count() == 0


def test_bpe_long_pieces_equal_tiktoken():
    import random

    import tiktoken

    path, pattern = bpe.vocabulary()
    encoder = bpe.Encoder.of(path, pattern)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=encoder.ranks, special_tokens={})
    random.seed(4)
    word = lambda letters, n: "".join(random.choice(letters) for _ in range(n))
    known = [t.decode("utf-8", "ignore") for t in encoder.ranks]
    known = [t for t in known if t.isalpha()]
    long = ["a" * 1_000_001, "abcabcab" * 3000, word("abcdefghij", 4000), word("ab", 9000), "日本語" * 2000, "—" * 5000, "thetheandofin" * 900, "abcdefg" * 900, word(known, 6000), word(known, 500).lower()]
    long += [word("etaoin", n) for n in range(2 * bpe.STEP - 3, 2 * bpe.STEP + 4)]
    short = [word("abcdeéth", random.randint(2, 60)) for _ in range(1500)]
    for text, ids in zip(long + short, encoder.merge([t.encode() for t in long + short]), strict=True):
        assert ids == library._encode_single_piece(text.encode())


def test_bpe_seams_without_a_common_token_are_encoded_again():
    encoder = bpe.Encoder.of(*bpe.vocabulary())
    piece = b"q" * 3 + b"abcdefghijklmnopqrstuvwxyz" * 12
    whole = encoder._merge([piece])[0]
    left = encoder._merge([piece[:192]])[0]
    encoder._stitch(piece, left, 192, [], 96, 288)  # a right block without a token in common
    assert left == encoder._merge([piece[:288]])[0] != whole


def test_bpe_decodes_the_ids_and_bounds_its_cache(monkeypatch):
    path, pattern = bpe.vocabulary()
    encoder = bpe.Encoder(path, pattern)
    monkeypatch.setattr(encoder, "chunk_ids", 7)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 2000)
    texts = [f"word{i} and some longer text {i}" for i in range(40)] + [None, ""]
    for t, (ids, raw) in zip(texts, encoder.texts(texts), strict=True):
        assert raw == (t or "").encode() and encoder.join([ids])[0] == raw
    encoder.cache = {p: b"\0\0\0\0" for p in encoder.cache}  # wrong ids give wrong bytes
    assert next(iter(encoder.texts([texts[-3]])))[1] != texts[-3].encode()
    encoder.learn({"x" * 100})
    before = len(encoder.cache)
    for i in range(60):
        encoder.learn({f"piece{i}"})
    assert len(encoder.cache) < before + 60


def test_the_pipelines_encoder_leaves_nothing_behind_a_batch(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(bpe, "CACHE_BYTES", 100_000)
    encoder = bpe.Encoder(*bpe.vocabulary(), part=16)
    batches = [pd.Series([f"batch{b} piece{b}x{i} qz{i}" for i in range(100)] + [None]) for b in range(4)]
    for texts, rows in zip(batches, encoder.checked(iter(batches))):
        assert encoder._db is None and encoder.held < 250 * 1000  # one batch's pieces at most lie above a quarter of the bound
        usual = bpe.Encoder.of(*bpe.vocabulary()).encode(texts.tolist())
        assert rows["decodes"].all() and all(np.array_equal(a, b) for a, b in zip(rows["ids"], usual, strict=True))
    assert not encoder.cache
