import math
import re
from collections import Counter

import numpy as np
import pytest

from docframe.llm import lm_score


def brute(docs, order, min_count, alpha):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    c = Counter(tuple(w[i : i + n]) for _, t in docs for w in [words(t)] for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(v for k, v in c.items() if len(k) == 1)

    def score(g):
        if len(g) == 1:
            return math.log(c[g] / total)
        return math.log(c[g] / c[g[:-1]]) if c[g] >= min_count else math.log(alpha) + score(g[1:])

    out = []
    for d, t in docs:
        w = words(t)
        out.append((d, len(w), sum(score(tuple(w[max(0, i - order + 1) : i + 1])) for i in range(len(w)))))
    return out


@pytest.mark.parametrize(("order", "min_count", "small"), [(2, 1, False), (2, 2, True), (3, 1, True), (3, 2, True), (1, 1, True), (4, 3, False), (5, 40, True)])
def test_scores_match_brute_force(spark, sf, order, min_count, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    docs += [(900, None), (901, ""), (902, "alone"), (903, "twice twice"), (903, "twice twice"), (None, "the of the"), (904, "x" * 5000 + " y" * 20_000)]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, g int")
    sizes = {"group_bytes": 5000, "range_bytes": 1500} if small else {}
    got = sorted(((r.doc_id, r.n_tokens, r.score) for r in lm_score.score_documents(df, order=order, min_count=min_count, **sizes).collect()), key=str)
    want = sorted(brute(docs, order, min_count, 0.4), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], atol=1.1e-3)
    assert lm_score.score_documents(df.limit(0)).count() == 0


def test_packing_round_trip():
    rng = np.random.default_rng(0)
    for dtype in (np.uint64, np.uint32):
        x = rng.integers(0, np.iinfo(dtype).max, 1000, dtype=dtype)
        assert (lm_score.unpacked(lm_score.packed(x), dtype) == x).all() and len(lm_score.unpacked(lm_score.packed(x[:0]), dtype)) == 0


def test_words_seen_nowhere_else_back_off(spark, tmp_path):
    docs = [(k, "the cat sat on the mat") for k in range(5)] + [(9, "zq1 zq2 zq3 zq4 zq5 zq6")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.score for r in lm_score.op8_lm_score(spark, str(tmp_path)).collect()}
    assert np.isclose(got[9], 6 * math.log(1 / 36) + 9 * math.log(0.4), atol=1e-3) and got[9] < got[0]
