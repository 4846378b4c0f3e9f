"""Personal data by patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers; these base spans always stay. A conditional
random field over the tokens with a digit or an @ adds what the patterns miss. Its chain links neighbouring tokens, its
skip edges link distant tokens that are repeated or similar (equal texts or digits, equal last seven digits, an address's
local part), each occurrence with the one before, so the number of edges is linear in the text. Loopy belief propagation
spreads labels over both; base tokens are observed. Tokens without digit or @ are outside every entity.

Weights are fitted piecewise (Sutton & McCallum, 2005) from counts over all texts: a multinomial logistic regression for
tokens, and smoothed pointwise mutual information of labels for chain and skip edges. Labels are the base spans, but not
so that the field would only repeat the patterns: tokens outside base spans that skip edges tie to one are left out, not
counted as outside entities, and a third of the base spans (by a hash) are counted in the bare forms that the patterns miss,
once with their label and twice without one. So a bare form alone stays open, and what it repeats decides. The counts are
summed in Spark; the driver gets a row for each combination of features, which are at most some 200,000 by construction.
Every text is then searched whole, row by row, without a shuffle; messages are passed over edges in blocks.

Defined results: null and empty texts have no spans; with no text to learn from, only base spans are found; repeated rows
get equal spans; texts of any length take time and memory linear in their number of tokens.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm.common import read_table

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
ROUNDS = 15
SURE = 0.6
EDGE_BLOCK = 50_000
MASKED = 3
FLUSH = 20_000

_SIGNAL = re.compile(r"[0-9@]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"\S+")
_TRIM = "\"'`()[]{}<>,;:.!?|=*#&%$"

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches of local part, @ and dotted domain, in time linear in the text: only runs before an @ are looked at."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str | None) -> list[Span]:
    """All pattern spans by start, then kind."""
    text = text or ""
    if not _SIGNAL.search(text):
        return []
    out = emails(text)
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return in_order(out)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


N_FEATURES = 41


def token_features(token: str, linked: bool) -> list[int]:
    """Numbers of the features that hold."""
    figures = "".join(c for c in token if c.isdigit() and c.isascii())
    digits = len(figures)
    letters = sum(c.isalpha() for c in token)
    dots, dashes, n = token.count("."), token.count("-"), len(token)
    steps = (1, 2, 3, 5, 7, 9, 11, 14, 16, 17, 20)
    return [
        0,
        1 + sum(digits >= s for s in steps),
        13 + min(dots, 4),
        18 + min(dashes, 3),
        22 + (letters > 0) + (letters > 3),
        25 + ("@" in token),
        27 + token.startswith("+"),
        29 + token.startswith("("),
        31 + (letters > 0 and all(c in "0123456789abcdef" for c in token)),
        33 + linked,
        35 + (digits == n) + (digits * 2 > n),
        38 + (1 + luhn(figures) if 14 <= digits <= 19 else 0),
    ]


@dataclass
class Graph:
    """Nodes of one text with their observed labels (-1: unknown) and edges."""

    spans: list[tuple[int, int]]
    features: np.ndarray
    observed: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def keys_of(token: str) -> list[str]:
    digits = "".join(c for c in token if c.isdigit())
    out = [f"t{token.lower()}"] if len(digits) >= 5 or "@" in token else []
    if len(digits) >= 7:
        out += [f"d{digits}", f"s{digits[-7:]}"]
    if "@" in token:
        out.append(f"l{token.partition('@')[0].lower()}")
    elif len(token) >= 5 and not token.isdigit():
        out.append(f"l{token.lower()}")
    return out


def graph_of(text: str, base: list[Span]) -> Graph | None:
    spans, features, observed, chain, skip = [], [], [], [], []
    last: dict[str, int] = {}
    held = 0
    before = -2
    ends = sorted(base, key=lambda s: s[1])
    for number, m in enumerate(_TOKEN.finditer(text)):
        if not _SIGNAL.search(m[0]):
            continue
        k = len(spans)
        core = m[0].strip(_TRIM) or m[0]
        start = m.start() + m[0].index(core)
        while held < len(ends) and ends[held][2] <= m.start():
            held += 1
        label = next((KINDS.index(s[0]) + 1 for s in ends[held : held + 4] if s[1] < m.end() and s[2] > m.start()), -1)
        linked = before == number - 1
        if linked:
            chain.append((k - 1, k))
        for key in keys_of(core):
            if key in last and last[key] != k:
                skip.append((last[key], k))
            last[key] = k
        spans.append((start, start + len(core)))
        features.append(token_features(m[0], linked))
        observed.append(label)
        before = number
    if not spans:
        return None
    pairs = lambda x: np.array(sorted(set(x)), np.int64).reshape(-1, 2)
    return Graph(spans, np.array(features, np.int8), np.array(observed, np.int8), pairs(chain), pairs(skip))


@dataclass
class SkipChainCRF:
    emission: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def posteriors(self, g: Graph) -> np.ndarray:
        """Label probabilities of the nodes, by loopy sum-product message passing with damping."""
        n = len(g.observed)
        unary = np.zeros((n, len(LABELS)))
        for f in range(g.features.shape[1]):
            unary += self.emission[g.features[:, f]]
        known = g.observed >= 0
        unary[known] = -50.0
        unary[known, g.observed[known]] = 0.0
        sender = np.concatenate([g.chain[:, 0], g.chain[:, 1], g.skip[:, 0], g.skip[:, 1]])
        receiver = np.concatenate([g.chain[:, 1], g.chain[:, 0], g.skip[:, 1], g.skip[:, 0]])
        if len(sender):
            c, s = len(g.chain), len(g.skip)
            potentials = np.stack([self.chain, self.chain.T, self.skip, self.skip.T])
            which = np.repeat(np.arange(4, dtype=np.int8), [c, c, s, s])
            back = np.concatenate([np.arange(c) + c, np.arange(c), np.arange(s) + 2 * c + s, np.arange(s) + 2 * c])
            msg = np.zeros((len(sender), len(LABELS)), np.float32)
            for _ in range(ROUNDS):
                belief = unary + _received(receiver, msg, n)
                new = np.empty_like(msg)
                for at in range(0, len(sender), EDGE_BLOCK):
                    block = slice(at, at + EDGE_BLOCK)
                    out = belief[sender[block]] - msg[back[block]]
                    part = _logsumexp(out[:, :, None] + potentials[which[block]], 1)
                    new[block] = part - _logsumexp(part, 1)[:, None]
                change = np.abs(new - msg).max()
                msg = 0.5 * msg + 0.5 * new
                if change < 1e-3:
                    break
            unary += _received(receiver, msg, n)
        unary -= unary.max(axis=1, keepdims=True)
        p = np.exp(unary)
        return p / p.sum(axis=1, keepdims=True)


def _received(receiver: np.ndarray, msg: np.ndarray, n: int) -> np.ndarray:
    """Sum of the messages to each node."""
    return np.stack([np.bincount(receiver, msg[:, k], n) for k in range(msg.shape[1])], axis=1)


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _information(counts: np.ndarray, agreement: float) -> np.ndarray:
    """Pointwise mutual information of label pairs; ``agreement`` counts are added for equal labels."""
    n = counts + 0.5 + agreement * np.eye(len(LABELS))
    return np.log(n * n.sum() / np.outer(n.sum(axis=1), n.sum(axis=0)))


def bare_forms(kind: str, found: str) -> list[str]:
    """How a span may stand where the patterns miss it: an address's local part; parts of a number, joined or not."""
    if kind == "email":
        return [x for x in [found.partition("@")[0]] if _SIGNAL.search(x)]
    groups = re.findall("[0-9]+", found)
    return sorted({join.join(groups[k:]) for k in range(len(groups)) for join in ("", "-") if sum(map(len, groups[k:])) >= 5})


def statistics(text: str) -> Counter:
    """What a text adds to the fit: ("token", features and label) and ("chain" or "skip", pair of labels) -> count."""
    out: Counter = Counter()
    base = base_spans(text)
    g = graph_of(text, base)
    if g is None:
        return out
    masked = [s for s in base if zlib.crc32(text[s[1] : s[2]].encode("utf-8", "replace")) % MASKED == 0]
    for kind, a, b in masked:
        for form in bare_forms(kind, text[a:b]):
            features = token_features(form, False)
            out["token", (*features, KINDS.index(kind) + 1)] += 1
            out["token", (*features, 0)] += 2
    held = 0
    tied = g.observed >= 0
    while len(g.skip):
        more = tied.copy()
        np.logical_or.at(more, g.skip[:, 0], tied[g.skip[:, 1]])
        np.logical_or.at(more, g.skip[:, 1], tied[g.skip[:, 0]])
        if (more == tied).all():
            break
        tied = more
    open_ = tied & (g.observed < 0)
    label = np.maximum(g.observed, 0).tolist()
    for k, (a, b) in enumerate(g.spans):
        if open_[k]:
            continue
        while held < len(masked) and masked[held][2] <= a:
            held += 1
        if not (label[k] and held < len(masked) and masked[held][1] < b):
            out["token", (*g.features[k].tolist(), label[k])] += 1
    for kind in ("chain", "skip"):
        for u, v in getattr(g, kind).tolist():
            if not (open_[u] or open_[v]):
                out[kind, (label[u], label[v])] += 1
    return out


def fit_counts(counts: Counter, steps: int = 150) -> SkipChainCRF | None:
    """The field for counts as ``statistics`` gives them; None without tokens."""
    tokens = sorted((key, n) for (kind, key), n in counts.items() if kind == "token")
    if not tokens:
        return None
    combos, weight = np.array([key for key, _ in tokens]), np.array([n for _, n in tokens], float)
    x, y, weight = combos[:, :-1], combos[:, -1], weight / weight.sum()
    w = np.zeros((N_FEATURES, len(LABELS)))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = w[x].sum(axis=1)
        p = np.exp(z - _logsumexp(z, 1)[:, None])
        p[np.arange(len(y)), y] -= 1
        g = 1e-4 * w
        np.add.at(g, x, (p * weight[:, None])[:, None, :])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    pairs = {kind: np.zeros((len(LABELS), len(LABELS))) for kind in ("chain", "skip")}
    for (kind, key), n in counts.items():
        if kind != "token":
            pairs[kind][key] += n
    return SkipChainCRF(w, _information(pairs["chain"], 0.0), _information(pairs["skip"], 5.0))


def fit_texts(texts: list[str]) -> SkipChainCRF | None:
    total: Counter = Counter()
    for t in texts:
        total.update(statistics(t or ""))
    return fit_counts(total)


def fit(docs: DataFrame, text_col: str = "text") -> SkipChainCRF | None:
    """The field fitted on all texts; None if no text has a token to learn from."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()

        def rows() -> pd.DataFrame:
            out = pd.DataFrame([(kind, list(key), float(n)) for (kind, key), n in total.items()], columns=["kind", "key", "n"])
            total.clear()
            return out

        for batch in batches:
            for t in batch["t"]:
                total.update(statistics(t))
                if len(total) > FLUSH:
                    yield rows()
        if total:
            yield rows()

    texts = docs.select(F.col(text_col).alias("t")).where(F.col("t").rlike("[0-9@]"))
    summed = texts.mapInPandas(count, "kind string, key array<int>, n double").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    return fit_counts(Counter({(r["kind"], tuple(r["key"])): r["n"] for r in summed.collect()}))  # a row for each combination


def find_spans(text: str | None, model: SkipChainCRF | None) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans, in order."""
    base = base_spans(text)
    g = graph_of(text, base) if text and model and _SIGNAL.search(text) else None
    if g is None or (g.observed >= 0).all():
        return base, base
    p = model.posteriors(g)
    label = np.where((g.observed < 0) & (p.max(axis=1) >= SURE), p.argmax(axis=1), 0)
    linked = {int(b) for _, b in g.chain}
    added: list[list] = []
    open_at = -2
    for k in np.flatnonzero(label).tolist():
        kind = KINDS[label[k] - 1]
        if open_at == k - 1 and k in linked and added[-1][0] == kind:
            added[-1][2] = g.spans[k][1]
        else:
            added.append([kind, *g.spans[k]])
        open_at = k
    return base, in_order(base + [tuple(a) for a in added])


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span (overlapping ones joined) replaced by the first one's kind in brackets."""
    if not spans:
        return text
    out, at = [], 0
    joined: list[list] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if joined and a < joined[-1][2]:
            joined[-1][2] = max(joined[-1][2], b)
        else:
            joined.append([kind, a, b])
    for kind, a, b in joined:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join(out) + text[at:]


def span_column(text: Column, model: SkipChainCRF | None) -> Column:
    """struct(n_email, n_ip, n_card, n_phone, base_sha256, spans): counts and digest of base spans, all spans as text."""

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                base, spans = find_spans(t, model)
                kinds = [s[0] for s in base]
                rows.append((*map(kinds.count, KINDS), hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
            yield pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return of(text)


def redact_column(text: Column, model: SkipChainCRF | None) -> Column:
    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([redacted(t, find_spans(t, model)[1]) for t in texts], dtype=object)

    return of(text)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", span_column(F.col("text"), fit(docs)).alias("s")).select("doc_id", "s.*")


QUERIES = {"op6_pii": op6_pii}
ORACLE_SQL: dict[str, str] = {}
