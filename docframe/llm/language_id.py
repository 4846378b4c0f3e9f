"""Language ID by segmentation-marginalised unigrams over a fixed public vocabulary of pieces.

Each language has a probability for every piece. A word's probability is the sum over all its segmentations into pieces,
by a forward algorithm over the whole word (sums of logarithms for long ones, whose products leave the range of doubles);
a text's is the product over its words. A word is a letter and the letters and combining marks after it. Probabilities are
fitted by expectation maximisation (forward and backward over the same lattices) on at most ``max_sample`` labelled texts
of any length for each of the ``max_languages`` most frequent labels, chosen by a hash over all labelled rows. Scoring
covers every word of every text, row by row, without a shuffle; the results of distinct words stay in a cache of bounded
bytes in the Python worker.

Defined results: a null text, one without a letter, or any text when no language was learned: ``und`` with score 0.
Otherwise the most probable language with its posterior; among equal ones the first in alphabetical order. Repeated rows
get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docframe.llm.common import fold, read_table

MAX_SAMPLE = 150
MAX_LANGUAGES = 256
FOLDS, HELD_OUT = 4, 2
FLOOR = 1e-7
#: Letters up to which products of probabilities of FLOOR or more stay above the least double.
PLAIN = 39
SMOOTHING = 0.01
BATCH_CELLS = 400_000
#: Bytes of scores and of words that a Python worker keeps.
CACHE_BYTES = 64_000_000
SPLIT_CHARS = 4_000_000
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_START = "▁"


class Pieces:
    """The vocabulary: text of a piece -> number; the last number stands for any character outside it."""

    _made: dict[str, Pieces] = {}

    @classmethod
    def of(cls, path: str) -> Pieces:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        kept = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.number = {p: i for i, p in enumerate(dict.fromkeys(kept))}
        self.unknown = len(self.number)
        self.heads = {p[:k] for p in self.number for k in range(1, len(p) + 1)}

    def lattice(self, parts: list[str]) -> tuple[np.ndarray, ...]:
        """(part, start, end, piece) of each piece in each part, by end and then part."""
        number, heads, unknown = self.number, self.heads, self.unknown
        part, start, end, piece = (array("i") for _ in range(4))
        for k, s in enumerate(parts):
            n = len(s)
            for i in range(n):
                if s[i] not in number:
                    part.append(k), start.append(i), end.append(i + 1), piece.append(unknown)
                for j in range(i + 1, n + 1):
                    head = s[i:j]
                    if head not in heads:  # no piece begins like this
                        break
                    p = number.get(head)
                    if p is not None:
                        part.append(k), start.append(i), end.append(j), piece.append(p)
        a = np.array([np.frombuffer(x, np.int32) if x else np.empty(0, np.int32) for x in (part, start, end, piece)])
        return tuple(a[:, np.lexsort((a[0], a[2]))])


def batches(words: list[str]) -> Iterator[tuple[np.ndarray, list[str], bool]]:
    """Places and texts of words of like lengths, with ``_START`` before them, and whether they need logarithms."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        log = lengths[order[at]] > PLAIN
        end = at + 1
        while end < len(order) and (lengths[order[end]] > PLAIN) == log and (end + 1 - at) * lengths[order[end]] <= BATCH_CELLS:
            end += 1
        yield order[at:end], [_START + words[k] for k in order[at:end]], bool(log)
        at = end


def _algebra(log: bool) -> tuple:
    """Sum, product, zero and one of probabilities or of their logarithms."""
    return (np.logaddexp, np.add, -np.inf, 0.0) if log else (np.add, np.multiply, 0.0, 1.0)


def forward(parts: list[str], lattice: tuple[np.ndarray, ...], probs: np.ndarray, log: bool = False) -> np.ndarray:
    """(parts, longest part + 1, languages): probability of each beginning of each part over all its segmentations."""
    part, start, end, piece = lattice
    plus, times, zero, one = _algebra(log)
    alpha = np.full((len(parts), max(map(len, parts), default=0) + 1, probs.shape[1]), zero)
    alpha[:, 0] = one
    bounds = np.searchsorted(end, np.arange(1, alpha.shape[1] + 1))
    for j in range(1, alpha.shape[1]):
        a, b = bounds[j - 1], bounds[j]
        if a < b:
            w = part[a:b]
            heads = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            alpha[w[heads], j] = plus.reduceat(times(alpha[w, start[a:b]], probs[piece[a:b]]), heads)
    return alpha


def expected_pieces(parts: list[str], weight: np.ndarray, pieces: Pieces, probs: np.ndarray, log: bool) -> np.ndarray:
    """How often each piece is expected in the weighted parts, over all segmentations."""
    part, start, end, piece = lattice = pieces.lattice(parts)
    plus, times, zero, one = _algebra(log)
    values = np.log(probs) if log else probs
    lengths = np.array([len(s) for s in parts])
    alpha = forward(parts, lattice, values[:, None], log)[:, :, 0]
    beta = np.full_like(alpha, zero)
    beta[np.arange(len(parts)), lengths] = one
    order = np.lexsort((part, -start))
    bounds = np.searchsorted(-start[order], -np.arange(alpha.shape[1], -2, -1))
    for i in range(alpha.shape[1] - 2, -1, -1):
        k = alpha.shape[1] - i
        e = order[bounds[k] : bounds[k + 1]]
        if len(e):
            w = part[e]
            heads = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            beta[w[heads], i] = plus.reduceat(times(beta[w, end[e]], values[piece[e]]), heads)
    joint = times(times(alpha[part, start], values[piece]), beta[part, end])
    whole = alpha[part, lengths[part]]
    share = np.exp(joint - whole) if log else joint / whole
    return np.bincount(piece, share * weight[part], len(probs))


def fit_pieces(words: Counter, pieces: Pieces, rounds: int = 3) -> np.ndarray:
    """Piece probabilities of one language from its words, by expectation maximisation."""
    known = sorted(words)
    weight = np.array([words[w] for w in known], float)
    size = pieces.unknown + 1
    probs = np.full(size, 1 / size)
    for _ in range(rounds):
        expected = np.zeros(size)
        for places, parts, log in batches(known):
            expected += expected_pieces(parts, weight[places], pieces, probs, log)
        probs = np.maximum((expected + SMOOTHING) / (expected.sum() + SMOOTHING * size), FLOOR)
    return probs


@dataclass
class LanguageModel:
    languages: list[str]
    probs: np.ndarray
    vocabulary: str

    def word_scores(self, words: list[str]) -> np.ndarray:
        """(words, languages): log-probabilities."""
        pieces, out = Pieces.of(self.vocabulary), np.zeros((len(words), len(self.languages)))
        logs = np.log(self.probs)
        for places, parts, log in batches(words):
            alpha = forward(parts, pieces.lattice(parts), logs if log else self.probs, log)
            ends = alpha[np.arange(len(parts)), [len(s) for s in parts]]
            out[places] = ends if log else np.log(ends)
        return out


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def word_column(text: Column) -> Column:
    @F.pandas_udf("array<string>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([words_of(t) for t in texts], dtype=object)

    return of(text)


def sampled_by(rows: DataFrame, group: str, totals: dict, bound: int) -> DataFrame:
    """At most ``bound`` rows for each group in ``totals`` (its number of rows), by the smallest hashes of the whole row."""
    spark = rows.sparkSession
    hashed = rows.withColumn("h", F.xxhash64(F.lit("sample"), *rows.columns))
    part = {g: min(1.0, 4 * bound / n) for g, n in totals.items()}
    while True:
        cuts = spark.createDataFrame([(g, min((1 << 63) - 1, -(1 << 63) + int(p * (1 << 64)))) for g, p in part.items()], f"{group} string, cut long")
        below = hashed.join(F.broadcast(cuts), group).where("h <= cut")  # a row for each learned language
        found = {r[group]: r["n"] for r in below.groupBy(group).agg(F.count(F.lit(1)).alias("n")).collect()}
        short = [g for g, p in part.items() if p < 1 and found.get(g, 0) < min(bound, totals[g])]
        if not short:
            break
        part |= {g: min(1.0, 8 * part[g]) for g in short}
    place = F.row_number().over(Window.partitionBy(group).orderBy("h"))
    return below.withColumn("place", place).where(F.col("place") <= bound).drop("place", "cut", "h")


def fit(labelled: DataFrame, vocabulary: str, max_sample: int = MAX_SAMPLE, max_languages: int = MAX_LANGUAGES, key: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """``labelled`` rows with a null language or text are ignored."""
    rows = labelled.select(F.col(key).cast("string").alias("k"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).where("l is not null and t is not null")
    totals = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(max_languages).collect()}
    words: dict[str, Counter] = {lang: Counter() for lang in totals}
    if totals:
        chosen = sampled_by(rows, "l", totals, max_sample)
        for r in chosen.select("l", F.explode(word_column(F.col("t"))).alias("w")).groupBy("l", "w").agg(F.count(F.lit(1)).alias("n")).collect():
            words[r["l"]][r["w"]] = r["n"]
    languages = sorted(lang for lang in words if words[lang])
    pieces = Pieces.of(vocabulary)
    probs = np.stack([fit_pieces(words[lang], pieces) for lang in languages], axis=1) if languages else np.zeros((0, 0))
    return LanguageModel(languages, probs, vocabulary)


class WordScores:
    """Scores of distinct words, kept between the tasks of a Python worker for the model in use."""

    _made: dict[bytes, WordScores] = {}

    @classmethod
    def of(cls, model: LanguageModel) -> WordScores:
        key = hashlib.sha256(repr((model.languages, model.vocabulary)).encode() + model.probs.tobytes()).digest()
        if key not in cls._made:
            cls._made.clear()
            cls._made[key] = cls(model)
        return cls._made[key]

    def __init__(self, model: LanguageModel):
        self.model = model
        self.index: dict[str, int] = {}
        self.chars = 0
        self.table = np.zeros((CACHE_BYTES // (8 * max(1, len(model.languages))) // 4, max(1, len(model.languages))))

    def learn(self, words: set[str]) -> None:
        new = sorted(words.difference(self.index))
        if len(self.index) + len(new) > len(self.table) or self.chars > CACHE_BYTES:
            self.index.clear()
            self.chars = 0
            new = sorted(words)
            if len(new) > len(self.table):
                self.table = np.zeros((len(new), self.table.shape[1]))
        if new:
            base = len(self.index)
            self.table[base : base + len(new)] = self.model.word_scores(new)
            self.index.update((w, base + i) for i, w in enumerate(new))
            self.chars += sum(map(len, new))


def predict_column(text: Column, model: LanguageModel) -> Column:
    """struct(lang, score)."""

    @F.pandas_udf("lang string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = WordScores.of(model)
        for texts in batches:
            rows = []
            texts = texts.tolist()
            at = 0
            while at < len(texts):
                split, seen, size = [], set(), 0
                while at < len(texts) and size < SPLIT_CHARS:
                    split.append(words_of(texts[at]) if model.languages else [])
                    seen.update(split[-1])
                    size += len(texts[at] or "")
                    at += 1
                known.learn(seen)
                for words in split:
                    if not words:
                        rows.append(("und", 0.0))
                        continue
                    logs = known.table[[known.index[w] for w in words]].sum(axis=0)
                    best = int(logs.argmax())
                    rows.append((model.languages[best], float(1 / np.exp(logs - logs[best]).sum())))
            yield pd.DataFrame(rows, columns=["lang", "score"])

    return of(text)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    left_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    model = fit(docs.where(~left_out), default_vocabulary())
    out = docs.select("doc_id", F.coalesce(left_out, F.lit(False)).alias("held_out"), predict_column(F.col("text"), model).alias("p"))
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


QUERIES = {"op10_language_id": op10_language_id}
ORACLE_SQL: dict[str, str] = {}
