"""Toxicity: a lexicon with weights, misspelled terms included, whose hits are
weighed by the words around them.

The lexicon is learned: words that labelled toxic texts hold much more often
than clean ones, weighted by their log-odds.  ``FuzzyLexicon`` finds them and
their misspellings.  Each hit is worth its term's weight, less for each edit,
times a factor from a window of words around it: quotation marks around it and
words of reporting make it smaller, addressing someone and further hits make it
larger.  A logistic regression on a few sums of hits and the text's length
makes the score.

Only a bounded number of labelled rows is learned from (``MAX_TRAIN_ROWS``,
chosen by hash of the id), and one row of several that share their least
five-word shingle, so that copies do not make their words toxic.  Two thirds
give the lexicon, one third the regression.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, positional, with_package
from .fuzzy_lexicon import FuzzyLexicon

MAX_TRAIN_ROWS = 20_000
#: Terms of the lexicon; the likelihood ratio and log-odds that a word needs.
MAX_TERMS, LEAST_RATIO, LEAST_LOG_ODDS = 2_000, 20.0, 2.0
#: Near words that clean training texts use and so are no misspellings.
MAX_EXEMPT = 10_000
TERM_LENGTHS = (3, 40)
#: What a hit keeps for each edit; words on each side that a window has.
EDIT_DISCOUNT, WINDOW = 0.8, 6
#: Clean words that a Python worker remembers.
CACHE_WORDS = 200_000
SHINGLE = 5

# Opening and closing quotation marks.
QUOTES = {"“": "”", "„": "“", "«": "»", "‹": "›", "‘": "’"}
# Words that report, that deny, and that address someone (English, German, French, Spanish).
REPORTING = frozenset("""
    said says say wrote writes called calls quote quoted quotes quoting word words term terms slur insult insults
    phrase means meaning definition defined reported alleged sagte sagt schrieb nannte wort begriff zitat bedeutet
    dit disait mot terme citation signifie dijo dice palabra cita significa""".split())
DENYING = frozenset("not never no don't isn't nicht kein keine nie pas jamais nunca jamás".split())
ADDRESSING = frozenset("""
    you your yours you're youre u ur du dich dir dein ihr euch tu te toi ton vous votre tú ti usted ustedes
    vosotros""".split())
#: What each sign in a window adds to its score.
QUOTED, REPORTED, DENIED, ADDRESSED, SHOUTED, TOGETHER = -1.5, -1.0, -0.5, 0.7, 0.4, 0.5

_WORD = re.compile(r"\w(?:[\w@$!*'’]*\w)?")


@dataclass
class Model:
    """Lexicon, exempt words and regression weights; ``coef`` is (constant, one
    per feature)."""
    lexicon: FuzzyLexicon
    exempt: frozenset = frozenset()
    coef: np.ndarray = field(default_factory=lambda: np.zeros(6))
    _clean: set = field(default_factory=set, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_clean": set()}

    def near(self, word: str) -> tuple[str, int] | None:
        got = self.lexicon.find(word)
        return None if got and got[1] and word in self.exempt else got

    def hits(self, words: set[str]) -> dict[str, tuple[str, int]]:
        """The words that are terms or misspelled ones, each with (term, edits)."""
        new = words - self._clean
        found = {w: got for w in new if (got := self.near(w))}
        if len(self._clean) > CACHE_WORDS:
            self._clean.clear()
        self._clean.update(new.difference(found))
        return found


def in_test_fold(id_col: str = "doc_id"):
    """Rows whose labels are never learned from; a null id is not one of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def context_score(before: str, after: str, around: list[str], hits_around: int) -> float:
    """Above 0 where the window reads as abuse, below as quotation or report.
    ``before`` and ``after`` are the texts beside a hit, ``around`` its words."""
    score = 0.0
    straight = before.count('"') % 2 == 1 and '"' in after
    curly = any(before.rfind(a) > before.rfind(b) and b in after for a, b in QUOTES.items())
    if straight or curly:
        score += QUOTED
    score += REPORTED * min(2, sum(w in REPORTING for w in around))
    score += DENIED * min(1, sum(w in DENYING for w in around))
    score += ADDRESSED * min(2, sum(w in ADDRESSING for w in around))
    score += SHOUTED * after.lstrip().startswith("!")
    return score + TOGETHER * min(2, hits_around)


def features(text: str | None, model: Model) -> np.ndarray:
    """(all hits, distinct terms, hits a word, longest share, length) as logarithms or rates."""
    low = (text or "").lower()
    words = _WORD.findall(low)
    found = model.hits(set(words))
    if not found:
        return np.array([0.0, 0.0, 0.0, 0.0, np.log1p(len(words))])
    spans = [m.span() for m in _WORD.finditer(low)]
    at = [i for i, w in enumerate(words) if w in found]
    total, best = 0.0, {}
    for j, i in enumerate(at):
        term, edits = found[words[i]]
        first, last = max(0, i - WINDOW), min(len(words), i + WINDOW + 1)
        lone = sum(1 for k in at[max(0, j - WINDOW):j + WINDOW + 1] if k != i and first <= k < last)
        score = context_score(low[spans[first][0]:spans[i][0]], low[spans[i][1]:spans[last - 1][1] + 1],
                              words[first:i] + words[i + 1:last], lone)
        worth = model.lexicon.terms[term] * EDIT_DISCOUNT ** edits * 2.0 / (1.0 + np.exp(-score))
        total += worth
        best[term] = max(best.get(term, 0.0), worth)
    distinct = sum(best.values())
    return np.array([np.log1p(total), np.log1p(distinct), 10.0 * total / (len(words) + 50.0),
                     max(best.values()), np.log1p(len(words))])


def _signature(text: str) -> int:
    """The least CRC-32 of a text's five-word shingles."""
    words = text.lower().split()
    return min(zlib.crc32(" ".join(words[i:i + SHINGLE]).encode()) for i in range(max(1, len(words) - SHINGLE + 1)))


def _training_rows(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str,
                   max_rows: int) -> DataFrame:
    """Stored (__lid, __y, __text, __fit): labelled rows outside the test fold;
    ``__fit`` marks those that the regression is fitted on."""
    known = labels.select(F.col(id_col).alias("__lid"), F.col(label_col).cast("int").alias("__y")).filter(
        ~in_test_fold("__lid") & F.col("__lid").isNotNull() & F.col("__y").isin(0, 1))
    known = known.groupBy("__lid").agg(F.round(F.avg("__y")).cast("int").alias("__y"))
    share = min(1.0, max_rows / max(1, known.count()))
    order = F.pmod(F.xxhash64(F.col("__lid").cast("string")), F.lit(1 << 30))
    chosen = materialise(known.filter(order < int(share * (1 << 30))), "toxic-labels")
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    rows = rows.join(F.broadcast(chosen), F.col("__id") == F.col("__lid")).select("__lid", "__y", "__text")
    rows = rows.groupBy("__lid").agg(F.first("__y").alias("__y"), F.max("__text").alias("__text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = pa.array([_signature(t.as_py()) for t in b.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, made], ["__lid", "__y", "__text", "__sig"])

    kind = rows.dtypes[0][1]
    signed = with_package(rows).mapInArrow(sign, f"__lid {kind}, __y int, __text string, __sig long")
    one = signed.groupBy("__sig", "__y").agg(F.min_by(F.struct("__lid", "__text"), "__lid").alias("r"))
    one = one.select("r.__lid", "__y", "r.__text", (F.pmod(F.xxhash64(F.lit(1), "__sig"), F.lit(3)) == 0).alias("__fit"))
    return materialise(one, "toxic-rows", max_rows)


def _document_counts(rows: DataFrame, pick) -> DataFrame:
    """(word, pos, neg): in how many toxic and clean texts ``pick`` finds each word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1)):
                counts[1 - y].update(pick(set(_WORD.findall(t.as_py().lower()))))
        words = sorted(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in counts)],
            ["word", "pos", "neg"])

    got = with_package(rows.select("__y", "__text")).mapInArrow(run, "word string, pos long, neg long")
    return got.groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def log_odds(pos: float, neg: float, n_pos: int, n_neg: int) -> float:
    return float(np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1)))


def likelihood_ratio(pos: int, neg: int, n_pos: int, n_neg: int) -> float:
    """G of a word's texts against the share of toxic ones."""
    n, share = pos + neg, n_pos / (n_pos + n_neg)
    return 2.0 * sum(k * np.log(k / (n * p)) for k, p in ((pos, share), (neg, 1 - share)) if k)


def _lexicon(rows: DataFrame, n_pos: int, n_neg: int, max_terms: int) -> FuzzyLexicon:
    shortest, longest = TERM_LENGTHS

    def words(found: set[str]) -> list[str]:
        return [w for w in found if shortest <= len(w) <= longest and not w.isdigit()]

    counted = _document_counts(rows, words)
    share = n_pos / (n_pos + n_neg)
    n = F.col("pos") + F.col("neg")

    def part(k, p):
        return F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)

    ratio = 2 * (part(F.col("pos"), F.lit(share)) + part(F.col("neg"), F.lit(1 - share)))
    best = (counted.filter((F.col("pos") > share * n) & (ratio >= LEAST_RATIO))
            .orderBy(ratio.desc(), "word").limit(max_terms).collect())
    weights = {w: log_odds(pos, neg, n_pos, n_neg) for w, pos, neg in best}
    return FuzzyLexicon({w: v for w, v in weights.items() if v >= LEAST_LOG_ODDS})


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a ridge logistic regression with a free constant, by Newton steps."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    z = np.hstack([np.ones((len(x), 1)), x / scale])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge * len(x) / 10)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate([w[:1], w[1:] / scale])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", max_rows: int = MAX_TRAIN_ROWS, max_terms: int = MAX_TERMS) -> Model:
    """The model that the labelled rows of ``docs`` outside the test fold give.

    Labels other than 0 and 1 and null ids are left out; an id counts once,
    with the label that most of its labels have (1 of as many) and the largest
    of its texts.  Without toxic or without clean rows the lexicon is empty and
    every text scores the (smoothed) share of toxic rows.
    """
    rows = _training_rows(docs, labels, label_col, id_col, text_col, max_rows)
    sizes = {(fit, y): n for fit, y, n in rows.groupBy("__fit", "__y").count().collect()}
    pos, neg = sizes.get((False, 1), 0), sizes.get((False, 0), 0)
    toxic, clean = pos + sizes.get((True, 1), 0), neg + sizes.get((True, 0), 0)
    prior = np.log((toxic + 0.5) / (clean + 1.5))
    empty = Model(FuzzyLexicon({}), frozenset(), np.array([prior, 0, 0, 0, 0, 0]))
    if not (pos and neg):
        return empty
    words = rows.filter(~F.col("__fit"))
    lexicon = _lexicon(words, pos, neg, max_terms)
    if not lexicon.terms:
        return empty

    def misspelled(found: set[str]) -> list[str]:
        return [w for w in found if (got := lexicon.find(w)) and got[1]]

    near = _document_counts(words, misspelled).filter("neg > 0").orderBy(F.desc("neg"), "word").limit(MAX_EXEMPT)
    exempt = frozenset(w for w, p, n in near.collect() if log_odds(p, n, pos, neg) < LEAST_LOG_ODDS)
    model = Model(lexicon, exempt)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [features(t.as_py(), model).tolist() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.list_(pa.float64()))], ["y", "x"])

    # bounded by max_rows: some 50 bytes a row
    fit = rows.filter("__fit").select("__y", "__text")
    got = with_package(fit).mapInArrow(measure, "y int, x array<double>").collect()
    y = np.array([r[0] for r in got], float)
    if not 0 < y.sum() < len(y):
        return empty
    model.coef = _fit(np.array([r[1] for r in got]), y)
    return model


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns of ``docs`` and ``__score`` (0 to 1), from the text alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = [float(model.coef[0] + features(t.as_py(), model) @ model.coef[1:])
                 for t in b.column(b.num_columns - 1)]
            scores = 1 / (1 + np.exp(-np.clip(np.array(v, float), -35, 35)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())], names)

    slim = docs.select(*keep, F.col(text_col).alias("__text"))
    names = [*keep, "__score"]
    return with_package(slim).mapInArrow(
        run, ", ".join(f"`{n}` {t}" for n, t in slim.dtypes[:-1]) + ", __score double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """One row per row of ``docs``: (id, held_out, score, predicted).

    ``held_out`` marks the test fold.  Null and empty texts score like a text
    without hits and words.  Rows with a null id are scored and never held
    out; repeated rows score alike; texts are read whole, however long; an
    empty table gives an empty result; other columns are ignored.
    """
    model = train(docs, labels, label_col, id_col, text_col, max_rows)
    out = score(docs, model, [id_col], text_col)
    return out.select(id_col, in_test_fold(id_col).alias("held_out"), F.col("__score").alias("score"),
                      (F.col("__score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id",
               text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``docs`` that score under ``threshold``, all columns kept; nulls as in ``toxicity``."""
    rows, (key, text) = positional(docs, id_col, text_col)
    model = train(rows.withColumnRenamed(key, id_col), labels, label_col, id_col, text, max_rows)
    clean = score(rows, model, rows.columns, text).filter(F.col("__score") < threshold)
    return clean.select(*rows.columns).toDF(*docs.columns)
