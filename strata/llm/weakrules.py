"""Quality rules by weak supervision.

Each rule looks at one measure of a text and votes good or bad or abstains.
Nobody says how far a rule can be trusted: expectation-maximisation over all
documents estimates, for either class, how often each rule votes good, bad and
not at all (so how often it is right when it votes), and the share of good
documents. A document is kept if its posterior probability of being good is at
least ``KEEP_AT``; no rule alone decides, as it would if all had to pass.

What EM needs is how many documents show each combination of votes. That is one
aggregation over the corpus with at most ``3 ** len(RULES)`` rows, whatever the
corpus, so EM covers every document and its cost on the driver is fixed. The
starting point and the pseudo-counts (a share of the number of documents) say
only that rules tend to be right; both behave alike at every size. The
posterior is a sum of log ratios, a column expression.

Measures of a text are taken by an Arrow function a few texts at a time; the
texts are read once, their measures written, and both the histogram and the
posterior are read from there.

Defined results: a null or empty text has no words: all measures are 0 and the
base rule fails it; repeated rows each count and each come out; an empty table
gives an empty result; columns named like the result's are replaced, all other
columns asked for by ``carry`` (default: every column) stay.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_name, prepare, written

GOOD, BAD, ABSTAIN = 1, 2, 0
KEEP_AT = 0.5
MIN_WORDS = 50
# Prior: pseudo-documents as a share of all, by class, and the vote tables they are spread by (abstain, good, bad).
STRENGTH = {"bad": 0.01, "good": 0.1}
PRIOR = {"bad": (0.40, 0.30, 0.30), "good": (0.300, 0.695, 0.005)}
# Before the first round: P(good) of a document without and with a vote against it.
START = (0.95, 0.05)
ROUNDS = 500

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines",
            "n_upper", "n_lower", "n_digits", "n_shouts", "n_letter_words", "n_odd_words", "n_same_as_before", "n_long_words")
RESULT = (*MEASURES, "base_failed", "posterior", "kept")


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains (SQL over the measures)."""

    name: str
    bad: str
    good: str = "false"


# Thresholds after the published heuristics for web corpora (word length, symbols, alphabetic words,
# repeated lines and phrases, ended lines). Shares are written as products to stay in whole numbers.
RULES = (
    Rule("word_length", "word_chars < 3 * n_words or word_chars > 10 * n_words",
         "2 * word_chars >= 7 * n_words and word_chars <= 8 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words", "100 * n_symbols <= n_words"),
    Rule("letter_words", "10 * n_letter_words < 8 * n_words", "10 * n_letter_words >= 9 * n_words"),
    Rule("odd_words", "5 * n_odd_words > n_words", "20 * n_odd_words <= n_words"),
    Rule("capitals", "10 * n_upper > 3 * (n_upper + n_lower)", "10 * n_upper <= n_upper + n_lower"),
    Rule("shouting", "10 * n_shouts > n_words"),
    Rule("repeated_lines", "n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines", "n_lines >= 4 and n_dup_lines = 0"),
    Rule("repeated_phrases", "10 * n_repeat_words > 3 * n_words", "10 * n_repeat_words <= n_words"),
    Rule("stuttering", "20 * n_same_as_before > n_words", "200 * n_same_as_before <= n_words"),
    Rule("ended_lines", "10 * n_ended_lines < n_lines", "2 * n_ended_lines >= n_lines"),
    Rule("digits", "5 * n_digits > word_chars"),
    Rule("long_words", "100 * n_long_words > n_words"),
)

_BLANK = " \t\n\x0b\x0c\r"  # \x20 and \x09-\x0D
_BLANKS, _SYMBOLS = _BLANK.encode(), b"#*$%&|<>"
_UPPER, _LOWER, _DIGITS = (bytes(range(ord(a), ord(b) + 1)) for a, b in ("AZ", "az", "09"))
_ASCII_MARKS = bytes(c for c in range(128) if not chr(c).isalpha() and chr(c) not in _BLANK)  # neither letter nor blank
_PROSE = bytes(c for c in range(128) if chr(c).isalnum()) + b".,;:!?'\"()-"  # what words of prose are made of
_PROSE += bytes(range(128, 256))
_ENDS = (".", "!", "?", ":", "…")
LONG_WORD = 40


def _repeated(words: list) -> int:
    """Words in windows of three that occur at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = np.zeros(len(words) + 1, np.int64)  # +1 where a covered stretch begins, -1 behind it
    at = np.fromiter((i for i, w in enumerate(windows) if counts[w] > 1), np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + 3, -1)
    return int((covered.cumsum() > 0).sum())


def measure(text: str) -> tuple:
    """``MEASURES`` of one text. Letters with case are ASCII's; every other code point over 127 counts as a letter."""
    raw = text.encode("utf-8", "surrogatepass")

    def among(some: bytes) -> int:
        return len(raw) - len(raw.translate(None, some))

    words = raw.split()  # bytes are split at \x20 and \x09-\x0D only
    if not words:
        return (0, 0, among(_SYMBOLS), *[0] * (len(MEASURES) - 3))
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    return (
        len(words),
        len(text) - among(_BLANKS),
        among(_SYMBOLS),
        len(lines) - len(set(lines)),
        _repeated(words),
        len(lines),
        sum(line.rstrip(_BLANK + "\"')»”").endswith(_ENDS) for line in lines),
        among(_UPPER),
        among(_LOWER),
        among(_DIGITS),
        raw.count(b"!!") + raw.count(b"??"),
        len(raw.translate(None, _ASCII_MARKS).split()),
        len(raw.translate(None, _PROSE).split()),
        sum(map(operator.eq, words, words[1:])),
        sum(map(LONG_WORD.__lt__, map(len, words))),
    )


def measures(text: Column, at_once: int = 64) -> Column:
    """A struct of ``MEASURES`` (long) of a text column; null counts as empty."""

    @F.arrow_udf(", ".join(f"{m} long" for m in MEASURES))
    def run(texts: pa.Array) -> pa.Array:
        columns = np.empty((len(MEASURES), len(texts)), np.int64)
        for i in range(0, len(texts), at_once):
            for k, text in enumerate(texts.slice(i, at_once).to_pylist(), i):
                columns[:, k] = measure(text or "")
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], names=list(MEASURES))

    return run(text)


def vote(rule: Rule) -> Column:
    """1 good, 2 bad, 0 abstains; texts without words get no vote."""
    return F.expr(f"case when n_words = 0 then {ABSTAIN} when {rule.bad} then {BAD} "
                  f"when {rule.good} then {GOOD} else {ABSTAIN} end")


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words")


@dataclass(frozen=True)
class VoteModel:
    """What EM has found: the share of good documents, and P(vote | class) by class, rule and vote."""

    share_good: float
    votes: np.ndarray  # [2: bad, good][rule][abstain, good, bad]

    def accuracy(self) -> np.ndarray:
        """How often a rule is right when it votes."""
        bad, good = (1 - self.share_good) * self.votes[0], self.share_good * self.votes[1]
        right, wrong = bad[:, BAD] + good[:, GOOD], bad[:, GOOD] + good[:, BAD]
        return right / (right + wrong)

    def weights(self) -> tuple:
        """(log odds of the classes, log ratio of each rule's votes)."""
        return float(np.log(self.share_good / (1 - self.share_good))), np.log(self.votes[1] / self.votes[0])


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> VoteModel:
    """EM over combinations of votes: ``patterns`` [n, rules] of 0, 1, 2 and how many documents show each."""
    rules = patterns.shape[1]
    shown = np.stack([patterns == v for v in range(3)], 2).astype(float)  # [n, rules, 3]
    total = float(counts.sum())
    pseudo = np.stack([STRENGTH[c] * total * np.tile(PRIOR[c], (rules, 1)) for c in ("bad", "good")])
    good = np.where((patterns == BAD).any(1), START[1], START[0])
    before = -np.inf
    for _ in range(rounds):
        weight = np.stack([1 - good, good], 1) * counts[:, None]
        seen = np.einsum("nc,nrv->crv", weight, shown) + pseudo
        votes = seen / seen.sum(2, keepdims=True)
        share = float((weight[:, 1].sum() + total * STRENGTH["good"]) / (total * (1 + sum(STRENGTH.values()))))
        log = np.einsum("nrv,crv->nc", shown, np.log(votes)) + np.log([1 - share, share])
        both = np.logaddexp(log[:, 0], log[:, 1])
        good = np.exp(log[:, 1] - both)
        now = float(counts @ both) + float((pseudo * np.log(votes)).sum())
        if now - before < 1e-9 * total:
            break
        before = now
    return VoteModel(share, votes)


def posterior(model: VoteModel, rules: Sequence[Rule], code: Column) -> Column:
    """Probability of good for a vote combination ``code`` (base-3 digits, first rule first)."""
    bias, ratios = model.weights()
    odds = F.lit(bias)
    for k in range(len(rules)):
        digit = (F.floor(code / F.lit(3 ** k)) % 3).cast("int")
        odds = odds + F.element_at(F.array(*[F.lit(float(x)) for x in ratios[k]]), digit + 1)
    return 1 / (1 + F.exp(-odds))


def learn(votes: DataFrame, rules: Sequence[Rule]) -> VoteModel | None:
    """The model of a table with the column ``votes`` (a combination); None for an empty table."""
    rows = votes.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()  # 3 ** rules at most
    if not rows:
        return None
    codes = np.array([r["votes"] for r in rows], np.int64)
    patterns = codes[:, None] // 3 ** np.arange(len(rules)) % 3
    return fit(patterns, np.array([r["n"] for r in rows], float))


def judge(documents: DataFrame, text: str = "text", carry: Sequence[str] | None = None,
          rules: Sequence[Rule] = RULES) -> DataFrame:
    """``carry`` (default: all columns) and the measures, base_failed, posterior and kept of every row."""
    prepare(documents.sparkSession)
    carry = [c for c in (documents.columns if carry is None else carry) if c.lower() not in RESULT]
    of, votes = free_name(documents, "measured"), free_name(documents, "votes")
    measured = documents.select(*[documents[c] for c in carry], measures(documents[text]).alias(of)).select(*carry, f"{of}.*")
    code = sum((vote(r).cast("long") * 3 ** k for k, r in enumerate(rules)), F.lit(0).cast("long"))
    stored = written(measured.withColumn("base_failed", base_failed()).withColumn(votes, code), "votes")
    model = learn(stored.select(F.col(votes).alias("votes")), rules)
    if model is None:
        return stored.drop(votes).withColumn("posterior", F.lit(None).cast("double")).withColumn("kept", F.lit(False))
    return (stored.withColumn("posterior", posterior(model, rules, F.col(votes))).drop(votes)
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_AT)))
