"""Quality rules that vote, weighed by expectation-maximisation.

Each rule looks at one quantity of a document and votes good (1), bad (-1)
or abstains (0).  Nobody has labelled the documents: how often each rule
votes either way or abstains on good and on bad documents (its accuracies,
given the votes are independent within a class), and the share of good
documents, are estimated by expectation-maximisation, started from "bad if
any rule says so".  A document is kept when its posterior probability of
being good is ``KEEP`` or more.

Documents with equal votes are alike to the model, so all it needs are
the counts of the vote patterns of *all* documents: 3^rules at most,
whatever the input.  They are counted in Spark; the iteration on them
runs on the driver, and the posteriors go back as a table of as many rows.

A document with fewer than ``MIN_WORDS`` words, or more than ``REPEATED``
percent of them inside 8-word windows that the text has twice, fails at
once.

Defined cases: a null text has no words and no lines and fails; a null
doc_id gives a row like others; repeated rows each count and each give a
row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddy.llm.graph import written
from eddy.llm.textarrays import Words, grams, slices, utf8

WINDOW = 8
MIN_WORDS, REPEATED = 20, 30
SYMBOLS = "#*$%&|<>"
KEEP = 0.5
ROUNDS = 200
# Prior counts of a rule's bad, missing and good votes on a class, in
# documents per 1000: they keep rare votes from having no probability.
PRIOR = {"bad": (2.0, 1.0, 0.5), "good": (0.05, 1.0, 2.0)}

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OWN = ("n_upper_words", "n_repeat_pairs")
COUNTS = BASE + OWN
_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True


def _repeated(windows: np.ndarray, width: int) -> int:
    """Words inside windows that occur twice or more."""
    order = np.argsort(windows, kind="stable")
    same = np.flatnonzero(windows[order][1:] == windows[order][:-1])
    if not len(same):
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[same]] = twice[order[same + 1]] = True
    covered = np.zeros(len(windows) + width, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + width, -1)
    return int((np.cumsum(covered) > 0).sum())


def _duplicate_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\n\x0b\x0c\r"):
            n += line in seen
            seen.add(line)
    return n


def counts_of(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The ``COUNTS`` of each text, one row each."""
    out = np.zeros((len(off) - 1, len(COUNTS)), np.int64)
    for a, b in slices(off):
        part, bounds = data[off[a]:off[b]], off[a:b + 1] - off[a]
        words = Words(part, bounds)
        h = words.hashes()
        # code points in words: bytes that don't continue a character
        heads = np.append(0, np.cumsum((part & 0xC0) != 0x80))
        chars = np.append(0, np.cumsum(heads[words.ends] - heads[words.starts]))
        symbols = np.append(0, np.cumsum(_SYMBOL[part]))
        lower = np.append(0, np.cumsum((part >= 97) & (part <= 122)))
        letters = np.append(0, np.cumsum(_LETTERS[part]))
        is_upper = (lower[words.ends] == lower[words.starts]) & (letters[words.ends] - letters[words.starts] >= 2)
        upper = np.append(0, np.cumsum(is_upper))
        for i in range(b - a):
            x, y = words.first[i], words.first[i + 1]
            own = h[x:y]
            out[a + i] = (y - x, chars[y] - chars[x], symbols[bounds[i + 1]] - symbols[bounds[i]],
                          _duplicate_lines(part[bounds[i]:bounds[i + 1]].tobytes()), _repeated(grams(own, WINDOW), WINDOW),
                          upper[y] - upper[x], int((own[1:] == own[:-1]).sum()))
    return out


def _count(batches):
    for batch in batches:
        counts = counts_of(*utf8(batch.column("text")))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in counts.T)], names=["doc_id", *COUNTS])


def text_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, *COUNTS) for each row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_count, ", ".join(f"{c} bigint" for c in ("doc_id", *COUNTS)))


#: Percentages of the words up to which a rule votes good, and from which it votes bad.
SHARES = {"symbols": ("n_symbols", 2, 15), "upper_words": ("n_upper_words", 5, 30), "repeated_pairs": ("n_repeat_pairs", 5, 20),
          "repeated_windows": ("n_repeat_words", 2, 25), "duplicate_lines": ("n_dup_lines", 0, 1)}
#: Code points of a mean word: good inside the first two, bad outside the others.
WORD_LENGTH = (4.5, 6, 4.2, 7)


def rules() -> dict[str, Column]:
    """The rules' votes, each from a quantity that no other rule looks at.

    A rule votes good where its quantity is as in clean text, bad where it is
    far from that, and abstains in between (and on a text without words).
    """
    n, chars = F.col("n_words"), F.col("word_chars")

    def vote(good: Column, bad: Column) -> Column:
        return F.when(n == 0, 0).when(bad, -1).when(good, 1).otherwise(0)

    out = {rule: vote(100 * F.col(c) <= good * n, 100 * F.col(c) >= bad * n) for rule, (c, good, bad) in SHARES.items()}
    low, high, short, long = WORD_LENGTH
    return out | {"word_length": vote((chars >= low * n) & (chars <= high * n), (chars < short * n) | (chars > long * n))}


def fit_votes(patterns: np.ndarray, weights: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """(chances[class, rule, vote + 1], share of good ones); class 0 is bad, 1 good.

    ``patterns[i, r]`` is a vote of -1, 0 or 1; ``weights[i]`` documents
    have these votes.
    """
    one = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)        # document, rule, vote
    prior = np.array([PRIOR["bad"], PRIOR["good"]])[:, None, :] * (weights.sum() / 1000.0)
    p = np.where((patterns < 0).any(axis=1), 0.1, 0.9)
    for _ in range(rounds):
        counts = np.stack([np.einsum("i,irv->rv", weights * c, one) for c in (1 - p, p)]) + prior
        chances = counts / counts.sum(axis=2, keepdims=True)
        share = float(np.clip((weights * p).sum() / weights.sum(), 1e-6, 1 - 1e-6))
        before, p = p, posteriors(patterns, chances, share)
        if np.abs(p - before).max() < 1e-10:
            break
    return chances, share


def posteriors(patterns: np.ndarray, chances: np.ndarray, share: float) -> np.ndarray:
    rule = np.arange(patterns.shape[1])
    ratio = np.log(chances[1] / chances[0])[rule, patterns.astype(int) + 1].sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(np.log(share / (1 - share)) + ratio, -500, 500)))


def judge(docs: DataFrame, keep: float = KEEP) -> DataFrame:
    """(doc_id, *BASE, base_failed, kept, *OWN, posterior, one vote per rule) for each row."""
    spark = docs.sparkSession
    votes = rules()
    names = list(votes)
    counted = written(text_counts(docs), "counts")
    voted = counted.select("*", *[v.cast("int").alias(name) for name, v in votes.items()])
    seen = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("documents")).collect()         # 3^rules at most
    schema = ", ".join(f"{n} int" for n in names) + ", posterior double"
    table = []
    if seen:
        patterns = np.array([[r[n] for n in names] for r in seen], float)
        weights = np.array([r["documents"] for r in seen], float)
        order = np.lexsort(patterns.T)                   # the same sums whatever the order of rows
        patterns, weights = patterns[order], weights[order]
        p = posteriors(patterns, *fit_votes(patterns, weights))
        table = [(*map(int, v), float(x)) for v, x in zip(patterns, p)]
    known = spark.createDataFrame(table, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    return voted.join(F.broadcast(known), names).select(
        "doc_id", *BASE, failed.alias("base_failed"), (~failed & (F.col("posterior") >= keep)).alias("kept"), *OWN, "posterior", *names)
