"""Document quality by weak supervision: rules vote or abstain, and their accuracies are learned.

Each rule says good (1), bad (-1) or abstains (0). The votes of all documents are counted by
pattern, at most 3**rules rows, and expectation-maximisation over these counts estimates the
share of bad documents and how often each rule, where it votes, says bad of a bad and of a good
document. A document's posterior probability of being good then replaces a rule that all must
pass: one vote of a rule that never errs outweighs several of careless ones. Only DataFrame
functions touch documents; the driver sees pattern counts.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmetrics.sources.scratch import scratch_path, written

# White space between words, and the symbols that are counted.
SPACE = "[\\x20\\x09-\\x0D]+"
SPACES = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]
SYMBOLS = ["#", "*", "$", "%", "&", "|", "<", ">"]
# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it was for on are with as at be this from by or an have not "
    "de la le les des en un une du que et dans est pour qui "
    "el los las por con se y no lo su al es "
    "der die das und zu den von mit sich ein ist auf im für"
).split()

ROUNDS = 25


def _occurrences(text: Column, marks: Sequence[str]) -> Column:
    """How many one-byte characters of the text are among the marks."""
    left = text
    for mark in marks:
        left = F.replace(left, F.lit(mark), F.lit(""))
    return (F.octet_length(text) - F.octet_length(left)).cast("long")


_WINDOWS = """
transform(slice(_hashes, 1, greatest(size(_hashes) - 2, 0)),
          (h, i) -> xxhash64(h, get(_hashes, i + 1), get(_hashes, i + 2)))
"""
# Sorted (hash, start) pairs of 3-word windows stand beside their equals; starts of windows with
# an equal neighbour, in order, each cover three words less those the one before covers too.
_REPEATED = """
CASE WHEN _sorted IS NULL THEN 0L ELSE
aggregate(
  sort_array(transform(
    filter(
      arrays_zip(
        slice(_sorted, 2, size(_sorted) - 2),
        slice(_sorted, 1, size(_sorted) - 2),
        slice(_sorted, 3, size(_sorted) - 2)),
      z -> z.`0`.h <=> z.`1`.h OR z.`0`.h <=> z.`2`.h),
    z -> z.`0`.i)),
  named_struct('n', 0L, 'last', -3),
  (a, i) -> named_struct('n', a.n + least(3, i - a.last), 'last', i),
  a -> a.n) END
"""
# Padded by one entry without a hash at either end, so that every pair has two neighbours.
_SORTED = """
CASE WHEN size(array_distinct(_windows)) < size(_windows) THEN
concat(array(named_struct('h', CAST(NULL AS bigint), 'i', -1)),
       sort_array(transform(_windows, (h, i) -> named_struct('h', h, 'i', i))),
       array(named_struct('h', CAST(NULL AS bigint), 'i', -1))) END
"""


def document_signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with what the rules look at, all long: ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_lines`` (with a word), ``n_dup_lines``, ``n_repeat_words``,
    ``n_distinct_words``, ``n_stop_words``, ``n_upper_words`` (runs of capitals), ``n_end_words``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text; NULL or empty text has none, and all its
    counts are 0. Repeated 3-word windows are found by 64-bit hashes within one document. Input
    columns with these names are replaced; names that begin with an underscore are reserved.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    base = docs.withColumn("_text", whole)
    # An empty first or last entry comes of white space at the ends.
    base = base.withColumn("_words", F.array_remove(F.split("_text", SPACE), ""))
    base = base.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    base = base.withColumn("_windows", F.expr(_WINDOWS))
    base = base.withColumn("_sorted", F.expr(_SORTED))
    lines = F.filter(F.split("_text", "\n"), lambda s: s.rlike("[^\\x20\\x09-\\x0D]"))
    base = base.withColumn("_lines", lines)
    n_chars = F.char_length("_text").cast("long")
    signals = {
        "n_words": F.size("_words").cast("long"),
        "word_chars": n_chars - _occurrences(F.col("_text"), SPACES),
        "n_symbols": _occurrences(F.col("_text"), SYMBOLS),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.expr(_REPEATED),
        "n_distinct_words": F.size(F.array_distinct("_hashes")).cast("long"),
        "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(STOP_WORDS))).cast("long"),
        "n_upper_words": F.regexp_count("_text", F.lit("[A-ZÀ-ÖØ-Þ]{2,}")).cast("long"),
        "n_end_words": F.regexp_count("_text", F.lit("[.!?](?=[\\x20\\x09-\\x0D]|\\z)")).cast("long"),
    }
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in signals]
    return base.select(*kept, *[column.alias(name) for name, column in signals.items()])


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        ballot = F.when(F.expr(self.bad), -1).when(F.expr(self.good), 1).otherwise(0)
        return ballot.cast("tinyint")


RULES = [
    Rule("symbols", "n_symbols > 0.1 * n_words", "n_words > 0 AND n_symbols <= 0.02 * n_words"),
    Rule("stop words", "n_words >= 40 AND n_stop_words < 0.04 * n_words",
         "n_stop_words >= 0.12 * n_words AND n_words > 0"),
    Rule("repetition", "n_repeat_words > 0.4 * n_words",
         "n_words >= 20 AND n_repeat_words < 0.15 * n_words"),
    Rule("variety", "n_words >= 50 AND n_distinct_words < 0.3 * least(n_words, 1000)",
         "n_words >= 20 AND n_distinct_words > 0.5 * least(n_words, 1000)"),
    Rule("upper case", "n_words >= 5 AND n_upper_words > 0.4 * n_words",
         "n_words > 0 AND n_upper_words < 0.1 * n_words"),
    Rule("repeated lines", "n_dup_lines > 0.4 * n_lines",
         "n_lines > 0 AND n_dup_lines <= 0.1 * n_lines"),
    Rule("word length", "n_words >= 5 AND (word_chars < 2.5 * n_words OR word_chars > 12 * n_words)",
         "word_chars BETWEEN 4 * n_words AND 7 * n_words AND n_words > 0"),
    Rule("sentence ends", "n_words >= 40 AND n_end_words > 0.6 * n_words",
         "n_end_words BETWEEN 0.03 * n_words AND 0.35 * n_words AND n_words > 0"),
]


@dataclass(frozen=True)
class VoteModel:
    """``bad_share``, and per rule the chance that its vote is bad: (of a bad, of a good one)."""

    bad_share: float
    bad_votes: tuple[tuple[float, float], ...]

    def weight(self, rule: int, vote: int) -> float:
        """Log of how much likelier a bad document draws this vote than a good one."""
        of_bad, of_good = self.bad_votes[rule]
        return math.log(of_bad / of_good) if vote < 0 else math.log((1 - of_bad) / (1 - of_good))

    def bad_odds(self, votes: Sequence[int]) -> float:
        """Log odds that a document with these votes is bad."""
        odds = math.log(self.bad_share / (1 - self.bad_share))
        return odds + sum(self.weight(j, v) for j, v in enumerate(votes) if v)


def fit_votes(
    patterns: Mapping[tuple[int, ...], int], rules: int, rounds: int = ROUNDS
) -> VoteModel:
    """Expectation-maximisation over vote patterns and their counts; the same for any row order.

    It starts from the majority of votes, a bad one counting as four since rules are written to
    vote bad rarely. Pseudo-counts keep every share off 0 and 1, and a rule's bad votes are never
    taken to speak for a document, so the two classes cannot change places.
    """
    ordered = sorted(patterns.items())
    bad = []
    for votes, _ in ordered:
        against, for_it = 4 * sum(v < 0 for v in votes), sum(v > 0 for v in votes)
        bad.append((against + 0.1) / (against + for_it + 1))
    model = VoteModel(0.5, ((0.5, 0.5),) * rules)
    for _ in range(rounds):
        total = sum(n for _, n in ordered)
        mass = sum(p * n for p, (_, n) in zip(bad, ordered))
        shares = []
        for j in range(rules):
            # Votes bad, then all votes; of bad documents, then of good ones.
            tally = [[0.5, 1.0], [0.05, 1.0]]
            for p, (votes, n) in zip(bad, ordered):
                if votes[j]:
                    for k, part in enumerate((p * n, (1 - p) * n)):
                        tally[k][0] += part if votes[j] < 0 else 0.0
                        tally[k][1] += part
            of_bad, of_good = (x / y for x, y in tally)
            shares.append((max(of_bad, of_good), min(of_bad, of_good)))
        model = VoteModel((mass + 0.5) / (total + 1), tuple(shares))
        bad = [1 / (1 + math.exp(-max(-500, min(500, model.bad_odds(v))))) for v, _ in ordered]
    return model


def quality_posterior(
    docs: DataFrame,
    text: str = "text",
    rules: Sequence[Rule] = tuple(RULES),
    rounds: int = ROUNDS,
    drop_text: bool = False,
) -> DataFrame:
    """The documents with their signals, ``votes`` (array<tinyint>, by rule) and ``p_good``.

    One pass over the texts writes the votes to the shared folder; vote patterns are counted over
    all of them (one row per pattern and task is shuffled) and each row is scored. Without
    documents the result is empty. NULL and empty texts draw abstentions only, so their posterior
    is the prior. ``drop_text`` leaves the text out of what is written and returned.
    """
    judged = document_signals(docs, text).withColumn("votes", F.array(*[r.vote() for r in rules]))
    judged = judged.drop(text) if drop_text else judged
    judged = written(judged, scratch_path(docs.sparkSession, "quality-votes"))
    counted = judged.groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    # At most 3**len(rules) rows, whatever the input: 6,561 for the eight rules above.
    patterns = {tuple(r["votes"]): r["n"] for r in counted.collect()}
    model = fit_votes(patterns, len(rules), rounds)
    odds = F.lit(math.log(model.bad_share / (1 - model.bad_share)))
    for j in range(len(rules)):
        vote = F.col("votes")[j]
        odds = odds + F.when(vote < 0, model.weight(j, -1)).when(
            vote > 0, model.weight(j, 1)
        ).otherwise(0.0)
    return judged.withColumn("p_good", 1 / (1 + F.exp(odds)))


def judged_documents(
    docs: DataFrame, text: str = "text", least: float = 0.5, drop_text: bool = False
) -> DataFrame:
    """:func:`quality_posterior` with ``kept``: whether ``p_good`` is at least ``least``."""
    posterior = quality_posterior(docs, text, drop_text=drop_text)
    return posterior.withColumn("kept", F.col("p_good") >= least)
