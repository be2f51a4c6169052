"""Quality rules as weak supervision.

Each rule looks at a few figures of a text and votes good (1), bad (-1) or abstains (0).  How right a rule is
when it votes is estimated from the corpus itself, without labels: expectation-maximisation over a two-class
model in which the rules vote independently given the class.  The posterior probability of good quality
then decides, instead of asking that all rules pass.

The estimate needs only how often each pattern of votes occurs in the whole corpus.  With R rules there are
at most 3^R patterns, whatever the corpus, so every step of the estimation is a small aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .tables import written
from .textmap import held

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
#: Estimation: steps at most, largest change of an estimate that ends it, pseudo-votes, first guess.
STEPS, TOLERANCE, SMOOTHING, FIRST_ACCURACY, FIRST_PRIOR = 25, 1e-4, 1.0, 0.8, 0.8
#: Least posterior probability of a text that is kept.
THRESHOLD = 0.5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window that occurs twice or more.

    Windows are compared by 64-bit hashes of their words' hashes, within one text.
    """
    count = lambda xs: F.size(xs)
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    pairs = lambda h: F.zip_with(h, F.slice(h, F.lit(2), F.greatest(count(h), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    windows = _let(
        hashed,
        lambda h: F.slice(
            F.zip_with(pairs(h), F.slice(h, F.lit(3), F.greatest(count(h), F.lit(1))), lambda a, b: F.xxhash64(a, b)), F.lit(1), F.greatest(count(h) - 2, F.lit(0))
        ),
    )

    def covered(w: Column) -> Column:
        placed = F.sort_array(F.zip_with(w, F.sequence(F.lit(0), count(w) - 1), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        equal_next = lambda p: F.zip_with(p, F.slice(p, F.lit(2), count(p)), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))

        def places(x: Column) -> Column:  # x: sorted windows and whether each equals the next
            after = F.zip_with(x["p"], x["e"], lambda p, e: F.struct(p["i"].alias("i"), e.alias("e")))
            before = F.concat(F.array(F.lit(False)), x["e"])
            repeated = F.zip_with(after, before, lambda a, b: F.when(a["e"] | b, a["i"]))
            return F.sort_array(F.filter(repeated, lambda i: i.isNotNull()))

        sorted_places = _let(placed, lambda p: _let(F.struct(p.alias("p"), equal_next(p).alias("e")), places))
        steps = lambda q: F.zip_with(q, F.slice(q, F.lit(2), count(q)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
        return F.aggregate(_let(sorted_places, steps), F.lit(0), lambda n, s: n + s)

    return F.when(
        count(words) >= 3,
        _let(windows, lambda w: F.when(count(F.array_distinct(w)) < count(w), covered(w)).otherwise(F.lit(0))),
    ).otherwise(F.lit(0))


def _count_of(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def figures(text: Column) -> dict[str, Column]:
    """Base counts of a text and what the rules look at besides (null counts as a text without words)."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACE, -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda s: F.translate(s, SPACES, "") != "")
    counted = _let(words, lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), _repeated_words(w).cast("bigint").alias("n_repeat_words")))
    by_line = _let(lines, lambda s: F.struct(F.size(s).cast("bigint").alias("n_lines"), (F.size(s) - F.size(F.array_distinct(s))).cast("bigint").alias("n_dup_lines")))
    return {
        "counted": counted,
        "by_line": by_line,
        "word_chars": F.char_length(F.translate(text, SPACES, "")).cast("bigint"),
        "n_symbols": _count_of(text, SYMBOLS).cast("bigint"),
        "n_upper": _count_of(text, UPPER).cast("bigint"),
        "n_shouts": _count_of(text, "!?").cast("bigint"),
        "n_digits": _count_of(text, "0123456789").cast("bigint"),
    }


def _vote(bad: Column, good: Column) -> Column:
    return F.coalesce(F.when(bad, F.lit(-1)).when(good, F.lit(1)), F.lit(0))


def votes() -> dict[str, Column]:
    """The rules over the columns of :func:`described`; a text without words gets abstentions but for its length."""
    per_word = lambda c: F.try_divide(F.col(c).cast("double"), F.col("n_words"))
    per_char = lambda c: F.try_divide(F.col(c).cast("double"), F.col("word_chars"))
    long_words = per_word("word_chars")
    lines = F.try_divide(F.col("n_dup_lines").cast("double"), F.col("n_lines"))
    return {
        "length": _vote(F.col("n_words") < MIN_WORDS, F.col("n_words") >= 80),
        "word_length": _vote((long_words < 2) | (long_words > 15), long_words.between(3, 11)),
        "symbols": _vote(per_word("n_symbols") > 0.2, per_word("n_symbols") <= 0.02),
        "repeated_lines": _vote((F.col("n_lines") >= 4) & (lines > 0.3), (F.col("n_lines") >= 4) & (lines <= 0.05)),
        "repeated_words": _vote(per_word("n_repeat_words") > 0.3, per_word("n_repeat_words") <= 0.1),
        "upper_case": _vote(per_char("n_upper") > 0.4, per_char("n_upper") <= 0.1),
        "shouting": _vote(per_word("n_shouts") > 0.3, per_word("n_shouts") <= 0.05),
        "digits": _vote(per_char("n_digits") > 0.3, per_char("n_digits") <= 0.05),
    }


RULES = ["length", "word_length", "symbols", "repeated_lines", "repeated_words", "upper_case", "shouting", "digits"]


def described(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """``struct carry``, the base counts, ``base_failed`` and ``votes`` (an array in the order of ``RULES``)."""
    found = docs.select(held(carry).alias("carry"), *[c.alias(n) for n, c in figures(F.col(f"`{text}`")).items()])
    flat = found.select("carry", "counted.*", "by_line.*", "word_chars", "n_symbols", "n_upper", "n_shouts", "n_digits")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    by_rule = votes()
    return flat.select("carry", *BASE[:-1], failed.alias("base_failed"), F.array(*[by_rule[r] for r in RULES]).alias("votes"))


def posterior(model: dict) -> Column:
    """Probability of good quality of a vote pattern; a rule's two accuracies are those on good and on bad texts.

    The model's numbers go in as arrays, so that every step of the estimation runs the same compiled code.
    """
    prior = F.lit([math.log(model["prior"] / (1 - model["prior"]))])[0]
    said = {1: F.lit([math.log(g / (1 - b)) for g, b in model["accuracy"]]), -1: F.lit([math.log((1 - g) / b) for g, b in model["accuracy"]])}
    odds = F.aggregate(F.concat(*[_said(terms, vote) for vote, terms in said.items()]), prior, lambda s, x: s + x)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def _said(odds: Column, vote: int) -> Column:
    """Log-odds of the rules that vote so, zero for the others."""
    return F.zip_with("votes", odds, lambda v, x: F.when(v == vote, x).otherwise(0.0))


def estimate(patterns: DataFrame, rules: int, steps: int = STEPS) -> dict:
    """Prior and accuracies by expectation-maximisation over ``patterns(votes, n)``.

    Each step is one aggregate over at most 3^rules rows.  It starts from rules that are mostly right and a
    corpus that is mostly good, and pseudo-votes keep every estimate inside (0, 1); so an empty corpus, or a
    rule that always abstains, keeps the first guess.
    """
    model = {"prior": FIRST_PRIOR, "accuracy": [(FIRST_ACCURACY, FIRST_ACCURACY)] * rules}
    last = None
    for _ in range(steps):
        seen = patterns.select("n", (posterior(model) * F.col("n")).alias("good"), F.posexplode("votes").alias("rule", "vote"))
        rows = seen.groupBy("rule", "vote").agg(F.sum("good").alias("good"), F.sum("n").alias("n")).collect()  # three a rule
        good = {(r.rule, r.vote): r.good for r in rows}
        bad = {(r.rule, r.vote): r.n - r.good for r in rows}
        share = lambda right, wrong: (right + SMOOTHING * FIRST_ACCURACY) / (right + wrong + SMOOTHING)
        all_good, every = sum(x for (i, _), x in good.items() if i == 0), sum(r.n for r in rows if r.rule == 0)
        model = {
            "prior": (all_good + SMOOTHING * FIRST_PRIOR) / (every + SMOOTHING),
            "accuracy": [
                (share(good.get((i, 1), 0.0), good.get((i, -1), 0.0)), share(bad.get((i, -1), 0.0), bad.get((i, 1), 0.0)))
                for i in range(rules)
            ],
        }
        flat = [model["prior"], *(x for pair in model["accuracy"] for x in pair)]
        if last and max(abs(a - b) for a, b in zip(flat, last)) < TOLERANCE:
            break
        last = flat
    return model


def judged(docs: DataFrame, text: str = "text", carry: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``struct carry``, the base counts, ``base_failed``, ``votes``, ``posterior`` and ``kept`` of every row.

    A text that fails the base check is never kept; of the others those are whose posterior probability
    reaches ``threshold``.  Null and empty texts have no words and fail; repeated rows each count and stay; an
    empty table gives an empty one; extra columns travel inside carry.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    found = written(described(docs, text, carry), "quality")
    patterns = found.groupBy("votes").agg(F.count(F.lit(1)).cast("double").alias("n")).coalesce(1).checkpoint()
    model = estimate(patterns, len(RULES))
    p = posterior(model)
    return found.withColumn("posterior", p).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def good_documents(docs: DataFrame, text: str = "text", **settings) -> DataFrame:
    """The documents that are kept, with their columns."""
    return judged(docs, text, carry=docs.columns, **settings).where("kept").select(*[F.col(f"carry.`{c}`").alias(c) for c in docs.columns])
