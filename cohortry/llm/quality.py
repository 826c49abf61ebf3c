"""Quality rules that vote, weighed by weak supervision.

Each rule votes pass (1) or fail (-1) on a document, or abstains (0).  How far a
rule can be trusted is not set by hand: expectation-maximisation over the votes of
the whole corpus estimates the share of good documents and, per rule, how often
it passes good ones and fails bad ones.  A document is kept if it is probably good
given its votes, instead of having to pass every rule.

Everything is DataFrame and SQL functions.  The texts are read once; the votes
are written, counted per combination, and each step of the iteration is one
aggregate over those combinations (at most 3 ** rules rows, however many
documents there are).

Rows: a null or empty text has no words and fails the base; repeated rows are
judged alike; doc_id may be null; other columns are ignored by ``features`` and
kept by ``kept_documents``; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.stash import stash

# What words and lines are, and what counts as a symbol.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PCT = 50

STEPS = 30
# Rules are precise but narrow: a good document seldom fails one, and a bad one
# fails the few that aim at its fault.  The iteration starts from these rates and
# counts them as PRIOR_VOTES votes.
GOOD_PASSES, BAD_FAILS = 0.95, 0.4
PRIOR_VOTES = 20.0
GOOD_RANGE, BAD_RANGE = (0.7, 0.995), (0.05, 0.995)
PRIOR_SHARE = 0.8

# Rule: (passes if, fails if); it abstains where neither holds.
RULES = {
    "length": ("n_words >= 80", "n_words < 50"),
    "word_length": (
        "word_chars BETWEEN 3 * n_words AND 10 * n_words",
        "word_chars < 2 * n_words OR word_chars > 14 * n_words",
    ),
    "symbols": ("100 * n_symbols <= 2 * n_words", "100 * n_symbols > 10 * n_words"),
    "bare_words": ("100 * n_bare_words <= n_words", "100 * n_bare_words > 8 * n_words"),
    "letters": ("100 * n_letters >= 85 * word_chars", "100 * n_letters < 70 * word_chars"),
    "lines": ("n_dup_lines = 0 AND n_lines >= 3", "n_dup_lines >= 2 AND 100 * n_dup_lines > 30 * n_lines"),
    "repeats": ("100 * n_repeat_words <= 10 * n_words", "100 * n_repeat_words > 30 * n_words"),
    "endings": ("100 * n_ended_lines >= 50 * n_lines", "100 * n_ended_lines < 10 * n_lines"),
}

_WORD = r"[^\x20\x09-\x0D]"
_GAP = r"[\x20\x09-\x0D]+"


def _let(name: str, value: str, body: str) -> str:
    """SQL that works out ``value`` once and uses it by ``name`` in ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _words(text: str) -> str:
    return f"filter(split({text}, r'{_GAP}'), w -> w <> '')"


def _repeated_words(words: str) -> str:
    """Words covered by the three-word windows that occur at least twice.

    Windows are compared by a 64-bit hash of their words.  Sorted by hash and
    place, equal ones are neighbours; the places of those, in order, each cover
    three words less what the next one covers as well.
    """
    covered = (
        "if(size(p) = 0, 0, 3 + aggregate(zip_with(slice(p, 1, size(p) - 1),"
        " slice(p, 2, size(p) - 1), (a, b) -> least(3, b - a)), 0, (n, x) -> n + x))"
    )
    twice = (
        "sort_array(transform(filter(sequence(1, size(s)), i ->"
        " (i > 1 AND s[i - 1].k = s[greatest(i - 2, 0)].k)"
        " OR (i < size(s) AND s[i - 1].k = s[least(i, size(s) - 1)].k)), i -> s[i - 1].i))"
    )
    pairs = "sort_array(transform(k, (x, i) -> struct(x AS k, i AS i)))"
    windows = (
        "transform(sequence(0, size(h) - 3), i -> xxhash64(h[i], h[i + 1], h[i + 2]))"
    )
    counted = _let("s", pairs, _let("p", twice, covered))
    some = _let("k", windows, f"if(size(array_distinct(k)) = size(k), 0, {counted})")
    hashed = _let("h", f"transform({words}, w -> xxhash64(w))", some)
    return f"if(size({words}) < 4, 0, {hashed})"


def _without(characters: str) -> Column:
    return F.translate("text", characters, "")


def features(docs: DataFrame, *also: str) -> DataFrame:
    """Counts per document over its whole text, and the base verdict.

    ``n_repeat_words`` counts words in three-word windows found twice or more,
    ``n_dup_lines`` the lines with a word that equal an earlier line.
    """
    lines = rf"filter(split(text, '\n'), l -> l RLIKE r'{_WORD}')"
    counted = _let(
        "w",
        _words("text"),
        f"struct(size(w) AS n_words, {_repeated_words('w')} AS n_repeat_words,"
        r" size(filter(w, x -> NOT x RLIKE r'[\p{L}\p{N}]')) AS n_bare_words)",
    )
    by_line = _let(
        "l",
        lines,
        "struct(size(l) AS n_lines, size(l) - size(array_distinct(l)) AS n_dup_lines,"
        r" size(filter(l, x -> x RLIKE r'[.!?:;…\x22\x27”»)][\x20\x09-\x0D]*$')) AS n_ended_lines)",
    )
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *also)
    found = whole.select(
        "doc_id",
        *also,
        F.expr(counted).alias("_words"),
        F.length(_without(SPACES)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(SYMBOLS))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.expr(by_line).alias("_lines"),
    )
    longs = {
        "n_words": "_words", "n_repeat_words": "_words", "n_bare_words": "_words", "n_lines": "_lines",
        "n_dup_lines": "_lines", "n_ended_lines": "_lines",
    }
    return found.select(
        "doc_id", *also, "word_chars", "n_symbols", "n_letters",
        *[F.col(f"{of}.{name}").cast("long").alias(name) for name, of in longs.items()],
    ).withColumn(
        "base_failed",
        F.expr(
            f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PCT} * n_words"
        ),
    )


def votes() -> list[Column]:
    return [
        F.expr(f"CASE WHEN {fails} THEN -1 WHEN {passes} THEN 1 ELSE 0 END").alias(f"vote_{name}")
        for name, (passes, fails) in RULES.items()
    ]


def posterior(share: float, good: list[float], bad: list[float]) -> Column:
    """Probability of being good given the votes.

    ``good[i]`` is how often rule i passes a good document, ``bad[i]`` how often
    it fails a bad one, in either case where it votes at all.
    """
    def odds(name: str, g: float, b: float) -> Column:
        vote = F.col(f"vote_{name}")
        return (
            F.when(vote == 1, F.log(F.lit(g / (1 - b))))
            .when(vote == -1, F.log(F.lit((1 - g) / b)))
            .otherwise(0.0)
        )

    terms = [odds(name, g, b) for name, g, b in zip(RULES, good, bad)]
    total = reduce(lambda x, y: x + y, terms, F.log(F.lit(share / (1 - share))))
    return 1 / (1 + F.exp(-total))


def fit(voted: DataFrame, steps: int = STEPS) -> tuple[float, list[float], list[float]]:
    """Share of good documents and the rules' accuracies, by expectation-maximisation.

    ``voted`` has the vote columns and should be stored.  An empty table leaves
    the prior.
    """
    names = [f"vote_{name}" for name in RULES]
    counts = stash(voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "votes")
    share = PRIOR_SHARE
    good, bad = [GOOD_PASSES] * len(RULES), [BAD_FAILS] * len(RULES)

    def rate(
        hits: float | None, votes: float | None, prior: float, bounds: tuple[float, float]
    ) -> float:
        value = ((hits or 0.0) + prior * PRIOR_VOTES) / ((votes or 0.0) + PRIOR_VOTES)
        return min(max(value, bounds[0]), bounds[1])

    for _ in range(steps):
        p, n = F.col("p"), F.col("n")
        sums = [F.sum(n).alias("rows"), F.sum(n * p).alias("good")]
        for name in names:
            vote = F.col(name)
            sums += [
                F.sum(F.when(vote == 1, n * p)).alias(f"{name}_gp"),
                F.sum(F.when(vote != 0, n * p)).alias(f"{name}_g"),
                F.sum(F.when(vote == -1, n * (1 - p))).alias(f"{name}_bf"),
                F.sum(F.when(vote != 0, n * (1 - p))).alias(f"{name}_b"),
            ]
        row = counts.withColumn("p", posterior(share, good, bad)).agg(*sums).first()
        before = (share, *good, *bad)
        share = rate(row["good"], row["rows"], PRIOR_SHARE, (0.05, 0.95))
        good = [
            rate(row[f"{name}_gp"], row[f"{name}_g"], GOOD_PASSES, GOOD_RANGE) for name in names
        ]
        bad = [rate(row[f"{name}_bf"], row[f"{name}_b"], BAD_FAILS, BAD_RANGE) for name in names]
        if max(abs(a - b) for a, b in zip(before, (share, *good, *bad))) < 1e-6:
            break
    return share, good, bad


def verdicts(found: DataFrame) -> DataFrame:
    """Adds the votes, ``quality`` (posterior probability) and ``kept``."""
    voted = stash(found.select("*", *votes()), "quality")
    return voted.withColumn("quality", posterior(*fit(voted))).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts, votes, posterior and verdict of every document."""
    return verdicts(features(docs))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The counts travel with the rows, so nothing is joined back.
    """
    row = docs.select("doc_id", "text", F.struct(*[f"`{c}`" for c in docs.columns]).alias("_doc"))
    return verdicts(features(row, "_doc")).where("kept").select("_doc.*")
