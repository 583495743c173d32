"""Quality rules that vote, weighed by accuracies that expectation-maximisation estimates."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.staging import Staging

WINDOW = 8
_SPACE = r"[\x20\x09-\x0D]"
_SYMBOLS = "#*$%&|<>"


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _covered(hashes: Column) -> Column:
    """Words in windows that occur twice or more, from the windows' hashes in order."""

    def of_sorted(pairs: Column) -> Column:
        again = F.filter(
            pairs,
            lambda x, i: (F.get(pairs, i - 1)["h"] == x["h"]) | (F.get(pairs, i + 1)["h"] == x["h"]),
        )
        return _with(F.sort_array(F.transform(again, lambda x: x["i"])), of_places)

    def of_places(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
        _with(pairs, of_sorted)
    )


def text_counts(text: Column) -> dict[str, Column]:
    """Counts of a whole text that the rules are made of; its ``words`` and ``lines`` must be columns already."""
    marked = r"^[^\p{L}\p{N}]+$|([^\p{L}\p{N}])\1$"
    worded = F.filter("lines", lambda line: line.rlike(f"[^{_SPACE[1:-1]}]"))

    def windows(hashed: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashed) - (WINDOW - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(hashed, i, WINDOW)))

    hashed = F.transform("words", lambda w: F.xxhash64(w))
    repeats = _with(hashed, lambda h: _with(windows(h), _covered))
    return {
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.regexp_replace(text, f"{_SPACE}+", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("long"),
        "n_dup_lines": _with(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": F.when(F.size("words") >= WINDOW, repeats).otherwise(F.lit(0)).cast("long"),
        "n_lines": F.size(worded).cast("long"),
        "n_letters": F.length(F.regexp_replace(text, r"\P{L}+", "")).cast("long"),
        "n_capitals": F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long"),
        "n_marked": F.size(F.filter("words", lambda w: w.rlike(marked))).cast("long"),
        "n_stutter": _with(F.col("words"), lambda ws: F.size(F.filter(ws, lambda w, i: F.get(ws, i - 1) == w))).cast("long"),
        "n_distinct": F.size(F.array_distinct(hashed)).cast("long"),
    }


def _over(part: str, percent: int, whole: str) -> Column:
    return F.col(part) * 100 > F.col(whole) * percent


def votes() -> dict[str, Column]:
    """Each rule's vote: 1 for good, -1 for bad, 0 where it abstains.

    A rule against one kind of junk says nothing of texts without it, so most rules only ever
    vote bad; what speaks for a text is that it looks like running prose in every respect.
    """
    bad = lambda c: F.when(c, -1).otherwise(0)
    prose = (
        ~_over("n_symbols", 2, "n_words")
        & ~_over("n_repeat_words", 5, "n_words")
        & ~_over("n_stutter", 5, "n_words")
        & ~_over("n_capitals", 20, "n_letters")
        & ~_over("n_marked", 10, "n_words")
        & _over("n_letters", 80, "word_chars")
    )
    return {
        "symbols": bad(_over("n_symbols", 10, "n_words")),
        "repeats": bad(_over("n_repeat_words", 20, "n_words") & (F.col("n_repeat_words") >= 60)),
        "stutter": bad(_over("n_stutter", 25, "n_words")),
        "dup_lines": bad(_over("n_dup_lines", 30, "n_lines") & (F.col("n_lines") >= 4)),
        "capitals": bad(_over("n_capitals", 50, "n_letters")),
        "marks": bad(_over("n_marked", 25, "n_words")),
        "letters": bad(_over("word_chars", 166, "n_letters")),
        "word_length": F.when(~F.col("word_chars").between(2 * F.col("n_words"), 15 * F.col("n_words")), -1)
        .when(F.col("word_chars").between(3 * F.col("n_words"), 10 * F.col("n_words")) & prose, 1)
        .otherwise(0),
        "vocabulary": F.when(_over("n_words", 1000, "n_distinct"), -1)
        .when(_over("n_distinct", 25, "n_words") & prose, 1)
        .otherwise(0),
        "prose": F.when(prose & (F.col("n_words") > 0), 1).otherwise(0),
    }


@dataclass
class VoteModel:
    """How often each rule is right when it votes, and the share of good texts before any vote."""

    accuracy: dict[str, float]
    balance: float

    def weight(self, rule: str) -> float:
        return math.log(self.accuracy[rule] / (1 - self.accuracy[rule]))

    def posterior(self) -> Column:
        """The probability that a text is good, from its vote columns."""
        logit = F.lit(math.log(self.balance / (1 - self.balance)))
        for rule in self.accuracy:
            logit = logit + F.col(f"vote_{rule}") * self.weight(rule)
        return 1 / (1 + F.exp(-logit))


def fit_votes(
    patterns: list[tuple[tuple[int, ...], int]],
    rules: list[str],
    balance: float = 0.5,
    bounds: tuple[float, float] = (0.7, 0.99),
    prior: tuple[float, float] = (8.0, 2.0),
    rounds: int = 100,
) -> VoteModel:
    """Expectation-maximisation over the distinct vote patterns and how many texts have each.

    Rules are taken to err independently given the class. Each starts from, and is drawn towards,
    the accuracy of ``prior`` (right and wrong votes seen before), and stays inside ``bounds``:
    a rule is better than chance and never certain. ``balance`` is the class share without votes.
    """
    start = prior[0] / sum(prior)
    model = VoteModel(dict.fromkeys(rules, start), balance)
    for _ in range(rounds):
        right, total = [prior[0]] * len(rules), [sum(prior)] * len(rules)
        for pattern, n in patterns:
            logit = math.log(balance / (1 - balance)) + sum(v * model.weight(r) for v, r in zip(pattern, rules, strict=True))
            good = 1 / (1 + math.exp(-max(-700.0, min(700.0, logit))))
            for k, vote in enumerate(pattern):
                if vote:
                    total[k] += n
                    right[k] += n * (good if vote > 0 else 1 - good)
        accuracy = {
            rule: min(bounds[1], max(bounds[0], right[k] / total[k])) for k, rule in enumerate(rules)
        }
        moved = max(abs(accuracy[r] - model.accuracy[r]) for r in rules)
        model = VoteModel(accuracy, balance)
        if moved < 1e-9:
            break
    return model


def judge_quality(
    docs: DataFrame,
    staging: Staging,
    *,
    id: str = "doc_id",
    text: str = "text",
    threshold: float = 0.5,
    carry: bool = False,
) -> DataFrame:
    """Counts, votes, posterior probability of being good, and the verdict for every row.

    One pass over the whole texts gives the counts and votes, which are written once. The number
    of texts with each vote pattern (at most three to the number of rules) goes to the driver,
    where the rules' accuracies are estimated; the posterior is then a column expression.
    ``base_failed`` is fewer than 20 words, or over 30 percent of the words in windows of eight
    words found twice or more; ``kept`` is false for these and else says whether the posterior
    reaches ``threshold``. Null and empty texts have no words and fail; a null id stays null.

    With ``carry`` the struct ``doc`` holds all columns of ``docs``, whatever they are called.
    """
    rules = votes()
    value = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select(
        F.col(f"`{id}`").cast("long").alias("doc_id"),
        F.col(f"`{text}`").cast("string").alias("text"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if carry else []),
    )
    kept = ["doc_id", *(["doc"] if carry else [])]
    split = plain.select(
        *kept,
        value.alias("text"),
        F.filter(F.split(value, f"{_SPACE}+"), lambda w: w != "").alias("words"),
        F.split(value, "\n").alias("lines"),
    )
    counts = split.select(*kept, *[c.alias(name) for name, c in text_counts(F.col("text")).items()])
    counted = counts.withColumns({f"vote_{name}": vote for name, vote in rules.items()})
    counted = staging.write(counted, "votes")
    columns = [f"vote_{name}" for name in rules]
    seen = counted.groupBy(*columns).agg(F.count("*").alias("n")).collect()
    model = fit_votes([(tuple(r[c] for c in columns), r["n"]) for r in seen], list(rules))
    failed = (F.col("n_words") < 20) | _over("n_repeat_words", 30, "n_words")
    return counted.withColumns({"base_failed": failed, "posterior": model.posterior()}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)
    )
