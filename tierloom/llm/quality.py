"""Quality by weak supervision, with DataFrame functions only: rules vote or abstain, expectation-maximisation estimates
how good the rules are, and the posterior probability of good quality replaces a filter that every rule must pass.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import as_text, free_name, release, stored

WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
KEEP_FROM = 0.5
# Expectation-maximisation ends when no estimate moves by more than TOLERANCE, or after ROUNDS rounds.
ROUNDS = 60
TOLERANCE = 1e-4
# What is believed before any document is seen, with the weight of IMAGINED votes of each class for every rule: how many
# good documents a rule votes for, how many bad ones it votes against, and the share of good documents.
FOR_GOOD, AGAINST_BAD, PRIOR = 0.93, 0.3, 0.8
IMAGINED = 20.0
SURE = 1e-4
# Characters that mark up text or stand for something else in it.
MARKS = r"[#*$%&|<>@~^_\\{}\[\]=+]"


def _repeated(hashes: str, again: str) -> Column:
    """Number of words inside windows whose hash comes twice, from the hashes by position.

    Sorting (hash, position) brings equal hashes together; the positions of those are put in order, and each window
    covers as many words as there are up to the next one, WINDOW at most.
    """
    pairs = F.array_sort(F.transform(F.col(hashes), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def shared(sorted_pairs: Column) -> Column:
        def same(pair: Column, k: Column) -> Column:
            other = F.coalesce(F.get(sorted_pairs, k + 1)["h"] == pair["h"], F.lit(False))
            return other | F.coalesce(F.get(sorted_pairs, k - 1)["h"] == pair["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(sorted_pairs, same), lambda pair: pair["i"]))

    def covered(positions: Column) -> Column:
        gaps = F.transform(positions, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(positions, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    # One-element arrays bind a value to a name, so that it is not computed again at each use.
    bound = F.transform(F.array(pairs), lambda p: covered_of(shared(p), covered))
    return F.when(F.size(F.col(again)) > 0, F.get(bound, F.lit(0))).otherwise(F.lit(0).cast("long"))


def covered_of(positions: Column, covered) -> Column:
    return F.get(F.transform(F.array(positions), covered), F.lit(0))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add what the rules look at; every text is handled whole, inside its row, in time n log n. No shuffle.

    Null texts count as empty. Windows are compared by 64-bit hashes. Store the result before it is filtered or counted
    by one of these columns: Spark moves such a step below the expressions and would compute them again for it.
    """
    value = as_text(text)
    names = [free_name(docs, n) for n in ("words_", "lines_", "hashes_", "sorted_", "again_", "value_")]
    words, lines, hashes, ordered, again, whole = names
    first = docs.withColumn(whole, value)
    parts = first.withColumns(
        {
            words: F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)),
            lines: F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    counted = parts.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": (F.length(whole) - F.length(F.regexp_replace(whole, r"[#*$%&|<>]+", ""))).cast("long"),
            "n_marked": F.size(F.filter(words, lambda word: word.rlike(MARKS))).cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_upper": (F.length(whole) - F.length(F.regexp_replace(whole, r"\p{Lu}+", ""))).cast("long"),
            "n_digits": (F.length(whole) - F.length(F.regexp_replace(whole, r"[0-9]+", ""))).cast("long"),
            "n_stops": (F.length(whole) - F.length(F.regexp_replace(whole, r"[.!?]+", ""))).cast("long"),
            hashes: F.transform(
                F.slice(F.col(words), F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))),
                lambda word, i: F.xxhash64(word, F.get(F.col(words), i + 1), F.get(F.col(words), i + 2)),
            ),
        }
    )
    sorted_hashes = counted.withColumn(ordered, F.sort_array(hashes))
    repeated = sorted_hashes.withColumn(
        again, F.filter(F.col(ordered), lambda h, i: F.coalesce(F.get(F.col(ordered), i + 1) == h, F.lit(False)))
    )
    return repeated.withColumn("n_repeat_words", _repeated(hashes, again)).drop(*names)


def _vote(good: Column, bad: Column) -> Column:
    """1 for good, -1 for bad, 0 for an abstention; a condition without an answer does not hold."""
    return F.when(F.coalesce(bad, F.lit(False)), -1).when(F.coalesce(good, F.lit(False)), 1).otherwise(0)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.when(F.col(whole) > 0, F.col(whole))


def votes() -> dict[str, Column]:
    """The rules, over the columns of ``measure``. Each speaks for a text, against it, or abstains in between.

    Two classes can only be told apart by rules that see the same thing in different ways: symbols are counted by
    characters and by words, repetition by lines and by word windows.
    """
    length, lines = F.col("n_words"), F.col("n_lines")
    mean = _share("word_chars", "n_words")
    symbols, capitals, digits = (_share(c, "word_chars") for c in ("n_symbols", "n_upper", "n_digits"))
    copied, repeated, stops = _share("n_dup_lines", "n_lines"), _share("n_repeat_words", "n_words"), _share("n_stops", "n_words")
    marked = _share("n_marked", "n_words")
    return {
        "length": _vote(length >= 100, length < 30),
        "word_length": _vote(mean.between(3, 8), (mean < 2.5) | (mean > 14)),
        "symbols": _vote(symbols < 0.005, symbols > 0.04),
        "marks": _vote(marked < 0.02, marked > 0.1),
        "lines": _vote((copied < 0.05) & (lines >= 4), (copied > 0.3) & (lines >= 4)),
        "repeats": _vote(repeated < 0.05, repeated > 0.3),
        "capitals": _vote(capitals.between(0.002, 0.1), capitals > 0.4),
        "digits": _vote(digits < 0.05, digits > 0.2),
        "prose": _vote(stops.between(0.02, 0.25), (stops > 0.5) | ((stops == 0) & (length >= LEAST_WORDS))),
    }


Tables = list[tuple[float, float]]


def posterior(vote_array: str | Column, prior: float, rules: Tables) -> Column:
    """Probability of good quality given the votes of all rules, in their order; abstentions say nothing.

    ``rules`` has, per rule, the share of its votes on good documents that speak for them, and of those on bad documents
    that speak against them. Estimates are one array literal, so that a new round runs the code compiled for the first.
    """
    count = len(rules)
    ups = [math.log(good / (1 - bad)) for good, bad in rules]
    downs = [math.log((1 - good) / bad) for good, bad in rules]
    known = F.lit([math.log(prior / (1 - prior)), *ups, *downs])

    def add(vote: Column, i: Column) -> Column:
        return F.when(vote == 1, F.get(known, i + 1)).when(vote == -1, F.get(known, i + 1 + count)).otherwise(0.0)

    total = F.aggregate(F.transform(vote_array, add), F.get(known, F.lit(0)), lambda t, x: t + x)
    return 1 / (1 + F.exp(-total))


def estimate_rules(patterns: DataFrame, count: int, rounds: int = ROUNDS) -> tuple[float, Tables]:
    """The share of good documents and, per rule, its right votes on good and on bad ones.

    ``patterns`` has the distinct patterns (``votes``, an array) with their number of documents ``n``: 3 to the number
    of rules at most, however many documents there are. A round is one aggregate of them: the posterior of each pattern,
    then each rule's votes by class. What is believed beforehand has a fixed weight, so documents outweigh it. No rule may
    be worse than chance, that is, speak for bad documents more often than for good ones.
    """
    prior, rules = PRIOR, [(FOR_GOOD, AGAINST_BAD)] * count
    one = patterns.coalesce(1)
    for _ in range(rounds):
        weighed = one.withColumn("good", posterior("votes", prior, rules))
        voted = weighed.select("n", "good", F.posexplode("votes").alias("rule", "vote"))
        sums = voted.groupBy("rule", "vote").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good")
        )
        got = {(row["rule"], row["vote"]): (row["n"], row["good"]) for row in sums.collect()}
        if not got:
            return prior, rules
        moved = []
        for rule in range(count):
            (ups, up_good), (downs, down_good) = got.get((rule, 1), (0, 0.0)), got.get((rule, -1), (0, 0.0))
            down_bad = downs - down_good
            good = (IMAGINED * FOR_GOOD + up_good) / (IMAGINED + up_good + down_good)
            bad = (IMAGINED * AGAINST_BAD + down_bad) / (IMAGINED + ups - up_good + down_bad)
            good, bad = (min(max(share, SURE), 1 - SURE) for share in (good, bad))
            moved.append((good, max(bad, 1 - good)))
        every, good = (sum(got.get((0, vote), (0, 0.0))[i] for vote in (-1, 0, 1)) for i in (0, 1))
        share = (IMAGINED * PRIOR + good) / (IMAGINED + every)
        change = max(abs(x - y) for x, y in zip([share, *sum(moved, ())], [prior, *sum(rules, ())], strict=True))
        prior, rules = share, moved
        if change < TOLERANCE:
            break
    return prior, rules


def judge(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", keep_from: float = KEEP_FROM, rounds: int = ROUNDS
) -> DataFrame:
    """doc_id, the measures, the votes, base_failed, quality (posterior probability) and kept, for every document.

    Texts are read once; measures and votes are stored, then the votes of documents that pass the base rules are counted
    by pattern. Null, empty and short texts fail the base rules and are not kept. Repeated rows are judged alike; an
    empty table gives no rows. Columns other than the id are not looked at.
    """
    rules = votes()
    measured = measure(docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))).drop("text")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    voted = stored(measured.withColumns({"votes": F.array(*rules.values()), "base_failed": failed}), "quality-votes")
    passed = voted.filter(~F.col("base_failed"))
    patterns = stored(passed.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "quality-patterns")
    prior, tables = estimate_rules(patterns, len(rules), rounds)
    release(patterns)
    judged = voted.withColumn("quality", posterior("votes", prior, tables))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep_from))


def quality_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, quality."""
    return judge(docs, **options).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )
