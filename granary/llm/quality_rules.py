"""Quality rules under weak supervision, in built-in expressions only.

Each rule votes +1 (good), -1 (bad) or 0 (abstains). Documents fall into at most 3**rules vote patterns; their counts, a
table whose size does not grow with the documents, are all that expectation-maximisation needs to estimate the share of
good documents and of each kind of junk, and how every rule votes on each of them. The posterior of a document's pattern
is its quality.

Defined cases: a null or empty text has no words, so it fails the base rules; a text without words has no votes but the
one on length; rows are judged one by one, so ties and repeated rows do not matter; an empty table gives no rows; extra
columns pass through ``keep_good`` as they are, and ``add_features`` replaces those that it names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.skew import join_unique
from granary.session import materialize

SPACE = " \t\n\u000b\f\r"
SPACES = "[\\x20\\x09-\\x0D]+"
WINDOW = 8
#: Words of a block in which distinct words are counted; the share in whole texts falls with their length.
BLOCK = 50
#: The rules in the order of their votes.
RULES = ("length", "repeats", "symbols", "lines", "word_length", "capitals", "vocabulary")
#: The rules that a kind of junk is expected to break: texts that repeat themselves, and texts of odd characters.
JUNK = (("repeats", "lines", "vocabulary"), ("symbols", "word_length", "capitals"))
#: Rules whose values between the limits are evidence: signs in a text shift all of these counts at once. Those of length,
#: repeats and lines tell nothing, since good texts are short or have refrains and lists.
TELLING = ("symbols", "word_length", "capitals", "vocabulary")
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_block_words", "n_block_distinct", "n_upper", "n_lines")


def add_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns of ``docs`` and the counts that the rules read.

    Every array that a later step reads per element is a column of its own that is read more than once, so that the
    optimizer does not move its computation into the loop over the elements.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.translate(t, SPACE, "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACE, "") != "")
    words = F.filter(F.split(t, SPACES), lambda x: x != "")
    df = docs.withColumns(
        {
            "_words": F.transform(words, lambda w: F.xxhash64(w)),
            "_lines": lines,
            "word_chars": F.char_length(bare).cast("long"),
            "n_symbols": (F.char_length(t) - F.char_length(F.translate(t, "#*$%&|<>", ""))).cast("long"),
            "n_upper": (F.char_length(t) - F.char_length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long"),
        }
    )
    n = F.size("_words")
    distinct = F.aggregate(
        F.sequence(F.lit(0), n - n % BLOCK - BLOCK, F.lit(BLOCK)), F.lit(0), lambda acc, i: acc + F.size(F.array_distinct(F.slice("_words", i + 1, BLOCK)))
    )
    df = df.withColumns(
        {
            "n_words": n.cast("long"),
            "n_block_words": F.when(n >= BLOCK, n - n % BLOCK).otherwise(n).cast("long"),
            "n_block_distinct": F.when(n >= BLOCK, distinct).otherwise(F.size(F.array_distinct("_words"))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))),
        }
    )
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn("_sorted", F.when(twice, pairs))
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    near = lambda x, i: same(x, F.get("_sorted", i - 1)) | same(x, F.get("_sorted", i + 1))
    starts = F.sort_array(F.transform(F.filter("_sorted", near), lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        starts,
        start,
        lambda acc, i: F.struct((acc["n"] + i + WINDOW - F.greatest(i, acc["end"])).alias("n"), (i + WINDOW).alias("end")),
        lambda acc: acc["n"],
    )
    df = df.withColumn("n_repeat_words", F.coalesce(F.when(F.size("_sorted") > 0, covered), F.lit(0)).cast("long"))
    return df.drop("_words", "_lines", "_windows", "_sorted")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """A vote per rule; limits are compared as products of whole numbers."""
    n, chars = F.col("n_words"), F.col("word_chars")
    distinct, within = F.col("n_block_distinct"), F.col("n_block_words")
    some = n > 0

    def vote(bad: Column, good: Column) -> Column:
        return F.coalesce(F.when(bad, F.lit(-1)).when(good, F.lit(1)), F.lit(0))

    return {
        "length": vote(n < 20, n >= 50),
        "repeats": vote(some & (100 * F.col("n_repeat_words") > 30 * n), some & (100 * F.col("n_repeat_words") <= 10 * n)),
        "symbols": vote(some & (10 * F.col("n_symbols") > n), some & (100 * F.col("n_symbols") <= n)),
        "lines": vote(100 * F.col("n_dup_lines") > 60 * F.col("n_lines"), (F.col("n_lines") > 0) & (100 * F.col("n_dup_lines") <= 10 * F.col("n_lines"))),
        "word_length": vote(some & ((chars < 3 * n) | (chars > 10 * n)), some & (2 * chars >= 7 * n) & (2 * chars <= 15 * n)),
        "capitals": vote(some & (10 * F.col("n_upper") > 3 * chars), some & (10 * F.col("n_upper") <= chars)),
        "vocabulary": vote((n >= BLOCK) & (2 * distinct < within), some & (5 * distinct > 3 * within)),
    }


def add_votes(featured: DataFrame) -> DataFrame:
    """``votes``: the votes in order, one character each, such as ``+-0+++0``."""
    vote = rules()
    signs = [F.when(vote[r] > 0, "+").when(vote[r] < 0, "-").otherwise("0") for r in RULES]
    return featured.withColumns({"base_failed": base_failed(), "votes": F.concat(*signs)})


def chances(pattern: str, shares: list[float], rates: list[list[dict[str, float]]]) -> list[float]:
    """The posterior of each class, given the classes' shares and, by class and rule, how often each vote is cast."""
    out = [share * math.prod(r[sign] for r, sign in zip(rate, pattern, strict=True)) for share, rate in zip(shares, rates, strict=True)]
    return [x / sum(out) for x in out]


def estimate(
    counts: dict[str, int], share: float = 0.85, rare: float = 0.001, often: float = 0.5, seldom: float = 0.05, abstain: float = 0.02, rounds: int = 100
) -> dict[str, float]:
    """The posterior of each vote pattern, from the number of documents that have it.

    Good documents are one class and each kind of junk another. The start says that good documents break a rule ``rare``ly,
    and junk ``often`` the rules of its kind and ``seldom`` others; it stays in as ten documents' worth of prior. All shares
    and rates are free from there on: a rule that good documents break is learned as such. Classes do not change
    places, as each starts with rules of its own. Abstaining is a vote like others in the rules ``TELLING`` only.
    """
    start = [[rare] * len(RULES), *([often if x in kind else seldom for x in RULES] for kind in JUNK)]
    zero = [abstain if x in TELLING else 0.0 for x in RULES]
    start = [[{"+": (1 - z) * (1 - x), "-": (1 - z) * x, **({"0": z} if z else {})} for z, x in zip(zero, row, strict=True)] for row in start]
    first = [share, *([(1 - share) / len(JUNK)] * len(JUNK))]
    shares, n = first, sum(counts.values())
    rates = [[{"0": 1.0, **row} for row in rows] for rows in start]
    for _ in range(rounds):
        weight = {p: chances(p, shares, rates) for p in counts}
        shares = [(sum(c * weight[p][k] for p, c in counts.items()) + 10 * f) / (n + 10) for k, f in enumerate(first)]
        rates = []
        for k, rows in enumerate(start):
            cast = [{sign: 10 * x for sign, x in row.items()} for row in rows]
            for p, c in counts.items():
                for row, sign in zip(cast, p, strict=True):
                    if sign in row:
                        row[sign] += c * weight[p][k]
            rates.append([{"0": 1.0, **{sign: x / sum(row.values()) for sign, x in row.items()}} for row in cast])
    return {p: chances(p, shares, rates)[0] for p in counts}


def fit(voted: DataFrame) -> dict[str, float]:
    """The posterior of each vote pattern of the documents."""
    return estimate({r["votes"]: r["count"] for r in voted.groupBy("votes").count().orderBy("votes").collect()})  # at most 3**7 rows


def add_quality(voted: DataFrame, model: dict[str, float], least: float = 0.5) -> DataFrame:
    """``quality``, the posterior probability that the row is good, and ``kept``."""
    if model:
        table = F.create_map(*[F.lit(x) for p in sorted(model) for x in (p, model[p])])
        quality = F.coalesce(F.try_element_at(table, F.col("votes")), F.lit(0.0))
    else:
        quality = F.lit(0.0)
    df = voted.withColumn("quality", quality)
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))


def keep_good(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged, whatever their columns are called.

    Texts are counted once: votes are written under 96 bits of hash of the text, for they depend on the text alone, and
    both the model and the verdicts read them. Rows find their verdict by a join in which a text of many copies is split.
    """
    name = [F.xxhash64(text).alias("_text"), F.hash(text).alias("_more")]
    voted = add_votes(add_features(docs.select(*name, F.col(text).alias("text"))))
    held = materialize(voted.select("_text", "_more", "base_failed", "votes"), "votes")
    verdicts = add_quality(held, fit(held), least).groupBy("_text", "_more").agg(F.first("kept").alias("kept")).where("kept")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *name)
    return join_unique(rows, verdicts, ["_text", "_more"]).select("_row.*")
