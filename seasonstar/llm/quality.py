"""Quality statistics of texts and decision lists learned from labels."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonstar.llm.common import store, words

SYMBOLS = "[#*$%&|<>]"
#: Limits of the base rule.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Labelled rows that a decision list is fitted on at most (in expectation; chosen by a hash of the id).
MAX_LABELLED = 100_000
#: Thresholds tried per feature are this many quantiles of either class.
QUANTILES = 31
MAX_RULES, MAX_CONDITIONS = 8, 4
#: A rule must be this often right on rows it was not grown on, and cover so many bad ones there.
MIN_PRECISION, MIN_COVERED = 0.95, 5
#: Every third labelled row prunes rules, the others grow them.
FOLDS = 3

#: What decision lists look at: each a share or a mean, so that it means the same for short and long texts.
FEATURES = {
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "shout_share": "n_shouts / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "words": "cast(n_words as double)",
}
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct_words", "n_capitals", "n_shouts", "n_digits",
)


def _repeat_words(rows: DataFrame) -> DataFrame:
    """Adds n_repeat_words from `w`: words that lie in a window of three words found twice or more.

    Windows are sorted by a hash with their place in its lowest bits, as plain longs; neighbours with equal hashes are compared
    word by word, so equal hashes of different windows do not count.
    """
    n = F.size("w")
    hashes = F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.call_function("shiftleft", F.xxhash64(*(F.get("w", i + j) for j in range(3))), F.col("bits")).bitwiseOR(i.cast("long")),
    )
    rows = rows.withColumn("bits", F.length(F.bin(n.cast("long"))).cast("int"))
    rows = rows.withColumn("s", F.sort_array(hashes))

    def cut(x: Column) -> Column:
        return F.call_function("shiftright", x, F.col("bits"))

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1).cast("int")

    many = F.size("s") >= 2
    twins = F.filter(
        F.when(many, F.sequence(F.lit(0), F.size("s") - 2)).otherwise(F.array().cast("array<int>")),
        lambda k: cut(F.get("s", k)) == cut(F.get("s", k + 1)),
    )
    rows = rows.withColumn("twins", F.transform(twins, lambda k: F.array(place(F.get("s", k)), place(F.get("s", k + 1)))))

    def same(p: Column) -> Column:
        return reduce(Column.__and__, (F.get("w", p[0] + j) == F.get("w", p[1] + j) for j in range(3)))

    rows = rows.withColumn("at", F.sort_array(F.array_distinct(F.flatten(F.filter("twins", same)))))
    covered = F.aggregate(
        F.when(F.size("at") >= 2, F.sequence(F.lit(1), F.size("at") - 1)).otherwise(F.array().cast("array<int>")),
        F.lit(3),
        lambda sum_, i: sum_ + F.least(F.lit(3), F.get("at", i) - F.get("at", i - 1)),
    )
    repeated = F.when(F.size("at") > 0, covered).otherwise(0).cast("long")
    return rows.withColumn("n_repeat_words", repeated).drop("bits", "s", "twins", "at")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, and `COUNTS` of each row, from its whole text; nothing is shuffled."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"),
        lines.alias("lines"), count(SYMBOLS).alias("n_symbols"), count("[A-Z]").alias("n_capitals"),
        count("[!?]").alias("n_shouts"), count("[0-9]").alias("n_digits"),
    )
    rows = rows.withColumns(
        {
            "n_words": F.size("w").cast("long"),
            "word_chars": F.length(F.array_join("w", "")).cast("long"),
            "n_distinct_words": F.size(F.array_distinct("w")).cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        }
    ).drop("lines")
    return _repeat_words(rows).select("doc_id", "text_hash", *COUNTS)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _features() -> list[Column]:
    return [F.expr(e).alias(f) for f, e in FEATURES.items()]


@dataclass(frozen=True)
class Condition:
    """`feature >= cut`, or `feature < cut`."""

    feature: str
    least: bool
    cut: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= self.cut if self.least else value < self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.least else '<'} {self.cut:.4g}"


@dataclass
class DecisionList:
    """Rules in order; the first that holds rejects the text, a text that none holds for is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def kept(self) -> Column:
        """The list as one conditional expression over the features."""
        out = F.lit(True)
        for rule in reversed(self.rules):
            out = F.when(_all(rule), F.lit(False)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, rule))}" for rule in self.rules) + "\nkeep otherwise"


def _all(rule: list[Condition]) -> Column:
    return reduce(Column.__and__, (c.column() for c in rule), F.lit(True))


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Thresholds to try: quantiles of the good and of the bad rows."""
    shares = [(i + 1) / (QUANTILES + 1) for i in range(QUANTILES)]
    found = rows.agg(
        *(F.percentile_approx(F.when(F.col("bad") == bad, F.col(f)), shares, 10_000).alias(f"{f}_{bad}") for f in FEATURES for bad in (True, False))
    ).first()
    return {f: sorted({*(found[f"{f}_True"] or []), *(found[f"{f}_False"] or [])}) for f in FEATURES}


def _best(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[float, Condition | None]:
    """The condition with the highest FOIL gain, from counts per feature and threshold interval."""

    def place(feature: str) -> Column:
        """In which interval between thresholds a value lies."""
        reached = F.filter(F.array(*map(F.lit, cuts[feature])), lambda cut: cut <= F.col(feature))
        return F.struct(F.lit(feature).alias("feature"), F.size(reached).alias("place"))

    places = [place(f) for f in FEATURES if cuts[f]]
    if not places:
        return 0.0, None
    counted = rows.select("bad", F.explode(F.array(*places)).alias("x")).groupBy("x.feature", "x.place")
    counts: dict[str, dict[int, tuple[int, int]]] = {}
    for r in counted.agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect():
        counts.setdefault(r["feature"], {})[r["place"]] = r["p"], r["n"]
    best: tuple[float, Condition | None] = (0.0, None)
    for f in sorted(counts):
        p_all, n_all = (sum(x[k] for x in counts[f].values()) for k in (0, 1))
        if not p_all:
            continue
        before, p_below, n_below = log2(p_all / (p_all + n_all)), 0, 0
        for i, cut in enumerate(cuts[f]):
            p, n = counts[f].get(i, (0, 0))
            p_below, n_below = p_below + p, n_below + n
            for least, p, n in ((True, p_all - p_below, n_all - n_below), (False, p_below, n_below)):
                if p and (gain := p * (log2(p / (p + n)) - before)) > best[0] + 1e-9:
                    best = gain, Condition(f, least, float(cut))
    return best


def fit(labelled: DataFrame) -> DecisionList:
    """A decision list for rows with `doc_id`, `COUNTS` and boolean `bad`, by sequential covering.

    Rules are grown by the condition that gains most on the growing rows not yet covered, cut back to the prefix that does
    best on the pruning rows, and kept while they are right there. Each step counts bad and good rows per feature
    and threshold interval in Spark; only these counts reach the driver.
    """
    n = labelled.count()
    share = min(1.0, MAX_LABELLED / max(n, 1))
    rows = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    prunes = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)) == 0
    rows = store(rows.select("bad", prunes.alias("prunes"), *_features()), "labelled")
    cuts, found = _cuts(rows), DecisionList()
    while len(found.rules) < MAX_RULES:
        left = rows.filter(found.kept())
        rule: list[Condition] = []
        while len(rule) < MAX_CONDITIONS:
            _, condition = _best(left.filter(~F.col("prunes") & _all(rule)), cuts)
            if condition is None or condition in rule:
                break
            rule.append(condition)
        if not rule:
            break
        held = left.filter("prunes").agg(
            *(F.count_if(F.col("bad") & _all(rule[: i + 1])).alias(f"p{i}") for i in range(len(rule))),
            *(F.count_if(~F.col("bad") & _all(rule[: i + 1])).alias(f"n{i}") for i in range(len(rule))),
        ).first()
        scores = [((held[f"p{i}"] - held[f"n{i}"]) / max(1, held[f"p{i}"] + held[f"n{i}"]), -i) for i in range(len(rule))]
        length = -max(scores)[1]
        p, bad = held[f"p{length}"], held[f"n{length}"]
        if p < MIN_COVERED or p < MIN_PRECISION * (p + bad):
            break
        found.rules.append(rule[: length + 1])
    return found


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and verdict of each row: doc_id, text_hash, `COUNTS`, base_failed, kept.

    The base rule rejects texts under `MIN_WORDS` words and texts with over half their words in repeated windows of three.
    The others go through a decision list learned from `labels` (doc_id, quality: 0 is bad) on rows that pass the base rule.
    Labels without an id or quality are left out, of several for one id the worse counts; without usable labels the list
    is empty and keeps all. Null, empty and blank texts have no words and fail the base rule. Repeated rows get equal
    verdicts, other columns are ignored, no rows give no rows.
    """
    stats = store(statistics(docs), "quality").withColumn("base_failed", base_failed())
    known = labels.filter("quality is not null").groupBy(F.col("doc_id").alias("_id")).agg((F.min("quality") == 0).alias("bad"))
    rules = fit(stats.filter(~F.col("base_failed")).join(known, F.col("doc_id") == F.col("_id")).drop("_id"))
    judged = stats.select("*", *_features()).withColumn("kept", ~F.col("base_failed") & rules.kept())
    return judged.select("doc_id", "text_hash", *COUNTS, "base_failed", "kept")
