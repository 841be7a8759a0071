"""Quality rules: decision lists learned by sequential covering, run as Spark conditions.

A rule is a conjunction of thresholds on features of a text, such as "more than 0.2 symbols
a word and fewer than 6 letters a word", and marks low quality. Rules are learned from
labelled documents one after the other: a rule grows by the threshold with the largest gain
of information on two thirds of the documents that no earlier rule covers, then loses its
last conditions while that makes it more precise on the other third. Each condition chooses among
thresholds of the rows that are still open and that the rule covers so far, so a kind of low
quality is found however rare it is. A rule that is not precise enough, or whose rows chance
could make as low, gives way to one that starts from another feature or side; covering stops
when none is left. The list is emitted as an ordered CASE expression.

All features and statistics are DataFrame expressions and aggregates over all labelled
documents. The driver sees counts of features x thresholds only. Learning costs two
small jobs for each condition and one for each rule.

Null and empty texts have no words and fail the base check; a very long text is measured where it is, as
arrays of its words' hashes; of conditions that gain the same, those above a threshold come first, then
the later in the order of `FEATURES`; an empty table gives an empty result;
a rule has `most_conditions` conditions at most (a parameter), so low quality that only more of them tell from good is not found; labels that are null or whose
document is absent are ignored; of repeated labels of an id the lower quality counts;
without labels the list is empty and the base check alone decides. Repeated rows are judged
each for itself. `verdicts` keeps all columns in one struct, so names can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import pairwise
from math import log, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qadump.llm.common import SPACE, WORD, staged, used_up

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent
#: Labelled rows of a file of the learning sample.
FILE_ROWS = 200_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


#: What thresholds are set on, as expressions of the counts.
FEATURES = {
    "words": "cast(n_words as double)",
    "word_length": "word_chars / n_words",
    "symbols_a_word": "n_symbols / n_words",
    "bangs_a_word": "n_bangs / n_words",
    "capitals_a_letter": "n_capitals / word_chars",
    "dup_lines_a_line": "n_dup_lines / n_lines",
    "repeated_a_word": "n_repeat_words / n_words",
    "stutters_a_word": "n_stutters / n_words",
    "words_a_line": "n_words / n_lines",
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        test = value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)
        return F.coalesce(test, F.lit(False))

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def matches(rule: Rule) -> Column:
    return reduce(Column.__and__, [c.column() for c in rule], F.lit(True))


def first_match(rules: list[Rule]) -> Column:
    """The first rule of the list that holds, as text; null if none does. An ordered CASE."""
    case = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in rules:
        case = case.when(matches(rule), F.lit(" and ".join(map(str, rule))))
    return case


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row (a struct of all columns of docs), doc_id, the counts, base_failed and the features.

    Repeated windows are found by 64-bit hashes of their words' hashes. Only texts with a
    repeat pay for the second step: sort the windows by hash, mark those with a twin, and sum
    the words that each adds to the one before it.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    stutters = F.filter("_hashes", lambda h, i: h == F.get("_hashes", i - 1))  # words said twice on end
    lines = F.filter(F.split("_body", "\n"), lambda line: line.rlike(WORD))
    starts = F.sequence(F.lit(0), F.size("_hashes") - WINDOW)
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)]))

    def twin(entry: Column, i: Column) -> Column:
        same_before = entry["h"] == F.get("_sorted", i - 1)["h"]
        same_after = entry["h"] == F.get("_sorted", i + 1)["h"]
        return F.coalesce(same_before, F.lit(False)) | F.coalesce(same_after, F.lit(False))

    def added(start: Column, k: Column) -> Column:
        before = F.get("_twins", k - 1)
        return F.when(k == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), start - before))

    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    covered = F.aggregate(F.transform("_twins", added), F.lit(0), lambda a, b: a + b)
    counted = (
        docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("doc_id"), body.alias("_body"))
        .withColumn("_words", F.filter(F.split("_body", SPACE + "+"), lambda w: w != ""))
        .withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
        .withColumn("_windows", F.when(F.size("_hashes") >= WINDOW, windows))
        .withColumn("_sorted", F.when(repeats, F.array_sort(pairs)))
        .withColumn("_twins", F.sort_array(F.transform(F.filter("_sorted", twin), lambda e: e["i"])))
        .withColumn("_lines", lines)
        .select(
            "row",
            "doc_id",
            F.size("_words").cast("long").alias("n_words"),
            F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            F.regexp_count("_body", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
            F.size(stutters).cast("long").alias("n_stutters"),
            F.size("_lines").cast("long").alias("n_lines"),
            F.regexp_count("_body", F.lit("!")).cast("long").alias("n_bangs"),
            F.regexp_count("_body", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        )
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    safe = {name: f"try_divide({e.replace(' / ', ', ')})" if " / " in e else e for name, e in FEATURES.items()}
    return counted.select(
        "row",
        "doc_id",
        *COUNTS,
        failed.alias("base_failed"),
        F.struct(*[F.expr(e).alias(name) for name, e in safe.items()]).alias("features"),
    )


def learn(
    judged: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    quantiles: int = 32,
    most_conditions: int = 3,
    least_precision: float = 0.95,
    most_chance: float = 0.01,
) -> list[Rule]:
    """A decision list for label 0 among the documents that pass the base check.

    judged: doc_id, base_failed and features of `measured`, best staged. most_chance: how likely
    the rows of a rule may be as low by chance, whatever condition was searched for.
    """
    marks = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias("mark"))
    # Learning reads its sample many times: few files, each for one task.
    files = -(-marks.count() // FILE_ROWS) or 1
    known = judged.where(~F.col("base_failed")).join(marks, "doc_id").select("doc_id", "features.*", "mark")
    sample = staged(
        known.select(
            *FEATURES,
            (F.col("mark") == 0).cast("long").alias("low"),
            (F.pmod(F.xxhash64("doc_id", F.lit("grow")), F.lit(3)) > 0).alias("grow"),
        ).repartition(files),
        "rules",
    )
    rules: list[Rule] = []
    while rule := _next_rule(
        sample.where(first_match(rules).isNull()), quantiles, most_conditions, least_precision, most_chance
    ):
        rules.append(rule)
    used_up(sample)
    return rules


def _next_rule(
    rows: DataFrame, quantiles: int, most_conditions: int, least_precision: float, most_chance: float
) -> Rule:
    """The first good rule of those grown from each feature's best conditions; () if none is good."""
    growing = rows.where("grow")
    starts, tries = _conditions(growing, quantiles)
    for start in starts:
        rule: Rule = (start,)
        while len(rule) < most_conditions:
            further, _ = _conditions(growing.where(matches(rule)), quantiles)
            if not further:
                break
            rule = (*rule, further[0])
        if rule := _pruned(rows, rule, least_precision, most_chance / tries):
            return rule
    return ()


def _thresholds(rows: DataFrame, quantiles: int) -> dict[str, list[float]]:
    """Half way between neighbours of the values at both classes' ends and quantiles."""
    steps = F.array(*[F.lit((k + 0.5) / quantiles) for k in range(quantiles)])
    ends = {name: F.array(F.min(name), F.max(name)) for name in FEATURES}
    by_mark = rows.groupBy("low").agg(
        *[F.concat(F.percentile_approx(name, steps), ends[name]).alias(name) for name in FEATURES]
    )
    found = by_mark.collect()  # two rows
    if len(found) < 2:
        return {}
    grid = {name: sorted({v for row in found for v in row[name] or []}) for name in FEATURES}
    return {name: [(a + b) / 2 for a, b in pairwise(values)] for name, values in grid.items()}


def _conditions(rows: DataFrame, quantiles: int) -> tuple[list[Condition], int]:
    """The condition of the largest gain of information of each feature and side, the best one first,
    and how many were tried. Thresholds are those of the given rows."""
    thresholds = _thresholds(rows, quantiles)
    tries = 2 * sum(map(len, thresholds.values()))
    if not tries:
        return [], 0

    def bin_of(name: str) -> Column:
        """How many thresholds of the feature lie below its value."""
        values = F.array(*[F.lit(float(t)) for t in thresholds[name]]).cast("array<double>")
        return F.size(F.filter(values, lambda t: t < F.col(name)))

    bins_of = F.array(*[F.struct(F.lit(n).alias("feature"), bin_of(n).alias("bin")) for n in FEATURES])
    per_bin = (
        rows.select("low", F.explode(bins_of).alias("entry"))
        .groupBy("entry.feature", "entry.bin")
        .agg(F.sum("low").alias("low"), F.sum(1 - F.col("low")).alias("good"))
    )
    counts: dict[str, dict[int, tuple[int, int]]] = {name: {} for name in FEATURES}
    for row in per_bin.collect():  # features x thresholds
        counts[row.feature][row.bin] = (row.low, row.good)
    low = sum(c[0] for c in counts["words"].values())
    good = sum(c[1] for c in counts["words"].values())
    now, best = log2(low / (low + good)), {}
    for name, bins in counts.items():
        low_below = good_below = 0
        for k, threshold in enumerate(thresholds[name]):
            low_below += bins.get(k, (0, 0))[0]
            good_below += bins.get(k, (0, 0))[1]
            for above, p, n in ((True, low - low_below, good - good_below), (False, low_below, good_below)):
                gain = p * (log2(p / (p + n)) - now) if p else 0.0
                # Of equal gains the narrower condition: the higher threshold to be above.
                if gain > max(1e-9, best.get((name, above), (0.0,))[0]) or above and gain == best.get((name, True), (-1.0,))[0]:
                    best[name, above] = (gain, Condition(name, above, threshold))
    ranked = sorted(reversed(best.values()), key=lambda e: (-e[0], not e[1].above))
    return [condition for _, condition in ranked], tries


def _log_chance(low: int, covered: int, base: float) -> float:
    """Log of a bound (Chernoff's) of the chance that so many of the rows covered are low."""
    share = low / covered
    if share <= base:
        return 0.0
    rest = (1 - share) * log((1 - share) / (1 - base)) if share < 1 else 0.0
    return -covered * (share * log(share / base) + rest)


def _pruned(rows: DataFrame, rule: Rule, least_precision: float, most_chance: float) -> Rule:
    """The beginning of the rule that is best on the rows kept from growing; () if none is good.

    most_chance: for one condition; each further one was searched for as widely as the first.
    """
    kept, sums = F.lit(1) - F.col("grow").cast("int"), [F.avg("low").alias("base")]
    for length in range(1, len(rule) + 1):
        covers = matches(rule[:length]).cast("int")
        for name, rows_of in (("kept", kept), ("all", F.lit(1))):
            sums.append(F.sum(covers * rows_of * F.col("low")).alias(f"low_{name}_{length}"))
            sums.append(F.sum(covers * rows_of).alias(f"{name}_{length}"))
    found, best = rows.agg(*sums).first(), (-2.0, ())
    for length in range(1, len(rule) + 1):
        held, low_held = found[f"kept_{length}"] or 0, found[f"low_kept_{length}"] or 0
        covered, low = found[f"all_{length}"] or 0, found[f"low_all_{length}"] or 0
        if not covered or low < least_precision * covered or low_held < least_precision * held:
            continue
        if _log_chance(low, covered, found["base"]) > length * log(most_chance):
            continue
        worth = (2 * low_held - held) / held if held else 0.0
        if worth > best[0] + 1e-9:
            best = (worth, rule[:length])
    return best[1]


def verdicts(measured_docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The columns of `measured`, with rule (the first that holds) and kept."""
    kept = ~F.col("base_failed") & F.col("rule").isNull()
    columns = ("row", "doc_id", *COUNTS, "base_failed", "features")
    return (
        measured_docs.select(*columns, "features.*")
        .withColumn("rule", first_match(rules))
        .select(*columns, "rule", kept.alias("kept"))
    )


def kept_rows(measured_docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows that are kept, with their own columns, of a result of `measured` that was staged."""
    return verdicts(measured_docs, rules).where("kept").select("row.*")


def accepted(docs: DataFrame, rules: list[Rule], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that are kept, with their own columns.

    The row number in the condition, true for every row, keeps the optimizer from moving the
    condition below the features, which would write their expressions out many times over.
    """
    judged = verdicts(measured(docs, doc_id, text), rules)
    numbered = judged.select("row", "kept", F.monotonically_increasing_id().alias("nth"))
    return numbered.where(F.col("kept") & (F.col("nth") >= 0)).select("row.*")
