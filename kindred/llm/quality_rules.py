"""Quality rules with risk-controlled cutoffs.

Every rule compares one statistic of the text with a cutoff. Cutoffs are chosen on
labelled documents, a set of cutoffs at once. Sets stand in ladders that are fixed
beforehand: one per rule, which tightens that rule alone step by step, and one that
tightens all rules together. For a stratum and a set the good documents that any of
its cutoffs would reject are counted; an exact binomial tail has to show, at the level
``error`` divided by the number of strata and ladders (Bonferroni), that less than
``max_false_rejection`` of good documents are lost. A ladder is climbed in its order
until the first set that fails (fixed-sequence testing), so its steps need no further
division. Of the admitted sets of a stratum the one that rejects most labelled
documents which are not good is taken; choosing among sets that all hold costs
nothing. A stratum with too few labels has none and rejects nothing. With probability
``1 - error`` the chosen sets reject less than the stated share of good documents
in every stratum.

Everything runs as DataFrame and SQL functions. Per document one narrow row
leaves the scan; texts are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators.sizes import shipped
from kindred.session import materialize

SPACE_RUN = "[\\x20\\x09-\\x0D]+"
WORD_CHAR = "[^\\x20\\x09-\\x0D]"
SYMBOL = "[#*$%&|<>]"
WINDOW = 8

#: Strata whose cutoffs are shipped to every task at most.
MAX_SHIPPED_STRATA = 100_000


@dataclass(frozen=True)
class Rule:
    """Rejects where ``statistic`` (SQL over the feature columns) is above a cutoff."""

    name: str
    statistic: str
    cutoffs: tuple[float, ...]


#: Candidate cutoffs, strictest first.
RULES = (
    Rule("symbols_per_word", "n_symbols / nullif(n_words, 0)", (0.1, 0.2, 0.4, 0.6, 0.8, 1.0, 1.5, 2.0)),
    Rule("duplicate_lines", "n_dup_lines / nullif(n_lines, 0)", (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)),
    Rule("repeated_words", "n_repeat_words / nullif(n_words, 0)", (0.05, 0.1, 0.15, 0.2, 0.25)),
    Rule("long_words", "word_chars / nullif(n_words, 0)", (8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0)),
)


#: Settings of ``judge`` and ``kept_documents``.
DEFAULTS = {
    "id_col": "doc_id",
    "text_col": "text",
    "stratum_col": "lang",
    "rules": RULES,
    "max_false_rejection": 0.02,
    "error": 0.05,
    "min_words": 20,
    "max_repeat_percent": 30,
}


def features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep``, n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_repeat_words of every whole text; null counts as no text.

    Windows are compared by a 64-bit hash of their words and equal hashes by
    the words themselves, inside the row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, SPACE_RUN), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_CHAR))
    listed = docs.select(F.col(id_col).alias("doc_id"), *keep, text.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    hashes = F.expr(
        f"""if(size(_words) < {WINDOW}, cast(array() as array<bigint>),
            transform(sequence(1, size(_words) - {WINDOW - 1}), i -> xxhash64(slice(_words, i, {WINDOW}))))"""
    )
    counted = listed.select(
        "doc_id",
        *keep,
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        "_words",
        hashes.alias("_hashes"),
    )
    # where a hash repeats at all: (hash, start) of every window, sorted, so that equal windows become neighbours
    starts = F.expr(
        """if(size(array_distinct(_hashes)) = size(_hashes), array(),
            sort_array(transform(_hashes, (h, i) -> struct(h as h, i + 1 as i))))"""
    )
    counted = counted.withColumn("_windows", starts)
    # starts of windows that stand at another place too, in text order
    found = F.expr(
        f"""sort_array(transform(filter(_windows, (x, k) ->
                (k > 0 and _windows[k - 1].h = x.h
                    and slice(_words, _windows[k - 1].i, {WINDOW}) = slice(_words, x.i, {WINDOW}))
                or (k + 1 < size(_windows) and _windows[k + 1].h = x.h
                    and slice(_words, _windows[k + 1].i, {WINDOW}) = slice(_words, x.i, {WINDOW}))), x -> x.i))"""
    )
    covered = F.expr(
        f"""aggregate(_found, struct(0L as n, -{WINDOW} as last),
                (a, i) -> struct(a.n + least({WINDOW}, i - a.last) as n, i as last), a -> a.n)"""
    )
    return counted.withColumn("_found", found).withColumn("n_repeat_words", covered).drop("_words", "_hashes", "_windows", "_found")


def base_failed(min_words: int, max_repeat_percent: int) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(Binomial(n, rate) <= k), exact up to rounding; 1 where ``k`` reaches the
    mean (no test is passed there). Terms are summed as logarithms."""
    log_odds = f"ln({rate!r}D / (1 - {rate!r}D))"
    summed = F.expr(
        f"""aggregate(sequence(1L, greatest(_k, 1L)),
                struct(_n * ln(1 - {rate!r}D) as t, exp(_n * ln(1 - {rate!r}D)) as s),
                (a, i) -> struct(
                    a.t + if(i <= _k, ln((_n - i + 1) / i) + {log_odds}, 0D) as t,
                    a.s + if(i <= _k, exp(a.t + ln((_n - i + 1) / i) + {log_odds}), 0D) as s),
                a -> a.s)"""
    )
    return F.when(k >= rate * n, F.lit(1.0)).otherwise(summed)


def ladders(rules: tuple[Rule, ...]) -> list[list[dict[str, float]]]:
    """Sets of cutoffs (rule: cutoff) in the order in which they are tested: one ladder
    per rule, and with several rules one for all of them together."""
    out = [[{rule.name: float(cut)} for cut in reversed(rule.cutoffs)] for rule in rules]
    if len(rules) > 1:
        steps = max(len(rule.cutoffs) for rule in rules)
        out.append([{r.name: float(r.cutoffs[max(0, len(r.cutoffs) - 1 - step)]) for r in rules} for step in range(steps)])
    return out


def choose_cutoffs(
    labelled: DataFrame, rules: tuple[Rule, ...], *, max_false_rejection: float, error: float
) -> DataFrame:
    """stratum, rule, cutoff: the cutoffs of every stratum's chosen set.

    ``labelled`` has the feature columns, ``stratum`` and ``good`` (boolean).
    At most strata x rules rows come back. Of sets that reject equally many documents
    which are not good, the one that loses fewest good ones is taken, then the first;
    where all labelled documents are good, the strictest.
    """
    sets = ladders(rules)
    above = {rule.name: rule.statistic for rule in rules}
    tested = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(number).alias("ladder"),
                    F.lit(step).alias("step"),
                    F.expr(" or ".join(f"coalesce({above[name]} > {cut!r}D, false)" for name, cut in cuts.items())).alias("rejects"),
                )
                for number, ladder in enumerate(sets)
                for step, cuts in enumerate(ladder)
            ]
        )
    )
    rejected = F.col("test.rejects").cast("bigint")
    good = F.col("good").cast("bigint")
    counts = (
        labelled.select("stratum", "good", tested.alias("test"))
        .groupBy("stratum", "test.ladder", "test.step")
        .agg(F.sum(good).alias("_n"), F.sum(good * rejected).alias("_k"), F.sum((1 - good) * rejected).alias("_junk"), F.sum(1 - good).alias("_bad"))
        .filter("_n > 0")
    )
    n_tests = labelled.filter("good").select("stratum").distinct().agg((F.count(F.lit(1)) * len(sets)).alias("_tests"))
    # one row: the number of ladders of all strata
    tail = binomial_tail(F.col("_k"), F.col("_n"), max_false_rejection)
    held = counts.join(F.broadcast(n_tests)).withColumn("_holds", tail * F.col("_tests") <= error)
    # the steps of a ladder up to its first failure; a few rows per stratum
    climbed = Window.partitionBy("stratum", "ladder").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    admitted = held.withColumn("_holds", F.min("_holds").over(climbed)).filter("_holds")
    lost = F.when(F.col("_bad") == 0, -F.col("_k")).otherwise(F.col("_k"))
    best = admitted.groupBy("stratum").agg(F.min(F.struct(-F.col("_junk"), lost, "ladder", "step")).alias("s"))
    cutoffs = F.array(
        *[
            F.struct(F.lit(number).alias("ladder"), F.lit(step).alias("step"), F.lit(name).alias("rule"), F.lit(cut).alias("cutoff"))
            for number, ladder in enumerate(sets)
            for step, cuts in enumerate(ladder)
            for name, cut in cuts.items()
        ]
    )
    chosen = best.select("stratum", "s.ladder", "s.step", F.explode(cutoffs).alias("c"))
    return chosen.filter("ladder = c.ladder and step = c.step").select("stratum", "c.rule", "c.cutoff")


def _judged(
    docs: DataFrame,
    labels: DataFrame,
    carried: list[str],
    *,
    id_col: str,
    text_col: str,
    stratum_col: str | None,
    rules: tuple[Rule, ...],
    max_false_rejection: float,
    error: float,
    min_words: int,
    max_repeat_percent: int,
) -> DataFrame:
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col else F.lit("")
    # the columns that pass through travel in one struct, so no name can clash
    row = F.struct(*carried) if carried else F.lit(None).cast("string")

    def featured(source: DataFrame, carrying: Column) -> DataFrame:
        taken = source.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), stratum.alias("stratum"), carrying.alias("row"))
        return features(taken, keep=("stratum", "row")).withColumn("base_failed", base_failed(min_words, max_repeat_percent))

    good = (
        labels.filter(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col(id_col).alias("doc_id"))
        .agg((F.min("quality") == 1).alias("good"))
    )
    source = docs
    if carried:
        # cutoffs follow from labelled rows alone; the others are looked at once, at the end
        ids = materialize(good.select(F.col("doc_id").alias("_kd_label_id")), "labelled")
        source = docs.join(shipped(ids, ids.count()), docs[id_col] == ids["_kd_label_id"], "left_semi")
    counted = materialize(featured(source, F.lit(None).cast("string")).drop("row"), "quality-features")
    labelled = counted.filter("not base_failed").join(good, "doc_id").dropDuplicates(["doc_id"])
    cutoffs = choose_cutoffs(labelled, rules, max_false_rejection=max_false_rejection, error=error)
    wide = cutoffs.groupBy("stratum").pivot("rule", [r.name for r in rules]).agg(F.min("cutoff"))
    # one row per stratum and one column per rule, counted before it is shipped
    wide = materialize(wide.select("stratum", *[F.col(r.name).alias(f"_cut_{i}") for i, r in enumerate(rules)]), "cutoffs")
    if wide.count() <= MAX_SHIPPED_STRATA:
        wide = F.broadcast(wide)
    rejected = F.lit(False)
    for i, rule in enumerate(rules):
        rejected = rejected | F.coalesce(F.expr(rule.statistic) > F.col(f"_cut_{i}"), F.lit(False))
    if carried:
        # texts are not written between the two passes: the features are taken again. The
        # one-row explode keeps the filter above it, which would else be pushed down and
        # have every use of a feature compute it anew.
        counted = featured(docs, row).select(F.explode(F.array(F.struct("*"))).alias("f")).select("f.*")
    return counted.join(wide, "stratum", "left").withColumn("kept", ~F.col("base_failed") & ~rejected)


def judge(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """One row per row of ``docs`` with the features, base_failed and kept.

    ``settings`` overrides ``DEFAULTS``. ``labels`` has ``id_col`` and ``quality`` (1: good). The holdout are the good
    labelled documents that pass the base rules; whatever a rule says about a
    document that fails them changes nothing.

    Defined cases: a null text has no words and fails the base rule. A null
    stratum is a stratum of its own. Rows with a null id are judged like others
    but have no label. Repeated rows are judged each; repeated labels of one id
    count once and as good only if all of them are good. A table of no labels
    admits no cutoff. Statistics over zero words or lines reject nothing.
    """
    judged = _judged(docs, labels, [], **{**DEFAULTS, **settings})
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "stratum"
    )


def kept_documents(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns as they are."""
    judged = _judged(docs, labels, docs.columns, **{**DEFAULTS, **settings})
    return judged.filter("kept").select("row.*")
