"""Quality rules whose cutoffs carry a guarantee on false rejections.

``rule_counts`` measures each text. ``risk_controlled_cutoffs`` looks, per
stratum, for the strictest cutoffs with which all rules together wrongly reject
at most the share ``risk`` of good documents. A quarter of the labelled good
holdout documents, by a hash of doc_id, proposes a sequence of cutoffs from loose
to strict; the others test it in that order with an exact (Clopper-Pearson) upper
bound on the documents that any rule rejects, up to the first step that fails. Such
a fixed sequence needs no correction for its steps; the confidence is shared among
the strata and their pool. ``with_verdict`` gives the verdicts.

Strata with too few documents to prove anything are pooled: they get the cutoffs
that hold for all of them taken together, not for each.

Null or empty texts have no words and fail the base rule. A stratum without a
cutoff that can be proven rejects nothing beyond the base rule; so does a null
stratum or one that the holdout does not hold.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, texts_of, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

COUNT_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = ", ".join(f"{name} long" for name in COUNT_NAMES)

# Share of good documents that all rules of a stratum together may reject, and
# the probability that the selection breaks that promise.
RISK = 0.02
DELTA = 0.05
STEPS = 40
# One document in so many proposes cutoffs; the first step is so many grid steps looser than
# what rejects none of them, and the last ones reject up to RISK of them by each rule.
PROPOSING = 4
LOOSER = 12
SHARES = 8
SEED = 23


def _repeated_words(ids: np.ndarray, size: int) -> int:
    """Words inside a window of three that occurs twice or more."""
    if len(ids) < 4:
        return 0
    if size < 1 << 21:
        windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
        order = np.argsort(windows, kind="stable")
        same = windows[order][1:] == windows[order][:-1]
    else:
        order = np.lexsort((ids[2:], ids[1:-1], ids[:-2]))
        rows = np.stack([ids[:-2], ids[1:-1], ids[2:]], 1)[order]
        same = (rows[1:] == rows[:-1]).all(1)
    mark = np.zeros(len(ids), bool)
    found = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
    for j in range(3):
        mark[found + j] = True
    return int(mark.sum())


def text_counts(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    joined = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()] if b"\n" in text else []
    number: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    return (
        len(words),
        len(joined.decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated_words(ids, len(number)),
    )


def rule_counts(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` (as a struct ``row``) with the counts of the text."""
    prepare(df.sparkSession)
    plain = df.select(F.struct(*keep).alias("row"), F.col(text).alias("body"))

    def measure(batches):
        for batch in batches:
            counts = np.array([text_counts(t) for t in texts_of(batch.column(1))], np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in counts.T)],
                ["row", *COUNT_NAMES],
            )

    return plain.mapInArrow(measure, f"row {plain.schema['row'].dataType.simpleString()}, {COUNTS}")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def rule_values() -> dict[str, Column]:
    """Rule name -> value; the larger, the worse. All lie between 0 and about 1."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "dup_lines": F.col("n_dup_lines") / words,
        "repeats": F.col("n_repeat_words") / words,
        "long_words": 1 - 1 / (1 + F.greatest(F.col("word_chars") / words - 4, F.lit(0.0)) / 4),
        "short_words": 1 / (1 + F.col("word_chars") / words),
    }


def binomial_tail(bad: int, total: int, share: float) -> float:
    """P(at most ``bad`` of ``total``) at the given share, summed downwards from ``bad`` (which lies below the mean)."""
    if bad >= total:
        return 1.0
    term = math.exp(
        math.lgamma(total + 1)
        - math.lgamma(bad + 1)
        - math.lgamma(total - bad + 1)
        + bad * math.log(share)
        + (total - bad) * math.log1p(-share)
    )
    tail, i = term, bad
    while i > 0 and term > tail * 1e-15:
        term *= i * (1 - share) / ((total - i + 1) * share)
        tail += term
        i -= 1
    return tail


def proven(bad: int, total: int, risk: float, delta: float) -> bool:
    """Whether the exact upper confidence bound of bad / total is at most ``risk``."""
    return bad <= risk * total and binomial_tail(bad, total, risk) <= delta


def least_total(risk: float, delta: float) -> int:
    """The number of documents of which none may be rejected to prove ``risk``; with fewer nothing can be proven."""
    return math.ceil(math.log(delta) / math.log1p(-risk))


def proposed(above: list[int], total: int, risk: float) -> list[float]:
    """Cutoffs of a rule from loose to strict; ``above`` has the documents above each grid step."""

    def strictest(share: float) -> int:
        return max((i for i, n in enumerate(above) if n <= share * total), default=-1)

    none = strictest(0.0)
    steps = [*range(none - LOOSER, none + 1), *(strictest(risk * k / SHARES) for k in range(1, SHARES + 1))]
    return [2.0 ** (-i / 4) for i in steps]


def risk_controlled_cutoffs(
    good: DataFrame,
    stratum: str,
    values: dict[str, Column],
    risk: float = RISK,
    delta: float = DELTA,
    steps: int = STEPS,
    ident: str = "doc_id",
) -> DataFrame:
    """(stratum, rule, cutoff) from good holdout documents; values above the cutoff are rejected.

    Cutoffs come from a grid of ``steps`` values that halve the distance to 0 every
    four steps. Only counts per stratum, rule and step leave the executors.
    """
    grid = [2.0 ** (-i / 4) for i in range(steps)]
    tests = F.pmod(F.xxhash64(ident, F.lit(SEED)), F.lit(PROPOSING)) > 0
    held = good.filter(F.col(stratum).isNotNull()).select(
        F.col(stratum).alias("stratum"), tests.alias("tests"), F.array(*values.values()).alias("value")
    )
    sizes = held.groupBy("stratum").agg(F.count_if("tests").alias("tested"))
    each_delta = delta / (sizes.count() + 1)
    small = F.col("tested") < least_total(risk, each_delta)
    # The pool is the group without a member.
    groups = sizes.select(F.col("stratum").alias("of"), F.when(~small, F.col("stratum")).alias("member"))
    held = held.join(groups, F.col("stratum") == F.col("of")).select("member", "tests", "value")
    long = held.filter("not tests").select("member", F.posexplode("value").alias("rule", "value"))
    tallies = long.groupBy("member", "rule").agg(
        F.count("*").alias("total"), *(F.count_if(F.col("value") > g).alias(f"above_{i}") for i, g in enumerate(grid))
    )
    kind = good.schema[stratum].dataType.simpleString()

    def propose(batches):
        for frame in batches:
            rows = [
                (row.member, row.rule, proposed([int(getattr(row, f"above_{i}")) for i in range(steps)], int(row.total), risk))
                for row in frame.itertuples(index=False)
            ]
            yield type(frame)(rows, columns=["member", "rule", "path"])

    paths = (
        tallies.mapInPandas(propose, f"member {kind}, rule int, path array<double>")
        .groupBy(F.col("member").alias("path_of"))
        .agg(F.sort_array(F.collect_list(F.struct("rule", "path"))).alias("paths"))
    )
    length = LOOSER + 1 + SHARES
    # The number of steps that do not reject a document: paths never get looser.
    passed = F.array_min(
        F.zip_with("value", "paths", lambda value, rule: F.size(F.filter(rule["path"], lambda cutoff: cutoff >= value)))
    )
    tested = (
        held.filter("tests")
        .join(paths, F.col("member").eqNullSafe(F.col("path_of")))
        .select("member", passed.alias("passed"))
        .groupBy("member")
        .agg(F.count("*").alias("total"), *(F.count_if(F.col("passed") <= i).alias(f"bad_{i}") for i in range(length)))
    )

    def choose(batches):
        for frame in batches:
            rows = []
            for row in frame.itertuples(index=False):
                step = 0
                while step < length and proven(int(getattr(row, f"bad_{step}")), int(row.total), risk, each_delta):
                    step += 1
                if step:
                    rows.append((row.member, step - 1))
            yield type(frame)(rows, columns=["member", "step"])

    chosen = tested.mapInPandas(choose, f"member {kind}, step int")
    names = F.array(*map(F.lit, values))
    return (
        chosen.join(paths, F.col("member").eqNullSafe(F.col("path_of")))
        .select(F.col("member").alias("group"), "step", F.explode("paths").alias("x"))
        .join(groups, F.col("group").eqNullSafe(F.col("member")))
        .select(
            F.col("of").alias("stratum"),
            F.element_at(names, F.col("x.rule") + 1).alias("rule"),
            F.element_at("x.path", F.col("step") + 1).alias("cutoff"),
        )
    )


def with_verdict(counted: DataFrame, stratum: Column, cutoffs: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Add base_failed, rejected_by (names of rules) and kept.

    The cutoffs are one row per stratum after a pivot, joined by it. The hot
    stratum's rows do not move when that table is small enough to broadcast,
    and AQE splits them otherwise.
    """
    limits = cutoffs.groupBy(F.col("stratum").alias("limit_of")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits")
    )
    failing = [
        F.when(v > F.element_at(F.col("limits"), F.lit(r)), F.lit(r)) for r, v in values.items()
    ]
    return (
        counted.join(limits, stratum.eqNullSafe(F.col("limit_of")) & stratum.isNotNull(), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("rejected_by", F.array_compact(F.array(*failing)))
        .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
        .drop("limits", "limit_of")
    )


def quality_verdicts(df: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """doc_id, counts, base_failed, rejected_by and kept for every row of ``df``.

    ``labels`` (doc_id, quality) gives the holdout: rows with quality 1 that
    pass the base rule. Of repeated labels the largest counts.
    """
    counted = written(
        rule_counts(df, ["doc_id", stratum]).select(
            F.col("row.doc_id").alias("doc_id"), F.col(f"row.{stratum}").alias("stratum"), *COUNT_NAMES
        ),
        "rule-counts",
    )
    values = rule_values()
    good = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .filter("quality = 1")
        .select("doc_id")
    )
    holdout = counted.join(good, "doc_id", "left_semi").filter(~base_failed())
    cutoffs = risk_controlled_cutoffs(holdout, "stratum", values, risk, delta)
    out = with_verdict(counted, F.col("stratum"), cutoffs, values)
    return out.select("doc_id", *COUNT_NAMES, "base_failed", "kept", "rejected_by")
