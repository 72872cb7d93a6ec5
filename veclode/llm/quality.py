"""Quality rules: an ordered decision list learned from labelled statistics.

Statistics of every text are counted in Arrow batches. Rules that reject are learned one
after another (sequential covering): a conjunction of thresholds grows by information gain
on two thirds of the labelled rows, is pruned on the other third, and is kept if it is
precise enough there; the rows it covers are then left out. The list becomes one Spark
conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veclode.llm.common import column, fresh_name, raw_bytes
from veclode.session import bounded_batches

STATS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_upper", "n_digits", "n_marks",
)

_BLANKS = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(0x41, 0x5B))
_DIGITS = bytes(range(0x30, 0x3A))
_MARKS = b"!?;:.,"
_TAILS = bytes(range(0x80, 0xC0))  # the bytes of a code point after its first


def _repeated(words: list[bytes], distinct: set[bytes]) -> int:
    """Words inside three-word windows that occur at least twice in the text."""
    if len(words) < 4:
        return 0
    number = dict(zip(distinct, range(len(distinct))))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    base = len(distinct)
    pairs = ids[:-1] * base + ids[1:]
    if base >= 1 << 20:  # three numbers would not fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, inverse, counts = np.unique(
        pairs[:-1] * base + ids[2:], return_inverse=True, return_counts=True
    )
    at = np.flatnonzero(counts[inverse] > 1)
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[at + k] = True
    return int(inside.sum())


def text_stats(text: bytes | None) -> tuple[int, ...]:
    """The numbers named in ``STATS``; zeros for a null or empty text."""
    if not text:
        return (0,) * len(STATS)
    count = lambda some: len(text) - len(text.translate(None, some))
    words = text.split()
    distinct = set(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        len(words),
        len(text) - count(_TAILS) - count(_BLANKS),
        count(_SYMBOLS),
        len(lines) - len(set(lines)),
        _repeated(words, distinct),
        len(lines),
        len(distinct),
        count(_UPPER),
        count(_DIGITS),
        count(_MARKS),
    )


def quality_stats(text: Column) -> Column:
    """A struct of the counts named in ``STATS`` for every whole text."""

    @F.arrow_udf("struct<" + ",".join(f"{n}:bigint" for n in STATS) + ">")
    def stats(texts: pa.Array) -> pa.Array:
        rows = np.array([text_stats(t) for t in raw_bytes(texts)], np.int64)
        rows = rows.reshape(len(texts), len(STATS))
        return pa.StructArray.from_arrays([pa.array(c) for c in rows.T.copy()], names=STATS)

    return stats(text)


# Features the rules put thresholds on: name, counted, per.
FEATURES = {
    "words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "distinct": ("n_distinct", "n_words"),
    "upper": ("n_upper", "word_chars"),
    "digits": ("n_digits", "word_chars"),
    "marks": ("n_marks", "word_chars"),
    "line_words": ("n_words", "n_lines"),
}


def features(stats: Column) -> dict[str, Column]:
    """The features as expressions over the counts; a share of nothing is 0."""
    out = {}
    for name, (of, per) in FEATURES.items():
        top = stats[of].cast("double")
        out[name] = top if per is None else F.when(stats[per] > 0, top / stats[per]).otherwise(0.0)
    return out


@dataclass(frozen=True)
class Rule:
    """Rejects a row that meets every condition (feature, ">=" or "<=", threshold)."""

    conditions: tuple[tuple[str, str, float], ...]

    def covers(self, table: dict[str, np.ndarray]) -> np.ndarray:
        ok = np.ones(len(next(iter(table.values()))), bool)
        for name, op, cut in self.conditions:
            ok &= table[name] >= cut if op == ">=" else table[name] <= cut
        return ok

    def expression(self, columns: dict[str, Column]) -> Column:
        ok = F.lit(True)
        for name, op, cut in self.conditions:
            ok &= columns[name] >= cut if op == ">=" else columns[name] <= cut
        return ok

    def __str__(self) -> str:
        return " and ".join(f"{n} {op} {cut:.6g}" for n, op, cut in self.conditions)


def _grow(table, bad, rows, max_conditions, cuts):
    """Conditions added by information gain until only bad rows are covered."""
    covered, conditions = rows.copy(), []
    while len(conditions) < max_conditions:
        p, n = (covered & bad).sum(), (covered & ~bad).sum()
        if not n or not p:
            break
        before, best = np.log2(p / (p + n)), (1e-9, None, None)
        for name, values in table.items():
            own = values[covered & bad]
            for cut in np.unique(np.quantile(own, np.linspace(0, 1, cuts))):
                for op in (">=", "<="):
                    ok = covered & (values >= cut if op == ">=" else values <= cut)
                    p1, all1 = (ok & bad).sum(), ok.sum()
                    gain = p1 * (np.log2(p1 / all1) - before) if p1 else 0
                    if gain > best[0]:
                        best = (gain, (name, op, float(cut)), ok)
        if best[1] is None:
            break
        conditions.append(best[1])
        covered = best[2]
    return conditions


def _worth(rule: Rule, table, bad, rows) -> float:
    covered = rule.covers(table) & rows
    p, n = (covered & bad).sum(), (covered & ~bad).sum()
    return (p - n) / (p + n) if p + n else -1.0


def _widened(rule: Rule, table, bad, rows) -> Rule:
    """Every threshold moved halfway to the nearest good row that meets the other conditions."""
    out = []
    for i, (name, op, cut) in enumerate(rule.conditions):
        others = Rule(rule.conditions[:i] + rule.conditions[i + 1 :])
        good = table[name][others.covers(table) & rows & ~bad]
        beyond = good[good < cut] if op == ">=" else good[good > cut]
        if len(beyond):
            cut = (cut + float(beyond.max() if op == ">=" else beyond.min())) / 2
        out.append((name, op, cut))
    return Rule(tuple(out))


def learn_rules(
    table: dict[str, np.ndarray],
    bad: np.ndarray,
    max_rules: int = 24,
    max_conditions: int = 4,
    min_precision: float = 0.97,
    min_covered: int = 4,
    cuts: int = 33,
    seed: int = 7,
) -> list[Rule]:
    """An ordered list of rules for the bad rows; everything else is kept.

    Rows without labels of both kinds teach nothing: the list is then empty.
    """
    bad = np.asarray(bad, bool)
    grow = np.random.default_rng(seed).random(len(bad)) < 2 / 3
    left, rules = np.ones(len(bad), bool), []
    while len(rules) < max_rules and (left & grow & bad).sum() >= min_covered:
        conditions = _grow(table, bad, left & grow, max_conditions, cuts)
        if not conditions:
            break
        shorter = [Rule(tuple(conditions[:k])) for k in range(1, len(conditions) + 1)]
        rule = max(shorter, key=lambda r: (_worth(r, table, bad, left & ~grow), len(r.conditions)))
        rule = _widened(rule, table, bad, left)
        covered = rule.covers(table) & left
        p, n = (covered & bad).sum(), covered.sum()
        checked = covered & ~grow
        precise = not checked.any() or bad[checked].mean() >= min_precision
        if p < min_covered or p < min_precision * n or not precise:
            break
        rules.append(rule)
        left &= ~covered
    return rules


def rule_number(rules: list[Rule], stats: Column) -> Column:
    """The number of the first rule that rejects a row (1, 2, ...), or null."""
    columns, out = features(stats), F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(rule.expression(columns), F.lit(i)).otherwise(out)
    return out


def fit_rules(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_rows: int = 20_000,
    **options,
) -> list[Rule]:
    """Learn the list from at most ``max_rows`` labelled documents (label 0: bad).

    The rows are those whose keys have the lowest hashes; rows without key or label are left
    out, a key labelled twice counts as bad if any label says so, and of documents with the
    same key the one with the least counts stands for it. Only counts of the sample reach the
    driver, one row for each chosen key.
    """
    bounded_batches(docs.sparkSession)
    k, y = column(labels, key), column(labels, label)
    chosen = (
        labels.where(k.isNotNull() & y.isNotNull())
        .groupBy(k.alias("label_key"))
        .agg(F.min(y).alias("label"))
        .orderBy(F.xxhash64("label_key"), "label_key")
        .limit(max_rows)
    )
    own = docs.select(column(docs, key).alias("key"), column(docs, text).alias("text"))
    rows = (
        own.join(F.broadcast(chosen), F.col("key") == F.col("label_key"))
        .select("key", "label", quality_stats(F.col("text")).alias("stats"))
        .groupBy("key")
        .agg(F.min("label").alias("label"), F.min("stats").alias("stats"))
    )
    found = rows.select("label", *[c.alias(n) for n, c in features(F.col("stats")).items()])
    table = found.toArrow()
    bad = table["label"].to_numpy() == 0
    if not bad.any() or bad.all():
        return []
    values = {n: table[n].to_numpy() for n in FEATURES}
    order = np.lexsort([*values.values(), bad])  # the same list, in whatever order rows came
    return learn_rules({n: v[order] for n, v in values.items()}, bad[order], **options)


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column, and its name: a struct of the counts, ``base_failed``,
    ``rule`` (the first that rejects, from 1, or null) and ``kept``.

    ``base_failed``: under 50 words, or over half of them in repeated three-word windows.
    A null or empty text has no words, hence fails. Every row is judged on its own.
    """
    bounded_batches(docs.sparkSession)
    counted, name = fresh_name(docs, "stats_"), fresh_name(docs, "quality_")
    stats = F.col(counted)
    failed = (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])
    number = rule_number(rules, stats)
    verdict = F.struct(
        *[stats[n].alias(n) for n in STATS],
        failed.alias("base_failed"),
        number.alias("rule"),
        (~failed & number.isNull()).alias("kept"),
    )
    judged = docs.withColumn(counted, quality_stats(column(docs, text)))
    return judged.withColumn(name, verdict).drop(counted), name


def keep_good(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The rows that pass, with the columns they came with."""
    judged, name = judge(docs, rules, text)
    return judged.where(F.col(name)["kept"]).drop(name)
