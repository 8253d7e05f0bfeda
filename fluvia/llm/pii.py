"""Operator 6: personal data, by weak supervision, in Spark's own expressions.

Base spans (email, ip, card, phone) come from fixed patterns and checks and always
stay.  Further candidates (keys and secrets, telephone numbers without a country
code, spelled-out addresses, card numbers with a wrong check digit) are put
before four labelers: the shape a stricter pattern knows, a gazetteer of known
prefixes, the words in front, and the mix of characters.  Each votes for or
against or abstains; expectation-maximisation over the numbers of all spans with
each pattern of votes estimates their reliabilities; a logistic span classifier
is trained on the posteriors and decides which candidates are added.

Patterns have no repeated groups without a bound, so that texts of any length
neither overflow the regular expression engine's stack nor take quadratic time: an
attempt starts only where a run of its characters starts or the last match ended.

A null text is an empty one; without spans the digest is that of the empty text and
``spans`` is empty.  Repeated rows get equal spans; an empty table gives no rows.
Offsets are in code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, weak

# Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(1, 6)

# The base patterns, in the form described above.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
_LONE_DOT = r"(?<![A-Za-z0-9-])\.|\.(?![A-Za-z0-9-])"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_IP_PARTS = r"^0*+(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9]?)(\.0*+(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9]?)){3}$"
_CARD = r"(?<![0-9 -])[0-9](?:[ -]?[0-9]){12,18}(?![0-9 -])"
_LONE_SEPARATOR = r"(?<![0-9])[ -]|[ -](?![0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Candidates beyond the base.
_KEY = r"(?<![A-Za-z0-9_])(?=[A-Za-z_]*+[0-9])(?=[0-9_]*+[A-Za-z])[A-Za-z0-9_]{12,}+"
_LOCAL_PHONE = r"(?<![0-9+(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
_SPELLED = r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64} ?[(\[](?:at|AT)[)\]] ?[A-Za-z0-9-]{1,63} ?[(\[](?:dot|DOT)[)\]] ?[A-Za-z]{2,12}"

# What the labelers know.
_STRICT = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|[0-9a-f]{16,64}|\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-][0-9]{4}|.*(@|[(\[](at|AT)[)\]]).*|\+.*|([0-9]+\.){3}[0-9]+)$"
_PREFIXES = r"^(AKIA|ASIA|gh[pousr]_|sk_|pk_|xox|eyJ|\+?1[ (]|\+[2-9]|4|5[1-5]|3[47]|6011|.*[.](com|org|net|edu|gov|io|de|fr|es|uk)$)"
_FOR = r"(?i)(pass(word|wd)?|pwd|token|secret|api[ _-]?key|key|auth|bearer|credential|tel(ephone)?|phone|mobile|fax|call|e-?mail|contact|card|visa|iban|account)[^A-Za-z0-9]{0,6}$"
_AGAINST = r"(?i)(version|isbn|issn|page|order|invoice|total|price|commit|revision|checksum|md5|sha[0-9]*|build|chapter|figure)[^A-Za-z0-9]{0,6}$"

_CONTEXT = 24
#: Labelers, and the features of the classifier with their numbers of values.
LABELERS = ("shape", "gazetteer", "context", "mix")
FEATURES = {"kind": 6, "size": 4, "digits": 4, "upper": 3, "cue": 3, "known": 3}
KEEP = 0.5


def _sums(df: DataFrame, name: str, lengths: str) -> DataFrame:
    """Adds ``name``: running totals of the array ``lengths``, in blocks so that a long array isn't copied for each entry."""
    one = "aggregate({xs}, cast(array() as array<bigint>), (acc, x) -> concat(acc, array(coalesce(try_element_at(acc, -1), 0L) + x)))"
    df = df.withColumn("_blocks", F.expr(f"transform(sequence(0, greatest(0, (size({lengths}) - 1) div 256)), b -> {one.format(xs=f'slice({lengths}, cast(b as int) * 256 + 1, 256)')})"))
    df = df.withColumn("_before", F.expr(one.format(xs="transform(_blocks, b -> coalesce(try_element_at(b, -1), 0L))")))
    return df.withColumn(name, F.expr("flatten(transform(_blocks, (b, i) -> transform(b, x -> x + if(i = 0, 0L, _before[i - 1]))))")).drop("_blocks", "_before")


def _matches(df: DataFrame, name: str, text: Column, pattern: str, kind: int, may: Column) -> DataFrame:
    """Adds ``name``: array of (k, s, e, w, left) for each match; ``may``: false only where nothing can match."""
    empty = F.array().cast("array<string>")
    df = df.withColumn("_m", F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(empty))
    df = df.withColumn("_g", F.when(F.size("_m") > 0, F.split(text, pattern, -1)).otherwise(empty))
    df = df.withColumn("_n", F.expr("transform(_m, (m, i) -> cast(length(_g[i]) + length(m) as bigint))"))
    df = _sums(df, "_e", "_n")
    return df.withColumn(name, F.expr(f"transform(_m, (m, i) -> named_struct('k', {kind}, 's', _e[i] - length(m), 'e', _e[i], 'w', m, 'left', right(_g[i], {_CONTEXT})))")).drop("_m", "_g", "_n", "_e")


def _luhn(word: Column) -> Column:
    digits = F.lpad(F.regexp_replace(word, "[^0-9]", ""), 19, "0")
    total = F.lit(0)
    for i in range(19):
        d = F.substring(digits, i + 1, 1).cast("int")
        if (18 - i) % 2:
            d = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        total = total + d
    return total % 10 == 0


def _n_digits(word: Column) -> Column:
    return F.length(F.regexp_replace(word, "[^0-9]", ""))


def with_candidates(df: DataFrame) -> DataFrame:
    """Adds ``_base`` and ``_more``: arrays of (k, s, e, w, left), from the column ``_t``."""
    t = F.col("_t")
    at, plus = F.contains(t, F.lit("@")), F.contains(t, F.lit("+"))
    df = _matches(df, "_email", F.regexp_replace(t, _LONE_DOT, "%"), _EMAIL, EMAIL, at)
    df = _matches(df, "_ip", t, _IP, IP, t.rlike(r"[0-9]\.[0-9]"))
    df = _matches(df, "_card", F.regexp_replace(t, _LONE_SEPARATOR, "_"), _CARD, CARD, t.rlike(r"[0-9](?:[ -]?[0-9]){12}"))
    df = _matches(df, "_phone", t, _PHONE, PHONE, plus)
    df = _matches(df, "_key", t, _KEY, SECRET, t.rlike(r"[A-Za-z_][0-9]|[0-9][A-Za-z_]"))
    df = _matches(df, "_local", t, _LOCAL_PHONE, PHONE, t.rlike(r"[0-9]{3}[ .-][0-9]{4}"))
    df = _matches(df, "_spelled", t, _SPELLED, EMAIL, t.rlike(r"(?i)[(\[]at[)\]]"))
    good_ip = F.filter("_ip", lambda m: m["w"].rlike(_IP_PARTS))
    good_phone = F.filter("_phone", lambda m: _n_digits(m["w"]).between(9, 15))
    df = df.withColumn("_base", F.concat("_email", good_ip, F.filter("_card", lambda m: _luhn(m["w"])), good_phone))
    others = F.concat("_key", "_local", "_spelled", F.filter("_card", lambda m: ~_luhn(m["w"])))
    df = df.withColumn("_more", F.filter(others, lambda m: ~F.exists("_base", lambda b: (b["s"] < m["e"]) & (m["s"] < b["e"]))))
    return df.drop("_email", "_ip", "_card", "_phone", "_key", "_local", "_spelled")


def _labelled(spans: str, base: bool) -> Column:
    """Spans with the votes and features of each; words and contexts go."""

    def one(m: Column) -> Column:
        w, n = m["w"], F.length(m["w"])
        digits, upper, lower = _n_digits(w), F.length(F.regexp_replace(w, "[^A-Z]", "")), F.length(F.regexp_replace(w, "[^a-z]", ""))
        cue = F.when(m["left"].rlike(_FOR), 1).when(m["left"].rlike(_AGAINST), -1).otherwise(0)
        card = m["k"] == CARD
        # An issuer's prefix says nothing about a number with a wrong check digit.
        known = F.when(w.rlike(_PREFIXES) & (F.lit(base) | ~card), 1).otherwise(0)
        shape = F.when(card, F.lit(1 if base else -1)).when(w.rlike(_STRICT), 1).otherwise(-1)
        mixed = F.when(m["k"] != SECRET, 0).when((digits * 5 >= n) & (digits * 10 <= 9 * n), 1).when((digits * 10 < n) | (lower * 10 >= 8 * n), -1).otherwise(0)
        bucket = lambda value, *cuts: sum((F.when(value >= c, 1).otherwise(0) for c in cuts), F.lit(0))
        return F.struct(
            m["k"].alias("k"), m["s"].alias("s"), m["e"].alias("e"),
            F.array(shape, known, cue, mixed).alias("v"),
            F.array(m["k"], bucket(n, 12, 20, 32), bucket(digits * 8, n, 3 * n, 6 * n), bucket(upper * 4, n, 3 * n), cue + 1, known).alias("f"),
        )

    return F.transform(spans, one)


@dataclass(frozen=True)
class Classifier:
    bias: float
    weights: tuple[tuple[float, ...], ...]

    def probability(self, features: Column) -> Column:
        z = F.lit(self.bias)
        for i, weights in enumerate(self.weights):
            z = z + F.get(F.array(*[F.lit(w) for w in weights]), F.get(features, i))
        return 1 / (1 + F.exp(-z))


def trained(labelled: DataFrame) -> Classifier:
    """Votes to posteriors to classifier, from all spans of a table with ``_base`` and ``_more`` labelled.

    What comes to the driver are counts by votes and features: their number of
    combinations bounds it.
    """
    tagged = lambda xs, sure: F.transform(xs, lambda x: F.struct(x["v"].alias("v"), x["f"].alias("f"), F.lit(sure).alias("sure")))
    spans = labelled.select(F.explode(F.concat(tagged("_base", True), tagged("_more", False))).alias("x")).select("x.*")
    cells = spans.groupBy("v", "f", "sure").agg(F.count(F.lit(1)).alias("n")).collect()
    counts: dict[bool, dict[tuple[int, ...], int]] = {True: {}, False: {}}
    for c in cells:
        counts[c.sure][tuple(c.v)] = counts[c.sure].get(tuple(c.v), 0) + c.n
    # Base spans passed their checks: they anchor the positive class.
    model = weak.fit(counts[False], len(LABELERS), sure=counts[True])
    sizes = list(FEATURES.values())
    starts = np.cumsum([0, *sizes])
    x = np.zeros((len(cells), starts[-1] + 1))
    x[:, -1] = 1
    for row, c in zip(x, cells, strict=True):
        row[starts[:-1] + np.array(c.f)] = 1
    n, y = np.array([c.n for c in cells], float), np.array([1.0 if c.sure else model.of(tuple(c.v)) for c in cells])
    w = np.zeros(x.shape[1])
    for _ in range(50 if len(cells) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (n * (p - y)) + 0.1 * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return Classifier(float(w[-1]), tuple(tuple(w[a:b].tolist()) for a, b in zip(starts, starts[1:])))


def _classified(labelled: DataFrame, classifier: Classifier) -> DataFrame:
    """Turns ``_base`` and ``_more`` into sorted ``base`` and ``spans`` of (k, s, e)."""
    bare = lambda xs: F.transform(xs, lambda m: F.struct(m["k"].alias("k"), m["s"].alias("s"), m["e"].alias("e")))
    added = F.filter("_more", lambda m: classifier.probability(m["f"]) >= KEEP)
    return labelled.withColumn("base", F.array_sort(bare("_base"))).withColumn("spans", F.array_sort(F.concat(bare("_base"), bare(added)))).drop("_base", "_more")


def _labels(df: DataFrame) -> DataFrame:
    return with_candidates(df).withColumn("_base", _labelled("_base", True)).withColumn("_more", _labelled("_more", False))


def found(df: DataFrame) -> DataFrame:
    """doc_id with ``base`` and ``spans``: arrays of (k, s, e), k an index of ``KINDS`` from 1."""
    labelled = common.staged(_labels(df.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("_t"))).select("doc_id", "_base", "_more"), "pii-spans")
    return _classified(labelled, trained(labelled))


def _listed(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", F.element_at(names, m["k"]), m["s"].cast("string"), m["e"].cast("string"))), ",")


def digests(spans: DataFrame) -> DataFrame:
    """Counts of base spans, the digest of their list, and the list of all spans."""

    def count(kind: int, name: str) -> Column:
        # A second parameter of the function would be the place in the array.
        return F.size(F.filter("base", lambda m: m["k"] == kind)).cast("long").alias(f"n_{name}")

    counts = [count(k + 1, name) for k, name in enumerate(KINDS[:4])]
    return spans.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def redacted(df: DataFrame, column: str = "text", mark: Sequence[str] = tuple(f"<{k}>" for k in KINDS), length: str | None = None) -> DataFrame:
    """The rows of ``df`` with every span of ``column`` replaced by its kind's mark; null texts stay null.

    ``length`` names a column that follows where the text changed.  Other columns, of any name, pass untouched.
    """
    model = trained(_labels(df.select(common.text_of(common.quoted(column)).alias("_t"))).select("_base", "_more"))
    rows = df.select(common.row_of(df).alias("_row"), common.text_of(common.quoted(column)).alias("_t"))
    spans = _classified(_labels(rows), model)
    marks = F.array(*[F.lit(m) for m in mark])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        kept = F.call_function("substring", F.col("_t"), (acc["at"] + 1).cast("int"), (m["s"] - acc["at"]).cast("int"))
        return F.when(m["s"] >= acc["at"], F.struct(m["e"].alias("at"), F.concat(acc["out"], kept, F.element_at(marks, m["k"])).alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], m["e"]).alias("at"), acc["out"].alias("out"))
        )

    by_start = F.array_sort("spans", lambda a, b: F.when(a["s"] < b["s"], -1).when(a["s"] > b["s"], 1).otherwise(0))
    rest = lambda acc: F.concat(acc["out"], F.call_function("substring", F.col("_t"), (acc["at"] + 1).cast("int")))
    new = F.when(F.size("spans") > 0, F.aggregate(by_start, start, step, rest))
    out = spans.select("_row", new.alias("new"))

    def value(name: str) -> Column:
        old = F.col("_row")[name]
        if name == column:
            return F.coalesce("new", old).alias(name)
        if name == length:
            return F.when(F.col("new").isNull() | (F.col("new") == F.col("_row")[column]), old).otherwise(F.length("new").cast(df.schema[name].dataType)).alias(name)
        return old.alias(name)

    return out.select(*map(value, df.columns))
