"""Exact, repeatable train / validation / test split without moving rows.

Rows are ordered by a hash of seed and id inside each class, rows that share it by a hash of
their content. The last row of each part is located by exact order statistics on the hash (a
few small jobs), after which membership is a comparison with literals: no shuffle, and every
recomputation gives the same parts. Only rows that are equal in everything and lie exactly
on a cut are numbered.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwatch.config import Config
from rankwatch.functions.rows import aggregate
from rankwatch.functions.values import num, quoted
from rankwatch.operators.ordering import DIRECT_ROWS, Target, order_statistics

# 13 hex digits are 52 bits: exact in a double, so quantile sketches do not round them.
_HEX_DIGITS = 13
_KEY, _COPY = "_split_key", "_split_copy"


def _fraction(text: str) -> str:
    return f"CAST(conv(substring(md5({text}), 1, {_HEX_DIGITS}), 16, 10) AS DOUBLE)"


def split_key(cfg: Config) -> Column:
    """First digits of md5('seed|id') as a whole number; a missing id is an empty one."""
    return F.expr(_fraction(f"concat('{cfg.seed}|', coalesce(CAST({quoted(cfg.id_column)} AS STRING), ''))"))


def content_key(columns: Iterable[str]) -> Column:
    """First digits of the md5 of all columns: the second key, for rows that share the first."""
    parts = ", ".join(f"coalesce(CAST({quoted(c)} AS STRING), '')" for c in columns)
    return F.expr(_fraction(f"concat_ws('|', {parts})"))


def class_counts(df: DataFrame, cfg: Config) -> dict[float, int]:
    """Rows per class of a 0/1 target. More than two classes is not a binary problem."""
    y = num(df.schema, cfg.target_column)
    found = aggregate(
        df,
        {
            "zeros": f"count_if(({y}) = 0)",
            "ones": f"count_if(({y}) = 1)",
            "others": f"count_if(({y}) IS NULL OR ({y}) NOT IN (0, 1))",
        },
    ).first()
    if found["others"]:
        raise ValueError(f"target must hold only 0 and 1, {found['others']} rows do not")
    return {c: n for c, n in ((0.0, found["zeros"]), (1.0, found["ones"])) if n}


def can_stratify(counts: Mapping[float, int]) -> bool:
    return len(counts) > 1 and min(counts.values()) >= 2


def _shares(total: int, counts: Mapping[float, int]) -> dict[float, int]:
    """Split `total` over classes in proportion, largest remainder first, then class order."""
    n = sum(counts.values())
    exact = {c: total * k / n for c, k in counts.items()}
    out = {c: math.floor(x) for c, x in exact.items()}
    by_remainder = sorted(counts, key=lambda c: (-(exact[c] - out[c]), c))
    for c in by_remainder[: total - sum(out.values())]:
        out[c] += 1
    return out


def quotas(counts: Mapping[float, int], fraction: float) -> dict[float, int]:
    """Rows of each class to hold out: ceil(fraction * n) in all, the kept part in proportion."""
    n = sum(counts.values())
    kept = _shares(n - math.ceil(fraction * n), counts)
    return {c: counts[c] - kept[c] for c in counts}


@dataclass(frozen=True)
class Stratum:
    member: Column
    count: int
    take: int


@dataclass(frozen=True)
class Cut:
    """The last row taken of a stratum: all rows before (first, second), and `copies` of the
    equal rows exactly there."""

    first: float
    second: float
    copies: int

    def at(self, u: Column, v: Column) -> Column:
        return (u == self.first) & (v == self.second)

    def holds(self, u: Column, v: Column) -> Column:
        here = self.at(u, v) & (F.col(_COPY) <= self.copies)
        return (u < self.first) | ((u == self.first) & (v < self.second)) | here


def _cuts(
    keyed: DataFrame, content: Column, strata: Mapping[str, Stratum], direct_rows: int
) -> dict[str, Cut]:
    """Where each stratum that is neither empty nor taken whole is cut."""
    u = F.col(_KEY)
    open_ = {k: s for k, s in strata.items() if 0 < s.take < s.count}
    if not open_:
        return {}
    # The hash is computed once per row and pass, below the expressions that compare it.
    narrow = keyed.select(_KEY, *[s.member.alias(f"in_{i}") for i, s in enumerate(open_.values())])
    first = order_statistics(
        narrow,
        {
            k: Target(F.when(F.col(f"in_{i}"), u), s.take - 1, s.take - 1, s.count)
            for i, (k, s) in enumerate(open_.items())
        },
        direct_rows,
    )
    # Rows that share the key at a cut (a repeated or missing id): settled by their content.
    tied = {k: s for k, s in open_.items() if first[k].upto > s.take}
    out = {k: Cut(first[k].high, math.inf, 0) for k in open_ if k not in tied}
    if not tied:
        return out
    sums = [F.count_if(s.member & (u < first[k].high)).alias(k) for k, s in tied.items()]
    below = keyed.agg(*sums).first()
    v = F.col("_v")
    # Only rows at a cut have their content hashed.
    here = keyed.where(u.isin([first[k].high for k in tied])).withColumn("_v", content)
    second = order_statistics(
        here,
        {
            k: Target(
                F.when(s.member & (u == first[k].high), v),
                s.take - below[k] - 1,
                s.take - below[k] - 1,
                first[k].upto - below[k],
            )
            for k, s in tied.items()
        },
        direct_rows,
    )
    counts = here.agg(
        *[
            F.count_if(s.member & (u == first[k].high) & (v < second[k].high)).alias(k)
            for k, s in tied.items()
        ]
    ).first()
    for k, s in tied.items():
        room = s.take - below[k] - counts[k]
        out[k] = Cut(first[k].high, second[k].high, room)
    return out


def _numbered_copies(keyed: DataFrame, content: Column, cuts: Iterable[Cut]) -> DataFrame:
    """Add the number of a row among its equals, for rows exactly on a cut; 0 elsewhere.

    Rows of one cut are equal in both keys, so which of them gets a number makes no difference;
    they are the only ones that move."""
    on = _any(c.at(F.col(_KEY), content) for c in cuts if c.copies)
    copies = keyed.where(on).withColumn("_v", content)
    number = F.row_number().over(Window.partitionBy(_KEY, "_v").orderBy(_KEY))
    rest = keyed.where(~on).withColumn(_COPY, F.lit(0))
    return rest.unionByName(copies.withColumn(_COPY, number).drop("_v"))


def stratified_split(
    df: DataFrame, cfg: Config, direct_rows: int = DIRECT_ROWS
) -> DataFrame:
    """Append `split` in {train, validation, test}.

    Test rows are taken first, validation rows from the rest. A stage whose rows can not be
    stratified takes from all classes together; once that is so it stays so, because the
    rest never has more rows of a class. Rows are ordered by a hash of seed and id, then by a
    hash of their content, so rows with a missing or repeated id have places of their own.
    """
    counts = class_counts(df, cfg)
    if not counts:
        return df.withColumn("split", F.lit("train"))
    y = F.expr(num(df.schema, cfg.target_column))
    by_class = can_stratify(counts)
    strata = {c: Stratum(y == c, n, 0) for c, n in counts.items()}
    if not by_class:
        counts = {0.0: sum(counts.values())}
        strata = {0.0: Stratum(F.lit(True), counts[0.0], 0)}
    test = quotas(counts, cfg.test_size)
    left = {c: n - test[c] for c, n in counts.items()}
    fraction = cfg.validation_size / (1.0 - cfg.test_size)

    wanted = {f"{c:g}|test": replace(s, take=test[c]) for c, s in strata.items()}
    if not by_class or can_stratify(left):
        # Both parts follow each other in the same order.
        more = quotas(left, fraction)
        for c, s in strata.items():
            wanted[f"{c:g}|held"] = replace(s, take=test[c] + more[c])
    keyed, content = df.withColumn(_KEY, split_key(cfg)), content_key(df.columns)
    cuts = _cuts(keyed, content, wanted, direct_rows)
    if any(c.copies for c in cuts.values()):
        keyed = _numbered_copies(keyed, content, cuts.values())
    else:
        keyed = keyed.withColumn(_COPY, F.lit(0))

    def taken(part: str) -> Column:
        chosen = [F.lit(False)]
        for k, s in wanted.items():
            if k.endswith(part) and s.take > 0:
                chosen.append(s.member & (cuts[k].holds(F.col(_KEY), content) if k in cuts else F.lit(True)))
        return _any(chosen)

    in_test = taken("test")
    if any(k.endswith("held") for k in wanted):
        in_held = taken("held")
    else:
        # The rest can not be stratified: one cut through all of its rows.
        keyed = keyed.withColumn("_rest", ~in_test)
        size = sum(left.values())
        rest = Stratum(F.col("_rest"), size, math.ceil(fraction * size))
        last = _cuts(keyed, content, {"rest": rest}, direct_rows).get("rest")
        if last is not None and last.copies:
            on = last.at(F.col(_KEY), content) & F.col("_rest")
            some = keyed.where(on).withColumn("_v", content)
            number = F.row_number().over(Window.partitionBy(_KEY, "_v").orderBy(_KEY))
            keyed = keyed.where(~on).unionByName(some.withColumn(_COPY, number).drop("_v"))
            in_test = ~F.col("_rest")
        inside = last.holds(F.col(_KEY), content) if last is not None else F.lit(rest.take > 0)
        in_held = F.col("_rest") & inside
    part = F.when(in_test, "test").when(in_held, "validation").otherwise("train")
    return keyed.withColumn("split", part).select(*[quoted(c) for c in df.columns if c != "split"], "split")


def _any(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates)


def split_counts(df: DataFrame, cfg: Config) -> DataFrame:
    """(split, rows, positive_rate) of a split table, by combined partial sums."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.expr(num(df.schema, cfg.target_column))).alias("positive_rate"),
    )
