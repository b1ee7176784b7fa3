"""Global order on distributed data: ranks, running totals, order statistics.

A window without a partition key sends every row to one task. Here the order is cut
into slices at approximate quantiles. The cut points come from one narrow aggregate and
are literals afterwards, so a slice number is a pure function of the row: no sampling
twice, nothing to pin, and a recomputed task lands where it was. The number of slices
follows the row count. Totals per slice give each slice its starting offset, in two levels,
and windows run inside slices only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankwatch.functions.values import num, quoted, text

ACCURACY = 10_000
# Quantiles are estimated on about this many rows, drawn evenly. Sketches of all rows would be
# megabytes per task, and one task has to merge them all.
SAMPLE_ROWS = 1_000_000
SIGMAS = 6
# Narrowing a bracket takes a few samples; one that never succeeds has a wrong count.
MOST_TRIES = 100
# A slice is one task's work.
ROWS_PER_SLICE = 250_000
# Offsets are summed inside runs of so many slice numbers first.
SLICES_PER_BLOCK = 4096
# A value filling this many neighbouring cut points is spread over slices of its own,
# this many per cut point it fills.
HOT_RUN = 4
HOT_FAN = 16
# Up to this many distinct values of one feature may meet in one task.
DIRECT_ROWS = 1_000_000


def _col(name: str) -> Column:
    return F.col(quoted(name))


def slice_count(spark: SparkSession, rows: int) -> int:
    """Slices of a bounded size, and enough of them to keep every task busy."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(4 * parts, -(-rows // ROWS_PER_SLICE))


def _fractions(slices: int) -> list[float]:
    return [i / slices for i in range(1, slices)]


def _cut(df: DataFrame, value: str, cuts: Sequence[float], out: str) -> DataFrame:
    """Add the index of the interval [cut, next cut) a value falls in; null stays last."""
    if not cuts:
        return df.withColumn(out, F.when(_col(value).isNull(), 1.0).otherwise(0.0))
    splits = [float("-inf"), *cuts, float("inf")]
    return Bucketizer(
        splits=splits, inputCol=value, outputCol=out, handleInvalid="keep"
    ).transform(df)


@dataclass(frozen=True)
class Cuts:
    """Strictly increasing finite cut points, and the values too frequent for one slice with
    the number of cut points each fills (its share of the rows times the slice count)."""

    points: tuple[float, ...]
    hot: Mapping[float, int]

    @classmethod
    def of(cls, quantiles: Sequence[float] | None) -> "Cuts":
        runs: dict[float, int] = {}
        for q in quantiles or ():
            if q is not None and abs(q) != float("inf"):
                runs[float(q)] = runs.get(float(q), 0) + 1
        return cls(tuple(sorted(runs)), {v: n for v, n in runs.items() if n >= HOT_RUN})

    def fan_out(self, most: int) -> dict[int, list[float]]:
        """Hot values by how many slices to spread them over: a power of two near
        HOT_FAN x their cut points. All values together get at most 2 x HOT_FAN x
        (slice count) slices, which bounds the offset table."""
        out: dict[int, list[float]] = {}
        for v, n in self.hot.items():
            fan = min(most, 1 << (HOT_FAN * n).bit_length())
            out.setdefault(fan, []).append(v)
        return out


def cut_points(
    df: DataFrame,
    columns: Mapping[str, Column],
    slices: int,
    rows: int,
    sample_rows: int = SAMPLE_ROWS,
) -> dict[str, Cuts]:
    """Quantile cut points of several double columns (one narrow aggregate).

    They decide how even the slices are, never which rows are kept.
    """
    wanted = max(sample_rows, 100 * slices)
    drawn = df.sample(min(1.0, wanted / max(rows, 1)), seed=17)
    accuracy = max(ACCURACY, 8 * slices)
    row = drawn.agg(
        *[
            F.percentile_approx(c, _fractions(slices), accuracy).alias(name)
            for name, c in columns.items()
        ]
    ).first()
    return {name: Cuts.of(row[name]) for name in columns}


def _offsets(totals: DataFrame, key: str, sums: Mapping[str, str]) -> DataFrame:
    """Sums over all earlier slices, in two levels: inside blocks of neighbouring slices, and
    over the blocks. Only the block totals meet in one task: one row per SLICES_PER_BLOCK
    slices."""
    blocks = totals.withColumn("_block", F.floor(F.col(key) / SLICES_PER_BLOCK))
    inside = Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.groupBy("_block").agg(*[F.sum(c).alias(c) for c in sums.values()])
    above = sizes.select(
        "_block", *[F.coalesce(F.sum(c).over(over), F.lit(0)).alias(f"_o_{c}") for c in sums.values()]
    )
    return blocks.join(above, "_block").select(
        key,
        *[
            (F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_o_{c}")).alias(out)
            for out, c in sums.items()
        ],
    )


def _shared(a: bytes, b: bytes) -> bytes:
    n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[:n]


def _texts(values: Sequence[bytes]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<binary>")


def texts_upto(raw: Column, cuts: Sequence[bytes]) -> Column:
    """How many of the sorted `cuts` are <= a text: steps of falling powers of two."""
    if not cuts:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    known = _texts(cuts)
    # Beyond the last cut there is null, and no step is taken.
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(known, at + step - 1) <= raw, at + step).otherwise(at)
    )


def text_cuts(
    df: DataFrame, column: str, slices: int, rows: int, sample_rows: int = SAMPLE_ROWS
) -> list[bytes]:
    """Cut points of the order of texts, as the bytes of texts.

    They are quantiles of the few bytes after what all texts share. A value of these bytes
    that fills two cut points or more is a beginning of too many texts: those are cut in
    the next round by the bytes after what they share in turn, with as many cut points as the
    beginning filled. All beginnings of a round are cut together, in two passes over a sample;
    what they share grows from round to round, so the rounds end.
    """
    share = min(1.0, max(sample_rows, 100 * slices) / max(rows, 1))
    drawn = df.select(_col(column).cast("binary").alias("raw")).where("raw IS NOT NULL").sample(share, seed=17)
    begins, above, wanted = [b""], [-1], slices
    cuts: set[bytes] = set()
    while begins and wanted > 1:
        at = texts_upto(F.col("raw"), begins) - 1
        # Beginnings are few; a text belongs to the last one that is not above it, if it has it.
        begin = F.get(_texts(begins), F.greatest(at, F.lit(0)))
        held = drawn.withColumn("node", at).where((at >= 0) & F.startswith(F.col("raw"), begin))
        ends = held.groupBy("node").agg(F.min("raw").alias("a"), F.max("raw").alias("b")).collect()
        # Equal texts, or those that differ by more zero bytes, are not cut further.
        shared = {r["node"]: _shared(bytes(r["a"]), bytes(r["b"])) for r in ends if r["a"] != r["b"]}
        shared = {i: t for i, t in shared.items() if len(t) > above[i]}
        if not shared:
            break
        width = (52 - len(begins).bit_length()) // 8
        whole = 256**width
        skip = F.get(F.array(*[F.lit(len(shared.get(i, b""))) for i in range(len(begins))]), F.col("node"))
        digits = F.rpad(F.hex(F.substring("raw", skip + 1, F.lit(width))), 2 * width, "0")
        key = F.col("node") * F.lit(float(whole)) + F.conv(digits, 16, 10).cast("double")
        estimate = F.percentile_approx(key, _fractions(wanted), max(ACCURACY, 8 * wanted))
        quantiles = held.where(F.col("node").isin(list(shared))).agg(estimate).first()[0]
        runs = Counter(quantiles)

        of = {}
        for point in runs:
            node, rest = divmod(int(point), whole)
            of[point] = (shared[node] + rest.to_bytes(width, "big")).rstrip(b"\0")
        cuts.update(of.values())
        grown = {of[v]: (n, len(shared[int(v) // whole])) for v, n in runs.items() if n > 1}
        begins = sorted(grown)
        above = [grown[b][1] for b in begins]
        wanted = 1 + sum(grown[b][0] for b in begins)
    return sorted(cuts)


def global_rank(
    df: DataFrame, score: str, tie: str, rank: str, slices: int | None = None
) -> DataFrame:
    """Number rows 1..N by `score` descending (missing last), then `tie` ascending.

    Equal to an unpartitioned `row_number()`, with one shuffle of the rows and no task
    larger than a slice. A score shared by many rows is split further by quantiles of the
    tie column, which any subset of the rows must spread over.
    """
    rows = df.count()
    slices = slices or slice_count(df.sparkSession, rows)
    keyed = df.withColumn("_score", F.expr(num(df.schema, score)))
    # Slices follow the order of the tie column itself, whatever its type.
    if isinstance(df.schema[tie].dataType, T.StringType):
        cuts = cut_points(keyed, {"_score": F.col("_score")}, slices, rows)
        tie_points = text_cuts(df, tie, slices, rows)
        slot = F.when(_col(tie).isNotNull(), texts_upto(_col(tie).cast("binary"), tie_points))
        keyed = keyed.withColumn("_tie_cut", slot.cast("double"))
    else:
        keyed = keyed.withColumn("_tie", _col(tie).cast("double"))
        cuts = cut_points(keyed, {"_score": F.col("_score"), "_tie": F.col("_tie")}, slices, rows)
        tie_points = cuts["_tie"].points
        keyed = _cut(keyed, "_tie", tie_points, "_tie_cut")
    tie_slots = len(tie_points) + 1
    points = cuts["_score"].points
    keyed = _cut(keyed, "_score", points, "_cut")
    # Within [cut, next) descending, a hot cut value itself comes after everything above it,
    # so its rows get the later sub-slices, in order of the tie column. Nothing is known about
    # the share of missing scores: they are spread as widely as possible.
    fan = F.when(F.col("_score").isNull(), tie_slots)
    for width, values in sorted(cuts["_score"].fan_out(tie_slots).items()):
        fan = fan.when(F.col("_score").isin(*values), width)
    slot = F.coalesce(F.col("_tie_cut"), F.lit(tie_slots)).cast("long")
    sub_slice = F.coalesce(1 + F.floor(slot * fan / F.lit(tie_slots)), F.lit(0))
    main_slice = F.when(F.col("_score").isNull(), len(points) + 1).otherwise(
        len(points) - F.col("_cut")
    )
    keyed = keyed.withColumn(
        "_slice", main_slice.cast("long") * F.lit(tie_slots + 3) + sub_slice
    )
    totals = keyed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _offsets(totals, "_slice", {"_before": "_n"})

    inside = Window.partitionBy("_slice").orderBy(
        F.col("_score").desc_nulls_last(), _col(tie).asc_nulls_last()
    )
    return (
        keyed.join(offsets, "_slice", "left")
        .withColumn(rank, F.col("_before") + F.row_number().over(inside).cast("long"))
        .select(*[_col(c) for c in df.columns if c != rank], rank)
    )


def running_totals(
    df: DataFrame,
    key: str,
    sums: Mapping[str, str],
    source: DataFrame,
    slices: int | None = None,
) -> DataFrame:
    """Add inclusive running sums over `key` descending; `key` must be unique and non-null.

    Callers aggregate by the key first, so a frequent key is a single row here. `source` is
    the table before that step: cut points are taken from it, without a shuffle, and a slice
    has no more distinct keys than it has rows.
    """
    rows = source.count()
    slices = slices or slice_count(df.sparkSession, rows)
    points = cut_points(source, {key: _col(key).cast("double")}, slices, rows)[key].points
    cut = _cut(df.withColumn("_key", _col(key).cast("double")), "_key", points, "_cut")
    cut = cut.withColumn("_slice", (len(points) - F.col("_cut")).cast("long"))
    totals = cut.groupBy("_slice").agg(
        *[F.sum(_col(c)).alias(f"_t_{out}") for out, c in sums.items()]
    )
    offsets = _offsets(totals, "_slice", {f"_b_{out}": f"_t_{out}" for out in sums})
    inside = (
        Window.partitionBy("_slice")
        .orderBy(F.col("_key").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        cut.join(offsets, "_slice", "left")
        .withColumns(
            {out: F.col(f"_b_{out}") + F.sum(_col(c)).over(inside) for out, c in sums.items()}
        )
        .select(*[_col(c) for c in df.columns], *sums)
    )


@dataclass(frozen=True)
class Target:
    """Which sorted positions (0-based, inclusive) of which values are wanted."""

    value: Column
    low: int
    high: int
    count: int


@dataclass(frozen=True)
class Found:
    """Values at the wanted positions and how many values are <= the higher one."""

    low: float
    high: float
    upto: int


@dataclass
class Bracket:
    """A value range known to hold the wanted positions of one target.

    An end that is left out (`open_`) has been counted: its rows are in `below`, or beyond. A
    wanted position that lies in such an end is answered at once (`known_`), so a value with very
    many rows never keeps the range wide."""

    low: float
    high: float
    below: int
    inside: int
    want_low: int
    want_high: int
    open_low: bool = False
    open_high: bool = False
    known_low: float | None = None
    known_high: float | None = None
    upto: int = 0
    slack: float = 1.0
    tries: int = 0

    def holds(self, v: Column) -> Column:
        return (v > self.low if self.open_low else v >= self.low) & (v < self.high if self.open_high else v <= self.high)

    @property
    def settled(self) -> bool:
        """Nothing is left to be ordered: one value, or every position is answered."""
        return self.low == self.high or (self.known_low is not None and self.known_high is not None)

    def shrink(self, at_low: int, at_high: int) -> None:
        """Take the rows at the ends out, given how many there are."""
        if self.low == self.high:
            return
        past_low, first_high = self.below + at_low, self.below + self.inside - at_high
        if self.want_high < past_low:
            self.high, self.inside, self.open_low, self.open_high = self.low, at_low, False, False
            return
        if self.want_low >= first_high:
            self.low, self.below, self.inside, self.open_low, self.open_high = self.high, first_high, at_high, False, False
            return
        if self.want_high >= first_high:
            self.known_high, self.upto = self.high, self.below + self.inside
        if self.want_low < past_low:
            self.known_low = self.low
        if self.known_low is not None and self.known_high is not None:
            return
        # The position that is left stands for both.
        if self.known_low is not None:
            self.want_low = self.want_high
        if self.known_high is not None:
            self.want_high = self.want_low
        self.below, self.inside = past_low, first_high - past_low
        self.open_low, self.open_high = self.open_low or at_low > 0, self.open_high or at_high > 0

    def found(self, low: float, high: float, last: int) -> Found:
        """The answer, given the values at the positions left and the last row of the higher."""
        return Found(
            low if self.known_low is None else self.known_low,
            high if self.known_high is None else self.known_high,
            self.below + last + 1 if self.known_high is None else self.upto,
        )


def _narrow(
    df: DataFrame,
    targets: Mapping[str, Target],
    brackets: Mapping[str, Bracket],
    round_: int,
    sample_rows: int,
) -> None:
    """Shrink the given brackets once: estimate on a sample, count, accept what is proven."""
    samples, estimates, whole = [], [], {}
    for n, k in brackets.items():
        k.tries += 1
        if k.tries > MOST_TRIES:
            raise ValueError(f"{n}: the number of values given is not the number found")
        f1, f2 = (k.want_low - k.below) / k.inside, (k.want_high - k.below + 1) / k.inside
        drawn = min(1.0, sample_rows / k.inside)
        # Quantiles of all rows have no sampling error.
        chance = SIGMAS * (0.25 / (drawn * k.inside)) ** 0.5 if drawn < 1 else 0.0
        noise = k.slack * (chance + 2 / ACCURACY)
        chosen = k.holds(targets[n].value)
        if drawn < 1:
            chosen = chosen & (F.rand(round_) < drawn)
        ends = [max(0.0, f1 - noise), min(1.0, f2 + noise)]
        whole[n] = (ends[0] == 0.0, ends[1] == 1.0)
        samples.append(F.when(chosen, targets[n].value).alias(n))
        estimates.append(F.percentile_approx(_col(n), ends, ACCURACY).alias(n))
    found = df.select(*samples).agg(*estimates).first()
    # An end of the sample says nothing about the end of the bracket: that stays.
    trial = {}
    for n, k in brackets.items():
        if found[n] is not None:
            low, high = (k.low, k.open_low) if whole[n][0] else (found[n][0], False), (
                (k.high, k.open_high) if whole[n][1] else (found[n][1], False)
            )
            trial[n] = replace(k, low=low[0], open_low=low[1], high=high[0], open_high=high[1])
    aggs = []
    for n, t in trial.items():
        v = targets[n].value
        aggs += [
            F.count_if((v <= t.low) if t.open_low else (v < t.low)).alias(f"{n}|below"),
            F.count_if(t.holds(v)).alias(f"{n}|in"),
            F.count_if((v == t.low) & F.lit(not t.open_low)).alias(f"{n}|low"),
            F.count_if((v == t.high) & F.lit(not t.open_high)).alias(f"{n}|high"),
        ]
    counts = df.agg(F.lit(0), *aggs).first()
    for n, k in brackets.items():
        t = trial.get(n)
        if t is None:
            k.slack *= 2
            continue
        t.below, t.inside = counts[f"{n}|below"], counts[f"{n}|in"]
        if not t.below <= k.want_low <= k.want_high < t.below + t.inside:
            k.slack *= 2  # an unlucky sample; the old bracket stands
            continue
        k.low, k.high, k.open_low, k.open_high = t.low, t.high, t.open_low, t.open_high
        k.below, k.inside, k.slack = t.below, t.inside, 1.0
        k.shrink(counts[f"{n}|low"], counts[f"{n}|high"])


def order_statistics(
    df: DataFrame,
    targets: Mapping[str, Target],
    direct_rows: int = DIRECT_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> dict[str, Found]:
    """Exact values at sorted positions, for several expressions at once.

    Each target keeps a bracket known to hold its positions. It is narrowed by quantiles of a
    sample (two narrow passes for all targets; the new bracket is counted on all rows before
    it is believed), again while it holds more than `direct_rows` values. Values at its ends are
    counted and left out, so what is ordered at the end is bounded by rows whatever the values:
    only values inside brackets are grouped and ordered. No task ever holds a whole column. A
    wrong `count` is an error.
    """
    open_ = {n: t for n, t in targets.items() if t.count > 0}
    if not open_:
        return {}
    brackets = {
        n: Bracket(float("-inf"), float("inf"), 0, t.count, t.low, t.high) for n, t in open_.items()
    }
    round_ = 0
    # Every bracket is narrowed once at least, so what is ordered at the end is a few values.
    while wide := {
        n: k
        for n, k in brackets.items()
        if not k.settled and (k.tries == 0 or k.inside > direct_rows)
    }:
        round_ += 1
        _narrow(df, open_, wide, round_, sample_rows)

    out = {
        n: k.found(k.low, k.high, k.inside - 1) for n, k in brackets.items() if k.settled
    }
    left = {n: brackets[n] for n in open_ if n not in out}
    if not left:
        return out
    entries = [
        F.struct(
            F.lit(n).alias("name"),
            F.when(k.holds(open_[n].value), open_[n].value).alias("value"),
        )
        for n, k in left.items()
    ]
    near = reduce(lambda a, b: a | b, (k.holds(open_[n].value) for n, k in left.items()))
    grouped = (
        df.where(near)
        .select(F.inline(F.array(*entries)))
        .where("value IS NOT NULL")
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy("name").orderBy("value")
    located = grouped.withColumn(
        "last", F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, 0)) - 1
    )
    covers = " OR ".join(
        f"(name = {text(n)} AND last >= {k.want_low - k.below} AND last - n < {k.want_high - k.below})"
        for n, k in left.items()
    )
    # At most two values per target reach the driver.
    found = (
        located.where(covers)
        .groupBy("name")
        .agg(F.min("value").alias("a"), F.max("value").alias("b"), F.max("last").alias("last"))
        .collect()
    )
    return out | {r["name"]: left[r["name"]].found(r["a"], r["b"], r["last"]) for r in found}


def medians(
    df: DataFrame,
    values: Mapping[str, Column],
    counts: Mapping[str, int],
    direct_rows: int = DIRECT_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> dict[str, float | None]:
    """Exact interpolated medians; `counts` are the non-null counts of the values."""
    targets = {
        n: Target(v, (counts[n] - 1) // 2, counts[n] // 2, counts[n]) for n, v in values.items()
    }
    found = order_statistics(df, targets, direct_rows, sample_rows)
    return {n: ((found[n].low + found[n].high) / 2 if n in found else None) for n in values}
