"""Row-count windows over ordered series: rolling statistics, lags, EMA, trend.

A long frame is put together from shorter ones.  The statistics of 168 rows are
the merged statistics of seven adjacent 24-row frames, which are already known
for every row, so they cost seven ``lag`` reads instead of 168 updates.  The
same holds for the exponential average, where each row is an affine step
``y = p * y_previous + q`` and adjacent steps compose, as far back as the series
goes.  A cut series is composed in blocks of positions, whose composites are
composed in turn.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from airloom.operators.cuts import OWN, ROWS_PER_CUT, Arranged, allow_group_limit, arrange
from airloom.session import materialise

# Window and lag lengths in rows, named "h" on the hourly grid.
DAY_WINDOWS = (1, 3, 6, 12, 24)
WEEK_WINDOWS = (48, 72, 120, 168)
ROLLING_WINDOWS = DAY_WINDOWS + WEEK_WINDOWS
LONG_WINDOWS = (720, 2160)
LAGS = (1, 2, 3, 6, 12, 24, 48, 72, 168)
EMA_SPANS = (24, 168)
ROLLING_STATS = ("mean", "std", "min", "max", "range")

# A frame is built from at most this many shorter ones where the sizes allow.
MAX_PARTS = 8
# Rows of a cut series whose steps are composed before their blocks are.
EMA_BLOCK = MAX_PARTS**4


def composition(sizes: Iterable[int]) -> dict[int, tuple[int, ...]]:
    """For every frame size the adjacent shorter frames (1 = the row itself) it is built from.

    Helper sizes are put in where a size has no divisor near enough; a size without divisors,
    such as a large prime, is seven frames of a helper size and one of the rest.
    """
    built: dict[int, tuple[int, ...]] = {}

    def place(size: int) -> None:
        if size in built or size == 1:
            return
        divisors = [1, *(s for s in built if size % s == 0)]
        few = [d for d in divisors if size // d <= MAX_PARTS]
        if few:
            built[size] = (min(few),) * (size // min(few))
            return
        unit = max(divisors)
        steps = [f for f in range(MAX_PARTS, 1, -1) if (size // unit) % f == 0]
        if steps:
            built[unit * steps[0]] = (unit,) * steps[0]
            place(size)
            return
        part, rest = divmod(size, MAX_PARTS - 1)
        place(part)
        if rest:
            place(rest)
        built[size] = (part,) * (MAX_PARTS - 1) + ((rest,) if rest else ())

    for size in sorted(set(sizes) - {1}):
        place(size)
    return built


def _places(parts: Sequence[int]) -> list[tuple[int, int]]:
    """(frame size, how many rows back it ends) of adjacent frames, the newest first."""
    ends = [sum(parts[:i]) for i in range(len(parts))]
    return list(zip(parts, ends))


def _levels(built: dict[int, tuple[int, ...]]) -> list[list[int]]:
    depth = {1: 0}
    for size in sorted(built):  # a frame is longer than those it is built from
        depth[size] = 1 + max(depth[part] for part in built[size])
    deepest = max(depth.values())
    return [[s for s in built if depth[s] == d] for d in range(1, deepest + 1)]


def _merge(size: int, parts: Sequence[int], spread: bool, extremes: bool) -> tuple[list, list]:
    """SQL for the statistics of ``size`` rows out of those of adjacent shorter frames.

    ``n`` counts values, ``m`` is their mean and ``q`` the squared deviations from
    it; merging means and deviations keeps every digit where sums of squares
    would cancel.  ``q`` needs the merged mean, hence the second list.
    """
    part = {f: [f"_{f}_{u}_{o}" if o else f"_{f}_{u}" for u, o in _places(parts)]
            for f in ("n", "m", "q", "lo", "hi")}
    pairs = list(zip(part["n"], part["m"]))
    n = " + ".join(part["n"])
    m = " + ".join(f"{a} * {b}" for a, b in pairs)
    first = [f"{n} AS _n_{size}", f"coalesce(try_divide({m}, {n}), 0D) AS _m_{size}"]
    if extremes:
        first.append(f"least({', '.join(part['lo'])}) AS _lo_{size}")
        first.append(f"greatest({', '.join(part['hi'])}) AS _hi_{size}")
    second = []
    if spread:
        off = [f"{a} * ({b} - _m_{size}) * ({b} - _m_{size})" for a, b in pairs]
        second.append(f"{' + '.join(part['q'] + off)} AS _q_{size}")
    return first, second


def _framed(
    rows: DataFrame, arranged: Arranged, column: str, sizes: Sequence[int],
    spread: bool, extremes: bool, means: Sequence[int] = (),
) -> DataFrame:
    """Add the statistics of every frame size; for ``means`` sizes only the mean."""
    w = arranged.window()
    x = f"CAST(`{column}` AS DOUBLE)"
    single = [
        f"IF({x} IS NULL, 0D, 1D) AS _n_1", f"coalesce({x}, 0D) AS _m_1",
        *(["0D AS _q_1"] if spread else []),
        *([f"{x} AS _lo_1", f"{x} AS _hi_1"] if extremes else []),
    ]
    fields = ["n", "m", *(["q"] if spread else []), *(["lo", "hi"] if extremes else [])]
    rows = rows.selectExpr("*", *single)
    full = composition(sizes)
    built = composition([*sizes, *means]) | full
    for level in _levels(built):
        reads = {(u, o) for s in level for u, o in _places(built[s]) if o}
        whole = {(u, o) for s in level if s in full for u, o in _places(full[s]) if o}
        kept = rows.columns
        rows = rows.select(
            "*",
            *[
                F.lag(f"_{f}_{unit}", offset, None if f in ("lo", "hi") else 0.0)
                .over(w)
                .alias(f"_{f}_{unit}_{offset}")
                for unit, offset in sorted(reads)
                for f in fields
                if (f in ("n", "m") or (unit, offset) in whole)
                # A single row deviates by nothing.
                and not (f == "q" and unit == 1)
            ],
        )
        if spread and any(unit == 1 for unit, _ in reads):
            rows = rows.selectExpr(
                "*", *[f"0D AS _q_1_{o}" for unit, o in sorted(reads) if unit == 1]
            )
        firsts, seconds = [], []
        for size in level:
            more = size in full
            first, second = _merge(size, built[size], spread and more, extremes and more)
            firsts += first
            seconds += second
        rows = rows.selectExpr("*", *firsts)
        rows = rows.selectExpr(*kept, *[f.split(" AS ")[-1] for f in firsts], *seconds)
    return rows


def _statistic(size: int, stat: str) -> str:
    if stat == "mean":
        return f"IF(_n_{size} > 0, _m_{size}, NULL)"
    if stat == "std":
        return f"IF(_n_{size} > 1, sqrt(_q_{size} / (_n_{size} - 1)), NULL)"
    if stat == "min":
        return f"_lo_{size}"
    if stat == "max":
        return f"_hi_{size}"
    if stat == "range":
        return f"_hi_{size} - _lo_{size}"
    raise ValueError(f"unknown rolling statistic {stat!r}")


def rolling(
    df: DataFrame,
    column: str,
    keys: Sequence[str],
    order: Sequence[str],
    sizes: Sequence[int] = ROLLING_WINDOWS,
    stats: Sequence[str] = ROLLING_STATS,
    prefix: str | None = None,
    name: str = "{prefix}_rolling_{stat}_{size}h",
    offset: int = 0,
    rows_per_cut: int = ROWS_PER_CUT,
    longest: int | None = None,
) -> DataFrame:
    """Rolling statistics of the last ``size`` rows; missing values are skipped.

    ``offset=1`` ends every frame on the previous row.
    """
    arranged = arrange(df, keys, order, rows_per_cut, longest)
    rows = arranged.extend(before=max(sizes) - 1 + offset)
    rows = add_rolling(rows, arranged, column, sizes, stats, prefix, name, offset)
    return rows.filter(OWN).drop(OWN, "_cut")


def add_rolling(
    rows: DataFrame, arranged: Arranged, column: str,
    sizes: Sequence[int] = ROLLING_WINDOWS, stats: Sequence[str] = ROLLING_STATS,
    prefix: str | None = None, name: str = "{prefix}_rolling_{stat}_{size}h",
    offset: int = 0, long_sizes: Sequence[int] = (),
) -> DataFrame:
    """As ``rolling``, on rows that are already arranged and extended.

    ``long_sizes`` adds plain means, built on the same shorter frames.
    """
    kept = [f"`{c}`" for c in rows.columns]
    rows, source = _shifted(rows, arranged, column, offset)
    rows = _framed(
        rows, arranged, source, sizes, "std" in stats,
        bool({"min", "max", "range"} & set(stats)), long_sizes,
    )
    return rows.selectExpr(
        *kept,
        *[f"{_statistic(s, 'mean')} AS rolling_mean_{s}h" for s in long_sizes],
        *[
            f"{_statistic(size, stat)} AS `"
            + name.format(prefix=prefix or column, stat=stat, size=size)
            + "`"
            for size in sizes
            for stat in stats
        ],
    )


def _shifted(
    rows: DataFrame, arranged: Arranged, column: str, offset: int
) -> tuple[DataFrame, str]:
    if not offset:
        return rows, column
    return rows.withColumn("_x", F.lag(column, offset).over(arranged.window())), "_x"


def long_rolling(
    df: DataFrame, column: str, keys: Sequence[str], order: Sequence[str],
    sizes: Sequence[int] = LONG_WINDOWS,
    rows_per_cut: int = ROWS_PER_CUT, longest: int | None = None,
) -> DataFrame:
    """Rolling means of the last 720 and 2160 rows."""
    arranged = arrange(df, keys, order, rows_per_cut, longest)
    rows = arranged.extend(before=max(sizes) - 1)
    rows = add_rolling(rows, arranged, column, ROLLING_WINDOWS, (), long_sizes=sizes)
    return rows.filter(OWN).drop(OWN, "_cut")


def lag_columns(
    arranged: Arranged, columns: Sequence[str], lags: Sequence[int] = LAGS
) -> list[Column]:
    w = arranged.window()
    return [
        F.lag(c, k).over(w).alias(f"{c}_lag_{k}h") for k in lags for c in columns
    ]


def lags(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], order: Sequence[str],
    lags: Sequence[int] = LAGS,
    rows_per_cut: int = ROWS_PER_CUT, longest: int | None = None,
) -> DataFrame:
    """Values of earlier rows; a missing value counts as a row."""
    arranged = arrange(df, keys, order, rows_per_cut, longest)
    rows = arranged.extend(before=max(lags))
    return (
        rows.select("*", *lag_columns(arranged, columns, lags))
        .filter(OWN)
        .drop(OWN, "_cut")
    )


def change_columns(arranged: Arranged, column: str, offset: int = 0) -> list[Column]:
    """Differences to the row before and to the row a day before."""
    w = arranged.window()
    now = F.lag(column, offset).over(w) if offset else F.col(column)
    hour = now - F.lag(column, 1 + offset).over(w)
    day = now - F.lag(column, 24 + offset).over(w)
    return [
        hour.alias(f"{column}_change_1h"),
        day.alias(f"{column}_change_24h"),
        day.alias(f"{column}_diff_24h"),
    ]


def change_rate(
    df: DataFrame, column: str, keys: Sequence[str], order: Sequence[str],
    rows_per_cut: int = ROWS_PER_CUT, longest: int | None = None,
) -> DataFrame:
    arranged = arrange(df, keys, order, rows_per_cut, longest)
    rows = arranged.extend(before=24)
    return (
        rows.select("*", *change_columns(arranged, column)).filter(OWN).drop(OWN, "_cut")
    )


def ema(
    df: DataFrame, column: str, keys: Sequence[str], order: Sequence[str],
    spans: Sequence[int] = EMA_SPANS,
    rows_per_cut: int = ROWS_PER_CUT, longest: int | None = None, carry: DataFrame | None = None,
) -> DataFrame:
    """Exponential average, recursive form, alpha = 2 / (span + 1).

    Every earlier observation counts.  Over missing values the last average
    stands and the next observation's weight grows with the gap; before the
    first value the average is missing.

    ``carry`` goes on where earlier rows ended: per series (``keys``) the average of each
    span, ``mean_<span>``, and ``gap``, the rows from the last observation to the first row here.
    """
    if carry is not None:
        states = carry.select(
            *keys, F.col("gap").alias("_carry_gap"), *[F.col(f"mean_{s}").alias(f"_carry_{s}") for s in spans]
        )
        df = df.join(states, list(keys), "left") if keys else df.crossJoin(F.broadcast(states))
    arranged = arrange(df, keys, order, rows_per_cut, longest).position("_pos")
    out = add_ema(arranged, column, spans, carried=carry is not None).rows
    return out.drop("_cut", "_pos", *([] if carry is None else states.drop(*keys).columns))


def add_ema(
    arranged: Arranged, column: str, spans: Sequence[int] = EMA_SPANS,
    block: int = EMA_BLOCK, carried: bool = False,
) -> Arranged:
    """EMA columns on arranged rows that have ``_pos`` and, if ``carried``, the carry's columns."""
    kept = arranged.rows.columns
    names = {span: f"{column}_ema_{span}h" for span in spans}
    rows = arranged.rows.selectExpr(
        "*", f"CAST(`{column}` AS DOUBLE) AS _x", f"`{column}` IS NULL AS _gone",
        f"_pos div {block} AS _block",
    )
    # Missing rows form a partition of their own, so lags see observations only.
    if arranged.cuts <= 1:
        starts = {span: _start("_pos", span, carried) for span in spans}
        rows = _composed(rows, arranged.window("_gone"), spans, arranged.longest, starts)
        average = {span: F.col(f"_q_{span}") for span in spans}
    else:
        seen = Window.partitionBy(*arranged.keys, "_block", "_gone").orderBy("_pos")
        rows = _composed(rows, seen, spans, block, None)
        rows = _with_block_starts(rows, arranged, spans, block, carried)
        average = {
            s: F.col(f"_p_{s}") * F.col(f"_start_{s}") + F.col(f"_q_{s}") for s in spans
        }
    rows = rows.withColumns({f"_y_{s}": F.when(~F.col("_gone"), average[s]) for s in spans})
    out = arranged.replace(rows.select(*kept, *[f"_y_{s}" for s in spans]))
    if arranged.cuts > 1:
        out = out.replace(materialise(out.rows, "ema"))
    for span in spans:
        out = out.last_known(f"_y_{span}", names[span])
    shown = [
        F.coalesce(names[s], f"_carry_{s}").alias(names[s]) if carried else F.col(names[s]) for s in spans
    ]
    return out.replace(out.rows.select(*kept, *shown))


def _start(position: str, span: int, carried: bool) -> str:
    """SQL for the average at a series' first observation."""
    if not carried:
        return "_x"
    p, q = _step("_x", f"(_carry_gap + {position})", span)
    return f"IF(_carry_{span} IS NULL, _x, {p} * _carry_{span} + {q})"


def day_states(
    averaged: DataFrame, column: str, keys: Sequence[str], time: str,
    spans: Sequence[int] = EMA_SPANS, carry: DataFrame | None = None,
) -> DataFrame:
    """What each day leaves behind of each series: keys, event_date, ``time`` of its last row,
    ``n`` rows, ``gap`` and ``mean_<span>``; ``averaged`` are rows with their averages, and
    ``carry`` is what they were computed from.
    """
    keys, c = list(keys), F.col
    in_day = Window.partitionBy(*keys, "event_date").orderBy(time)
    days = (
        averaged.withColumn("event_date", F.to_date(time)).withColumn("_nth", F.row_number().over(in_day))
        .groupBy(*keys, "event_date").agg(
            F.max(time).alias(time), F.count(F.lit(1)).alias("n"),
            F.max(F.when(c(column).isNotNull(), c("_nth"))).alias("_seen"),
            *[F.max_by(f"{column}_ema_{s}h", time).alias(f"mean_{s}") for s in spans],
        )
    )
    if carry is None:
        days = days.withColumn("_carry_gap", F.lit(None).cast("long"))
    else:
        days = days.join(carry.select(*keys, c("gap").alias("_carry_gap")), keys, "left")
    by_day = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("event_date").rowsBetween(Window.unboundedPreceding, 0)
    so_far = F.sum("n").over(by_day)
    days = days.withColumn("_rows", so_far).withColumn(
        "_last_seen", F.last(c("_rows") - c("n") + c("_seen"), ignorenulls=True).over(by_day)
    )
    gap = F.when(c("_last_seen").isNotNull(), c("_rows") - c("_last_seen") + 1).otherwise(c("_carry_gap") + c("_rows"))
    return days.select(*keys, "event_date", time, "n", gap.alias("gap"), *[f"mean_{s}" for s in spans])


def _step(x: str, gap: str, span: int) -> tuple[str, str]:
    """SQL for the affine step of an observation ``gap`` rows after the last one."""
    alpha = 2.0 / (span + 1.0)
    faded = f"power({1.0 - alpha!r}D, {gap})"
    return f"{faded} / ({faded} + {alpha!r}D)", f"{alpha!r}D * {x} / ({faded} + {alpha!r}D)"


def _composed(
    rows: DataFrame, w: WindowSpec, spans: Sequence[int], length: int, first: dict[int, str] | None
) -> DataFrame:
    """Adds ``_p`` and ``_q`` per span: all steps of the window up to each row.

    The first row sets the average to ``first``, or leaves it where that is None.
    """
    rows = rows.withColumn("_gap", F.col("_pos") - F.lag("_pos").over(w))
    steps = []
    for span in spans:
        p, q = _step("_x", "_gap", span)
        start = ("1D", "0D") if first is None else ("0D", first[span])
        steps.append(f"IF(_gap IS NULL, {start[0]}, {p}) AS _p_{span}")
        steps.append(f"IF(_gap IS NULL, {start[1]}, {q}) AS _q_{span}")
    return _doubled(rows.selectExpr("*", *steps), w, spans, length)


def _doubled(rows: DataFrame, w: WindowSpec, spans: Sequence[int], length: int) -> DataFrame:
    """Steps ``_p`` and ``_q`` composed with those of all earlier rows of the window."""
    unit = 1
    while unit < length:
        columns = [f"`{c}`" for c in rows.columns]
        rows = rows.select(
            "*",
            *[
                F.lag(f"_{f}_{span}", i * unit, 1.0 if f == "p" else 0.0)
                .over(w)
                .alias(f"_{f}_{span}_{i}")
                for span in spans
                for i in range(1, MAX_PARTS)
                for f in ("p", "q")
            ],
        )
        replaced = {f"`_{f}_{span}`" for span in spans for f in ("p", "q")}
        rows = rows.selectExpr(
            *[c for c in columns if c not in replaced],
            *[text for span in spans for text in _compose(span)],
        )
        unit *= MAX_PARTS
    return rows


def _with_block_starts(
    rows: DataFrame, arranged: Arranged, spans: Sequence[int], block: int, carried: bool = False
) -> DataFrame:
    """Adds ``_start``: the average at the first observation of each row's block.

    One row per block and series carries the composite of its observations.
    """
    keys = list(arranged.keys)
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_block")
    blocks = rows.filter("NOT _gone").groupBy(*keys, "_block").agg(
        F.min("_pos").alias("_first"), F.min_by("_x", "_pos").alias("_x"),
        F.max("_pos").alias("_last"),
        # The carry is the same in all rows of a series.
        *[F.max(x).alias(x) for x in (["_carry_gap", *[f"_carry_{s}" for s in spans]] if carried else [])],
        *[F.max_by(f"_{f}_{s}", "_pos").alias(f"_{f}_{s}") for s in spans for f in ("p", "q")],
    ).withColumn("_gap", F.col("_first") - F.lag("_last").over(w))
    for s in spans:
        p, q = _step("_x", "_gap", s)
        blocks = blocks.selectExpr(
            "*", f"IF(_gap IS NULL, 0D, {p}) AS _a_{s}", f"IF(_gap IS NULL, {_start('_first', s, carried)}, {q}) AS _b_{s}"
        ).withColumns({
            f"_p_{s}": F.expr(f"_p_{s} * _a_{s}"), f"_q_{s}": F.expr(f"_q_{s} + _p_{s} * _b_{s}"),
        })
    blocks = _doubled(blocks, w, spans, -(-arranged.longest // block))
    starts = blocks.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_block").alias("_of_block"),
        *[
            (F.col(f"_a_{s}") * F.lag(f"_q_{s}", 1, 0.0).over(w) + F.col(f"_b_{s}"))
            .alias(f"_start_{s}")
            for s in spans
        ],
    )
    same = F.col("_block") == F.col("_of_block")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return rows.join(starts, same, "left")


def _compose(span: int) -> list[str]:
    """SQL for ``MAX_PARTS`` adjacent affine steps applied one after the other."""
    p, q = f"_p_{span}_{MAX_PARTS - 1}", f"_q_{span}_{MAX_PARTS - 1}"
    for i in reversed(range(1, MAX_PARTS - 1)):
        p, q = f"_p_{span}_{i} * {p}", f"_q_{span}_{i} + _p_{span}_{i} * ({q})"
    return [
        f"_p_{span} * {p} AS _p_{span}", f"_q_{span} + _p_{span} * ({q}) AS _q_{span}"
    ]


def centred_trend(column: Column | str, arranged: Arranged, period: int = 24) -> Column:
    """Centred moving average over one period, half weight on both end rows."""
    w = arranged.window()
    half = period // 2
    x = F.col(column) if isinstance(column, str) else column
    if period % 2:
        frame = w.rowsBetween(-half, half)
        total, width = F.sum(x).over(frame), period
    else:
        frame = w.rowsBetween(-(half - 1), half - 1)
        total = (
            F.sum(x).over(frame)
            + 0.5 * F.lag(x, half).over(w)
            + 0.5 * F.lead(x, half).over(w)
        )
        width = period
    whole = F.lag(x, half).over(w).isNotNull() & F.lead(x, half).over(w).isNotNull()
    return F.when(whole, total / width)


def trend(
    df: DataFrame, column: str, keys: Sequence[str], order: Sequence[str],
    period: int = 24, name: str = "trend",
    rows_per_cut: int = ROWS_PER_CUT, longest: int | None = None,
) -> DataFrame:
    arranged = arrange(df, keys, order, rows_per_cut, longest)
    rows = arranged.extend(before=period // 2, after=period // 2)
    return (
        rows.withColumn(name, centred_trend(column, arranged, period))
        .filter(OWN)
        .drop(OWN, "_cut")
    )


def with_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position",
    rows_per_cut: int = ROWS_PER_CUT, longest: int | None = None,
) -> DataFrame:
    """0-based row position per series, or over the whole table with no keys."""
    return arrange(df, keys, order, rows_per_cut, longest).position(name).rows.drop("_cut")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per series: one value per key and task reaches the shuffle."""
    payload = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*payload), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


MERGE_GROUPS = 256


def newest_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], count: int
) -> DataFrame:
    """The ``count`` newest rows of every series.

    Each task keeps at most ``count`` rows of a series.  They are merged in two
    steps, so that not every task's rows of one series meet in a single task.
    """
    allow_group_limit(df.sparkSession, count)
    newest_first = [F.col(c).desc() for c in order]
    task = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    out = df.withColumn("_task", task)
    for group in ([*keys, "_task"], list(keys)):
        w = Window.partitionBy(*(group or [F.lit(0)])).orderBy(*newest_first)
        out = (
            out.withColumn("_rank", F.row_number().over(w))
            .filter(F.col("_rank") <= count)
            .drop("_rank")
        )
    return out.drop("_task")
