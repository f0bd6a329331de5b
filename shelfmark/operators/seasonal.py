"""The additive seasonal model (F3) fitted with array expressions.

For given smoothing parameters (a, b, g) the one-step errors are an affine
function of the start state: with level l, trend d and the ring of seasonals s,

    e = y - l - d - s0,   l += d + a e,   d += a b e,   s0 += g (1 - a) e.

The recursion is the same in every month, so the response of the errors to the
seasonal of month i is the response to the first one, i months later; level and
seasonals could trade a constant, so the level starts at 0.  One pass forward
gives three errors a month (first seasonal, trend, data), one pass of the adjoint
recursion backward their products with every column, that is the normal matrix.
Eliminating the unknowns from its upper triangle leaves the squared error;
substituting back gives the start state.

The parameters are whole 1/10,000s from a grid with two finer rounds around the
winner; sets that cannot differ are tried once (without level updates the trend
is never updated, with full ones the seasonals are not).  Squared errors of the
series divided by its largest value are rounded to 12 digits, equal ones go to
the smallest parameters.  A row is one series and one level parameter, the
other two are searched inside the row: series and parameters spread over all
tasks, and a row holds one short array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = 10_000
GRID = (0, 500, 1000, 2000, 3000, 5000, 7000, 9000)
STEPS = (500, 125)
SSE_DIGITS = 12
PIVOT = 1e-9


def _doubles(values) -> str:
    return f"array({', '.join(f'{float(v)}D' for v in values)})"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``value`` evaluated once under a name (an array of one element)."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _dot(x: str, y: str) -> str:
    return f"aggregate(zip_with({x}, {y}, (p, q) -> p * q), 0D, (p, q) -> p + q)"


def _normal(y: str, a: str, b: str, g: str, period: int) -> str:
    """Upper triangle of the normal matrix of series ``y`` (SQL text), rows
    from the diagonal on: seasonals, trend, data.  A fold copies its state at
    every step, so rings and errors are flat (three numbers a month) and errors
    are gathered season by season."""
    last = period - 1
    zero, zeros = _doubles([0] * 3), _doubles([0] * 3 * period)
    forward = _let("e", "transform(st.l, (x, j) -> if(j = 2, v, 0D) - x - st.d[j] - st.s[j])", f"""named_struct(
        'l', transform(e, (x, j) -> st.l[j] + st.d[j] + c.l * x),
        'd', zip_with(st.d, e, (x, w) -> x + c.d * w),
        's', concat(slice(st.s, 4, {3 * last}), transform(e, (x, j) -> st.s[j] + c.s * x)),
        'e', concat(st.e, e))""")
    a_season = f"""aggregate(slice({y}, {period} * k + 1, {period}), named_struct('l', o.l, 'd', o.d, 's', o.s,
        'e', cast(array() as array<double>)), (st, v) -> {forward})"""
    whole = _let("q", a_season, "named_struct('l', q.l, 'd', q.d, 's', q.s, 'e', concat(o.e, q.e))")
    errors = f"""aggregate(sequence(0, (size({y}) - 1) div {period}), named_struct('l', {zero}, 'd', {_doubles([0, 1, 0])},
        's', {_doubles([1] + [0] * (3 * period - 1))}, 'e', cast(array() as array<double>)),
        (o, k) -> {whole}, o -> o.e)"""
    backward = _let("e", f"""transform(st.l, (x, j) ->
        errors[3 * t + j] + c.l * x + c.d * st.d[j] + c.s * st.s[{3 * last} + j])""", f"""named_struct(
        'l', zip_with(st.l, e, (x, w) -> x - w),
        'd', transform(e, (x, j) -> st.l[j] + st.d[j] - x),
        's', concat(transform(e, (x, j) -> st.s[{3 * last} + j] - x), slice(st.s, 1, {3 * last})))""")
    products = f"""aggregate(sequence(size({y}) - 1, 0), named_struct('l', {zero}, 'd', {zero}, 's', {zeros}),
        (st, t) -> {backward})"""
    # A month later, a pair of seasonals misses the product of the last months.
    first = f"transform(sequence(0, {last}), i -> z.s[3 * i])"
    seasonals = f"""aggregate(sequence(0, {last - 1}), array({first}), (rows, i) -> concat(rows, array(
        zip_with(slice(rows[i], 1, {last} - i), slice(back, i + 1, {last} - i), (x, w) -> x - w * back[i]))))"""
    data = f"aggregate(sequence(0, size({y}) - 1), 0D, (p, t) -> p + errors[3 * t + 2] * errors[3 * t + 2])"
    rows = f"""concat(transform({seasonals}, (r, i) -> concat(r, slice(z.s, 3 * i + 2, 2))),
        array(slice(z.d, 2, 2), array({data})))"""
    weights = f"named_struct('l', {a}, 'd', {a} * {b}, 's', {g} * (1D - {a}))"
    return _let("c", weights, _let("errors", errors, _let("z", products, _let(
        "back", f"transform(sequence(1, {last}), k -> errors[3 * (size({y}) - k)])", rows))))


def _reduced(rest: str) -> str:
    """The triangle without its first unknown (dependent ones are left out)."""
    head = f"{rest}[0]"
    return f"""zip_with(slice({rest}, 2, size({rest}) - 1), slice({head}, 2, size({rest}) - 1), (r, h) ->
        if({head}[0] <= {PIVOT}D, r, {_let("f", f"h / {head}[0]",
            f"zip_with(r, slice({head}, size({head}) - size(r) + 1, size(r)), (x, w) -> x - f * w)")}))"""


def _squared_error(matrix: str, period: int) -> str:
    return f"aggregate(sequence(0, {period}), {matrix}, (st, k) -> {_reduced('st')})[0][0]"


def _pivot_rows(matrix: str, period: int) -> str:
    return f"""aggregate(sequence(0, {period}),
        named_struct('done', cast(array() as array<array<double>>), 'rest', {matrix}),
        (st, k) -> named_struct('done', concat(st.done, array(st.rest[0])), 'rest', {_reduced('st.rest')})).done"""


def _start_state(done: str) -> str:
    """Seasonals, trend and 1, by substituting back."""
    return f"""aggregate(reverse({done}), array(1D), (x, r) -> concat(
        array(if(r[0] <= {PIVOT}D, 0D, -{_dot("slice(r, 2, size(x))", "x")} / r[0])), x))"""


def _distinct_sets(alpha: Column, betas: Column, gammas: Column) -> tuple[Column, Column]:
    return (F.when(alpha == 0, F.array(F.lit(0))).otherwise(betas),
            F.when(alpha == UNIT, F.array(F.lit(0))).otherwise(gammas))


def _search(rows: DataFrame, key: str, alphas: Column, betas: Column, gammas: Column, period: int) -> DataFrame:
    """The best parameters of each series among all combinations."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    b, g = _distinct_sets(F.col("_a"), betas, gammas)
    tried = (rows.withColumn("_a", F.explode(alphas)).withColumn("_b", b).withColumn("_g", g)
             .repartition(tasks))
    matrix = _normal("_y", f"(_a / {UNIT}D)", f"(b / {UNIT}D)", f"(g / {UNIT}D)", period)
    sse = _squared_error(matrix, period)
    best = f"""array_min(flatten(transform(_b, b -> transform(_g, g -> named_struct(
        'sse', round(greatest(0D, {sse}), {SSE_DIGITS}), 'a', _a, 'b', b, 'g', g)))))"""
    return (tried.select(key, "months", "_scale", "_y", F.expr(best).alias("_best"))
            .groupBy(key, "months", "_scale", "_y").agg(F.min("_best").alias("_best")))


def _around(name: str, step: int) -> Column:
    near = F.array(*[F.lit(k * step) for k in (-2, -1, 0, 1, 2)])
    return F.array_distinct(F.transform(
        near, lambda d: F.greatest(F.lit(0), F.least(F.lit(UNIT), F.col(f"_best.{name}") + d))))


def fit(series: DataFrame, period: int) -> DataFrame:
    """One row per series (``key, months, values``, values of at least two
    periods): key, months, alpha, beta, gamma, level, trend, seasonals (the
    next month's first) and deviation (population std of the one-step errors).
    Keys must be unique; a null key is a series like any other."""
    k = series.columns[0]
    top = F.array_max(F.transform("values", lambda v: F.abs(v.cast("double"))))
    rows = (series.select(k, "months", "values", F.greatest(F.lit(1.0), top).alias("_scale"))
            .withColumn("_y", F.transform("values", lambda v: v.cast("double") / F.col("_scale"))))
    grid = F.array(*[F.lit(v) for v in GRID])
    best = _search(rows, k, grid, grid, grid, period)
    for step in STEPS:
        best = _search(best, k, *(_around(p, step) for p in "abg"), period)
    named = best.select(k, "months", "_scale", "_y",
                        *[(F.col(f"_best.{p}") / F.lit(float(UNIT))).alias(n)
                          for p, n in zip("abg", ("alpha", "beta", "gamma"))])
    matrix = _normal("_y", "alpha", "beta", "gamma", period)
    solved = named.withColumn("_x", F.expr(_start_state(_pivot_rows(matrix, period))))
    error = "(v - st.l - st.d - st.s[0])"
    run = F.expr(f"""aggregate(_y,
        named_struct('l', 0D, 'd', _x[{period}], 's', slice(_x, 1, {period}), 'e', cast(array() as array<double>)),
        (st, v) -> named_struct(
            'l', st.l + st.d + alpha * {error}, 'd', st.d + alpha * beta * {error},
            's', concat(slice(st.s, 2, {period - 1}), array(st.s[0] + gamma * (1D - alpha) * {error})),
            'e', concat(st.e, array({error}))))""")
    done = solved.withColumn("_run", run)
    errors = F.col("_run.e")
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    done = done.withColumn("_mean", total(errors) / F.size(errors))
    deviation = F.sqrt(total(F.transform(errors, lambda e: (e - F.col("_mean")) * (e - F.col("_mean"))))
                       / F.size(errors))
    return done.select(k, "months", "alpha", "beta", "gamma",
                       (F.col("_run.l") * F.col("_scale")).alias("level"),
                       (F.col("_run.d") * F.col("_scale")).alias("trend"),
                       F.transform("_run.s", lambda s: s * F.col("_scale")).alias("seasonals"),
                       (deviation * F.col("_scale")).alias("deviation"))
