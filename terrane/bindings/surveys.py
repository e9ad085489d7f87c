"""Queries and oracles of the model comparison: all factor sets of the model table.

The SQL fits the same models its own way: normal equations by elimination, coordinate descent
as a recursion, weighted passes and tree levels as one step of the text each.
"""

from __future__ import annotations

from terrane.bindings.model_table import KEY, TITERS, model_sql, model_table
from terrane.bindings.models import HASH, X, Y, Z, rounded
from terrane.operators import comparison, factors, gram, levels
from terrane.operators.comparison import MEASURES, REGRESSORS

# forests and boosting draw or repeat too much for SQL; the tests hold them
IN_SQL = ("dummy", "lr", "ridge", "lasso", "en", "omp", "huber", "dt")
NAMES = ["hd", "pcd", "total_score", "H3_seasonal_calpha_sd", "H3_seasonal_heavy_sd", *TITERS]
SETS = factors.factor_sets(NAMES, "iterative", "all")
COMPOSITE = factors.factor_sets(NAMES, "composite", "antigenic")
LINEAR_SETS = [((X, Y), Z), ((X, Y), TITERS[1])]


def ranking(sets, regressors, best=False):
    def run(spark, sf):
        table = model_table(spark, sf)
        make = comparison.survey_models if best else comparison.survey
        return rounded(make(table, sets, [KEY], regressors))
    return run


def compare_models(spark, sf):
    """One set: all x columns and the first titer."""
    (xs, z), *_ = COMPOSITE
    return rounded(comparison.compare_models(model_table(spark, sf), xs, z, [KEY], IN_SQL))


def _eliminated(name: str, source: str, a, b, p: int) -> list[str]:
    """Steps that solve the p equations a(i, j) w_j = b(i) of each row of ``source``."""
    cells = [f"{a(i, j)} AS e{i}_{j}" for i in range(p) for j in range(p)]
    steps = [f"{name}_0 AS (SELECT *, {', '.join(cells)}, "
             + ", ".join(f"{b(i)} AS e{i}_{p}" for i in range(p)) + f" FROM {source})"]
    own = ", ".join(f"e{i}_{j}" for i in range(p) for j in range(p + 1))
    for k in range(p):
        made = ", ".join(
            (f"e{k}_{j} / e{k}_{k}" if i == k else f"e{i}_{j} - e{i}_{k} * e{k}_{j} / e{k}_{k}")
            + f" AS e{i}_{j}" for i in range(p) for j in range(p + 1))
        steps.append(f"{name}_{k + 1} AS (SELECT * EXCLUDE ({own}), {made} FROM {name}_{k})")
    steps.append(f"{name} AS (SELECT * EXCLUDE ({own}), "
                 + ", ".join(f"e{i}_{p} AS w{i}" for i in range(p)) + f" FROM {name}_{p})")
    return steps


def _descent(name: str, absolute: float, squared: float, p: int) -> list[str]:
    """Coordinate descent as a recursion over sweeps."""
    inner = "SELECT * FROM state"
    for j in range(p):
        others = " - ".join([f"xz{j} / n"] + [
            f"xx{min(j, k)}_{max(j, k)} / n * w{k}" for k in range(p) if k != j])
        pull = f"({others})"
        inner = (f"SELECT * REPLACE (SIGN({pull}) * GREATEST(ABS({pull}) - {absolute}e0, 0) "
                 f"/ (xx{j}_{j} / n + {squared}e0) AS w{j}) FROM ({inner})")
    zeros = ", ".join(f"0.0e0 AS w{j}" for j in range(p))
    walk = inner.replace("FROM state", f"FROM {name}_walk WHERE sweep < 400")
    return [
        f"{name}_walk AS (SELECT *, {zeros}, 0 AS sweep FROM stats UNION ALL "
        f"SELECT * REPLACE (sweep + 1 AS sweep) FROM ({walk}))",
        f"{name} AS (SELECT * FROM {name}_walk WHERE sweep = 400)",
    ]


def _huber(p: int) -> list[str]:
    ws = ", ".join(f"w{i}" for i in range(p))
    steps = [f"h0 AS (SELECT set, mz - {' - '.join(f'w{i} * m{i}' for i in range(p))} AS b, {ws}, "
             "CAST('inf' AS DOUBLE) AS s FROM lr)"]
    means = ", ".join(["mz", *[f"m{i}" for i in range(p)]])
    for t in range(gram.PASSES):
        p_of = "b + " + " + ".join(f"w{i} * a{i}" for i in range(p))
        weight = f"CASE WHEN gap > {gram.BEND} * s THEN {gram.BEND} * s / gap ELSE 1.0e0 END"
        c = [f"(a{i} - m{i})" for i in range(p)]
        sums = ["SUM(u) AS su", "SUM(u * (z - mz)) AS uz", "AVG(gap) AS far"]
        sums += [f"SUM(u * {c[i]}) AS u{i}" for i in range(p)]
        sums += [f"SUM(u * {c[i]} * (z - mz)) AS uz{i}" for i in range(p)]
        sums += [f"SUM(u * {c[i]} * {c[j]}) AS u{i}_{j}" for i in range(p) for j in range(i, p)]
        steps += [
            f"hr{t} AS (SELECT *, {weight} AS u FROM (SELECT r.*, {means}, s, "
            f"ABS(z - ({p_of})) AS gap FROM rows r JOIN h{t} USING (set) "
            f"JOIN stats USING (set) WHERE train))",
            f"hs{t} AS (SELECT set, {means}, {', '.join(sums)} FROM hr{t} GROUP BY ALL)",
            *_eliminated(
                f"hw{t}", f"hs{t}",
                lambda i, j: f"u{min(i, j)}_{max(i, j)} - u{i} * u{j} / su",
                lambda i: f"uz{i} - u{i} * uz / su", p),
            f"h{t + 1} AS (SELECT set, mz + uz / su - "
            + " - ".join(f"w{i} * (m{i} + u{i} / su)" for i in range(p))
            + f" AS b, {ws}, {gram.SCALE} * far AS s FROM hw{t})",
        ]
    return steps


def _tree(p: int) -> list[str]:
    bins = ", ".join(
        f"len(list_filter(edges{i}, lambda e: e < a{i})) AS b{i}" for i in range(p))
    steps = [f"t0 AS MATERIALIZED (SELECT r.set, r.id, r.train, r.z, 0 AS node, {bins} "
             "FROM rows r JOIN edges USING (set))"]
    for d in range(levels.DEPTH):
        cells = " UNION ALL ".join(
            f"SELECT set, node, {i} AS axis, b{i} AS bin, COUNT(*) AS k, SUM(z) AS s FROM t{d} "
            f"WHERE train AND node >= {2 ** d - 1} GROUP BY ALL" for i in range(p))
        steps += [
            f"c{d} AS (SELECT set, node, axis, bin, SUM(k) OVER w AS lk, SUM(s) OVER w AS ls, "
            f"SUM(k) OVER v AS k, SUM(s) OVER v AS s FROM ({cells}) "
            f"WINDOW v AS (PARTITION BY set, node, axis), "
            f"w AS (PARTITION BY set, node, axis ORDER BY bin))",
            f"g{d} AS (SELECT *, ls * ls / lk + (s - ls) ** 2 / (k - lk) - s * s / k AS gain "
            f"FROM c{d} WHERE lk < k)",
            f"f{d} AS (SELECT *, MAX(gain) OVER (PARTITION BY set, node) AS most FROM g{d})",
            f"s{d} AS (SELECT set, node, axis, bin FROM f{d} WHERE most > 0 QUALIFY row_number() "
            f"OVER (PARTITION BY set, node ORDER BY round_even(gain / "
            f"10.0e0 ** (FLOOR(LOG10(most)) + 1 - {levels.DIGITS}), 0) DESC, axis, bin) = 1)",
            f"t{d + 1} AS MATERIALIZED (SELECT t.* REPLACE (CASE WHEN s.axis IS NULL THEN t.node "
            f"ELSE 2 * t.node + 1 + CASE WHEN "
            f"list_value({', '.join(f't.b{i}' for i in range(p))})[s.axis + 1] > s.bin "
            f"THEN 1 ELSE 0 END END AS node) FROM t{d} t LEFT JOIN s{d} s USING (set, node))",
        ]
    last = f"t{levels.DEPTH}"
    return steps + [
        f"dt AS (SELECT t.set, t.train, t.z, v.p FROM {last} t JOIN (SELECT set, node, "
        f"AVG(z) AS p FROM {last} WHERE train GROUP BY set, node) v USING (set, node))"]


def survey_sql(sets, models, best=False) -> str:
    """The ranking of ``models`` on ``sets``, which all have as many x columns."""
    p = len(sets[0][0])
    rows = "\nUNION ALL\n".join(
        f"SELECT {i} AS set, {KEY} AS id, "
        + ", ".join(f'"{x}" AS a{j}' for j, x in enumerate(xs)) + f', "{z}" AS z FROM model'
        for i, (xs, z) in enumerate(sets))
    here = " AND ".join(f"{c} IS NOT NULL" for c in ("z", *[f"a{j}" for j in range(p)]))
    split = HASH.format(parts="12345678, 'split', id")
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    stats = ["COUNT(*) AS n", "AVG(z) AS mz"]
    stats += [f"AVG(a{i}) AS m{i}" for i in range(p)]
    stats += [f"COVAR_POP(a{i}, a{j}) * COUNT(*) AS xx{i}_{j}" for i, j in pairs]
    stats += [f"COVAR_POP(a{i}, z) * COUNT(*) AS xz{i}" for i in range(p)]
    shares = ", ".join(str(i / levels.BINS) for i in range(1, levels.BINS))
    columns = sorted({x for xs, _ in sets for x in xs})
    cut = ", ".join(
        f'list_distinct(quantile_disc("{c}", [{shares}])) AS q{i}' for i, c in enumerate(columns))
    edges = " UNION ALL ".join(
        f"SELECT {i} AS set, " + ", ".join(
            f"q{columns.index(x)} AS edges{j}" for j, x in enumerate(xs)) + " FROM cuts"
        for i, (xs, _) in enumerate(sets))
    both = lambda i, j: f"xx{min(i, j)}_{max(i, j)}"
    steps = [
        model_sql().replace("lines AS", "lines AS", 1),
        f"full_rows AS (SELECT *, {split} % 100 < 75 AS train FROM ({rows}) WHERE {here})",
        "enough AS (SELECT set, COUNT(*) AS n FROM full_rows GROUP BY set "
        f"HAVING COUNT(*) >= {factors.MIN_ROWS} AND count_if(train) >= 2)",
        "rows AS MATERIALIZED (SELECT r.* FROM full_rows r SEMI JOIN enough USING (set))",
        f"stats AS MATERIALIZED (SELECT set, {', '.join(stats)} FROM rows WHERE train GROUP BY set)",
        *_eliminated("lr", "stats", both, lambda i: f"xz{i}", p),
    ]
    lines = {"lr": "lr"}
    if "ridge" in models:
        steps += _eliminated(
            "ridge", "stats", lambda i, j: both(i, j) + (f" + {gram.ALPHA}" if i == j else ""),
            lambda i: f"xz{i}", p)
    if "lasso" in models:
        steps += _descent("lasso", gram.ALPHA, 0.0, p)
    if "en" in models:
        steps += _descent("en", gram.ALPHA * gram.L1_SHARE, gram.ALPHA * (1 - gram.L1_SHARE), p)
    if "dummy" in models:
        steps.append("dummy AS (SELECT *, " + ", ".join(f"0.0e0 AS w{i}" for i in range(p))
                     + " FROM stats)")
    if "omp" in models:
        fits = ", ".join(
            f"CASE WHEN xx{i}_{i} > 0 THEN xz{i} ** 2 / xx{i}_{i} ELSE 0 END" for i in range(p))
        steps += [
            f"fits AS (SELECT *, [{fits}] AS f FROM stats)",
            "omp AS (SELECT *, " + ", ".join(
                f"CASE WHEN list_position(f, list_max(f)) = {i + 1} AND list_max(f) > 0 "
                f"THEN xz{i} / xx{i}_{i} ELSE 0 END AS w{i}" for i in range(p)) + " FROM fits)"]
    if "huber" in models:
        steps += _huber(p)
    if "dt" in models:
        steps += [f"cuts AS (SELECT {cut} FROM model)", f"edges AS ({edges})", *_tree(p)]
    guesses = []
    for m in models:
        if m == "dt":
            guesses.append("SELECT set, train, z, 'dt' AS m, p FROM dt")
        elif m == "huber":
            line = " + ".join(["b", *[f"w{i} * a{i}" for i in range(p)]])
            guesses.append(f"SELECT set, train, z, 'huber' AS m, {line} AS p "
                           f"FROM rows JOIN h{gram.PASSES} USING (set)")
        else:
            line = " + ".join(["mz", *[f"w{i} * (a{i} - m{i})" for i in range(p)]])
            guesses.append(f"SELECT set, train, z, '{m}' AS m, {line} AS p "
                           f"FROM rows JOIN {lines.get(m, m)} USING (set)")
    texts = {
        "mae": "AVG(ABS(z - p))", "mse": "AVG((z - p) ** 2)", "rmse": "SQRT(AVG((z - p) ** 2))",
        "r2": "1 - SUM((z - p) ** 2) / (VAR_POP(z) * COUNT(*))",
        "rmsle": "SQRT(AVG((LN(1 + ABS(p)) - LN(1 + ABS(z))) ** 2))",
        "mape": "AVG(CASE WHEN z <> 0 THEN ABS((z - p) / z) END)",
    }
    names = [f"{m}{side}" for side in ("", "_train") for m in MEASURES]
    wide = ", ".join(
        f"MAX({m}) FILTER (WHERE {side}) AS {m}{suffix}"
        for suffix, side in (("", "NOT train"), ("_train", "train")) for m in MEASURES)
    titles = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REGRESSORS.items())
    if p == 2:
        heads = ", ".join(f"({i}, '{xs[0]}', '{xs[1]}', '{z}')" for i, (xs, z) in enumerate(sets))
        head, named = "x, y, z", "every(set, x, y, z)"
    else:
        heads = ", ".join(f"({i}, '{'+'.join(xs)}', '{z}')" for i, (xs, z) in enumerate(sets))
        head, named = "x, z", "every(set, x, z)"
    steps += [
        f"guesses AS ({' UNION ALL '.join(guesses)})",
        f"scored AS (SELECT set, m, train, {', '.join(f'{t} AS {n}' for n, t in texts.items())} "
        "FROM guesses GROUP BY ALL)",
        f"sides AS (SELECT set, m, {wide} FROM scored GROUP BY set, m)",
        f"every AS (SELECT * FROM (VALUES {heads}) AS {named})",
        "counts AS (SELECT set, COUNT(*) AS n FROM full_rows GROUP BY set)",
        f"ranked AS (SELECT {head}, COALESCE(n, 0) AS n, m AS model_abbreviation, "
        f"CASE m {titles} END AS model, {', '.join(f'ROUND({n}, 6) AS {n}' for n in names)}, "
        "CASE WHEN m IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY set "
        "ORDER BY ROUND(r2, 9) DESC NULLS LAST, m) AS INTEGER) END AS rank "
        "FROM every LEFT JOIN counts USING (set) LEFT JOIN sides USING (set))",
    ]
    end = ("SELECT * EXCLUDE (rank) FROM ranked WHERE COALESCE(rank, 1) = 1" if best
           else "SELECT * FROM ranked")
    return "WITH RECURSIVE " + ",\n".join(steps) + "\n" + end


QUERIES = {
    "compare_models": compare_models,
    "survey_linear": ranking(LINEAR_SETS, ("lr",), best=True),
    "survey_ranking": ranking(SETS, IN_SQL),
    "survey_models": ranking(SETS, IN_SQL, best=True),
    "survey_forests": ranking(COMPOSITE, ("lr", "rf", "et", "gbr")),
}

ORACLES = {
    "compare_models": survey_sql(COMPOSITE[:1], IN_SQL),
    "survey_linear": survey_sql(LINEAR_SETS, ("lr",), best=True),
    "survey_ranking": survey_sql(SETS, IN_SQL),
    "survey_models": survey_sql(SETS, IN_SQL, best=True),
}
