"""Queries of the monitoring reports: stability, quality, drift and model performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators import aggregates as agg
from larder.operators import drift, joins, performance, profiles, splits
from larder.operators.filters import term
from larder.plans import views
from larder.plans.registry import FEATURE_LIST, LABELED_SQL, LOG_SQL, query
from larder.plans.views import Tables
from larder.schemas import FEATURES, ColumnRoles
from larder.session import materialise

ROLES = ColumnRoles()


def rounded(df: DataFrame, keep: list[str], places: int = 6) -> DataFrame:
    """Doubles rounded, other columns as they are."""
    out: list[Column] = []
    for name, kind in df.dtypes:
        out.append(F.round(name, places).alias(name) if kind == "double" and name not in keep else F.col(name))
    return df.select(*out)


def pair(t: Tables, reference: str = "validation", current: str = "testing") -> tuple[DataFrame, DataFrame]:
    """The compared pair of labelled sets, report columns only; the feature rows are written once for all passes."""
    rows = materialise(views.labeled_features(t), "features", "label")
    columns = ROLES.report_columns(rows.columns)
    return term(rows, "label", reference).select(*columns), term(rows, "label", current).select(*columns)


# long form of both sides in SQL
LONG = LABELED_SQL + f""",
long AS (
  SELECT label, "column", "value" FROM (SELECT label, {FEATURE_LIST} FROM labeled WHERE label IN ('validation', 'testing'))
  UNPIVOT ("value" FOR "column" IN ({FEATURE_LIST})))"""

KS = """counts AS (
  SELECT "column", "value", count(*) FILTER (label = 'validation') AS r, count(*) FILTER (label = 'testing') AS c FROM long GROUP BY ALL),
cum AS (
  SELECT *, sum(r) OVER w AS cr, sum(c) OVER w AS cc, sum(r) OVER g AS nr, sum(c) OVER g AS nc,
         lead("value") OVER (PARTITION BY "column" ORDER BY "value") AS nxt
  FROM counts WINDOW w AS (PARTITION BY "column" ORDER BY "value" ROWS UNBOUNDED PRECEDING), g AS (PARTITION BY "column")),
measured AS (
  SELECT "column", max(abs(cr / nr - cc / nc)) AS ks, sum(abs(cr / nr - cc / nc) * (coalesce(nxt, "value") - "value")) AS wasserstein,
         sum("value" * c) / sum(c) - sum("value" * r) / sum(r) AS mean_shift,
         min("value") FILTER (cc >= nc * 0.25e0) - min("value") FILTER (cr >= nr * 0.25e0) AS q25_shift,
         min("value") FILTER (cc >= nc * 0.5e0) - min("value") FILTER (cr >= nr * 0.5e0) AS q50_shift,
         min("value") FILTER (cc >= nc * 0.75e0) - min("value") FILTER (cr >= nr * 0.75e0) AS q75_shift, max(nr) AS n1, max(nc) AS n2 FROM cum GROUP BY "column"),
lam AS (SELECT *, sqrt(n1::DOUBLE * n2 / (n1 + n2)) AS root FROM measured),
tested AS (
  SELECT *, CASE WHEN x < 0.2 THEN 1e0 ELSE least(greatest(2e0 * list_sum(list_transform(range(1, 101),
    lambda k: CASE WHEN k % 2 = 1 THEN 1e0 ELSE -1e0 END * exp(-2e0 * k * k * x * x))), 0e0), 1e0) END AS p_value
  FROM (SELECT *, (root + 0.12e0 + 0.11e0 / root) * ks AS x FROM lam))"""

PSI = """edges AS (SELECT "column", quantile_cont("value", [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM long WHERE label = 'validation' GROUP BY "column"),
binned AS (
  SELECT "column", bin, sum(r) AS r, sum(c) AS c FROM (
    SELECT "column", len(list_filter(e, lambda b: b < "value")) AS bin, r, c FROM counts JOIN edges USING ("column")) GROUP BY "column", bin),
shares AS (
  SELECT "column", greatest(r / sum(r) OVER g, 0.0001e0) AS pr, greatest(c / sum(c) OVER g, 0.0001e0) AS pc
  FROM binned WINDOW g AS (PARTITION BY "column")),
psi AS (SELECT "column", sum((pc - pr) * ln(pc / pr)) AS psi FROM shares GROUP BY "column")"""


# --- stability and quality ----------------------------------------------------------------------------------------

STABILITY = LONG + """,
stats AS (SELECT label, "column", count(*)::DOUBLE AS n, min("value") lo, max("value") hi, avg("value") m, stddev_samp("value") s FROM long GROUP BY ALL),
ref AS (SELECT * FROM stats WHERE label = 'validation'), cur AS (SELECT * FROM stats WHERE label = 'testing'),
outside AS (
  SELECT "column", avg(("value" < lo OR "value" > hi)::INT) AS o FROM (SELECT "column", "value" FROM long WHERE label = 'testing')
  JOIN ref USING ("column") GROUP BY "column"),
tests AS (
  SELECT 'row_count' AS test, '' AS "column", max(r.n) AS reference, max(k.n) AS "current", max(abs(k.n - r.n)) <= max(r.n) * 0.1e0 AS ok
  FROM ref r JOIN cur k USING ("column")
  UNION ALL SELECT 'null_share', "column", 0e0, 0e0, true FROM ref
  UNION ALL SELECT 'out_of_range', "column", 0e0, o, o <= 0.1e0 FROM outside
  UNION ALL SELECT 'mean_in_2_sigma', "column", r.m, k.m, abs(k.m - r.m) <= r.s * 2 FROM ref r JOIN cur k USING ("column"))"""


@query(
    "stability",
    f"""WITH {STABILITY} SELECT test, "column", round(reference, 6) AS reference, round("current", 6) AS "current",
    CASE WHEN ok THEN 'pass' ELSE 'fail' END AS status FROM tests""",
)
def stability(t: Tables) -> DataFrame:
    return rounded(profiles.stability_tests(*pair(t), FEATURES), [])


@query(
    "stability_categories",
    """WITH k AS (SELECT count(*) FILTER (lang NOT IN (SELECT d.lang FROM documents d JOIN labels l ON d.doc_id = l.doc_id)) AS unknown, count(*) AS n
      FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
    r AS (SELECT count(*) n, avg(n_chars) m, stddev_samp(n_chars) s, min(n_chars) lo, max(n_chars) hi FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),
    c AS (SELECT count(*) n, avg(n_chars) m FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
    o AS (SELECT avg((n_chars < lo OR n_chars > hi)::INT) o FROM documents, r WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
    tests AS (SELECT 'row_count' AS test, '' AS "column", r.n::DOUBLE AS reference, c.n::DOUBLE AS "current", abs(c.n - r.n) <= r.n * 0.1e0 AS ok FROM r, c
      UNION ALL SELECT 'null_share', 'n_chars', 0e0, 0e0, true
      UNION ALL SELECT 'out_of_range', 'n_chars', 0e0, o, o <= 0.1e0 FROM o
      UNION ALL SELECT 'mean_in_2_sigma', 'n_chars', r.m, c.m, abs(c.m - r.m) <= r.s * 2 FROM r, c
      UNION ALL SELECT 'unknown_values', 'lang', 0e0, unknown / n, unknown / n <= 0.1e0 FROM k)
    SELECT test, "column", round(reference, 6) AS reference, round("current", 6) AS "current", CASE WHEN ok THEN 'pass' ELSE 'fail' END AS status FROM tests""",
)
def stability_categories(t: Tables) -> DataFrame:
    """Labelled documents against those without a label, with a categorical column."""
    docs = t("documents").select("doc_id", "lang", "n_chars")
    labels = t("labels").select("doc_id")
    seen, fresh = docs.join(labels, "doc_id", "left_semi"), docs.join(labels, "doc_id", "left_anti")
    return rounded(profiles.stability_tests(seen, fresh, ["n_chars"], ["lang"]), [])


@query(
    "schema_stability",
    """SELECT 'column_count' AS test, '' AS "column", 9e0 AS reference, 6e0 AS "current", 'fail' AS status, count(*) AS docs FROM lineitem
    UNION ALL SELECT 'column_type', 'l_orderkey', 1e0, 1e0, 'pass', count(*) FROM lineitem""",
)
def schema_stability(t: Tables) -> DataFrame:
    """Schema tests of two projections of the line items, beside the number of rows they hold for."""
    left = t("lineitem").drop("l_shipdate", "l_linestatus")
    rows = profiles.schema_tests(left, t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_tax", "l_discount"))
    kept = [r for r in rows if r[0] == "column_count" or r[1] == "l_orderkey"]
    table = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("test", "column", "reference", "current", "status"), r)]) for r in kept])
    return t("lineitem").agg(F.count(F.lit(1)).alias("docs")).select("docs", F.explode(table).alias("r")).select("r.*", "docs")


@query(
    "quality",
    f"""WITH {LONG}, cur AS (SELECT * FROM long WHERE label = 'testing'),
    tops AS (SELECT * FROM (SELECT "column", "value", count(*) AS k FROM cur GROUP BY "column", "value") QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY k DESC, "value") = 1)
    SELECT "column", count(*) AS n, 0e0 AS nulls, round(avg(cur."value"), 6) AS mean, round(stddev_samp(cur."value"), 6) AS std, min(cur."value") AS low, max(cur."value") AS high,
    count(DISTINCT cur."value") AS distinct_values, round(count(*) FILTER (cur."value" = 0) / count(*), 6) AS zero_share, max(tops."value") AS most_common,
    round(max(k) / count(*), 6) AS most_common_share, round(quantile_cont(cur."value", 0.25), 6) AS p25, round(quantile_cont(cur."value", 0.5), 6) AS p50,
    round(quantile_cont(cur."value", 0.75), 6) AS p75 FROM cur JOIN tops USING ("column") GROUP BY "column" """,
)
def quality(t: Tables) -> DataFrame:
    return rounded(profiles.quality_profile(pair(t)[1], FEATURES), ["low", "high", "most_common"])


SKETCHED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "quality_sketch",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 6) AS mean, 1 AS quartiles_within, 1 AS distinct_within FROM lineitem" for c in SKETCHED
    ),
)
def quality_sketch(t: Tables) -> DataFrame:
    """One-pass approximate profile of the line items, and whether its errors keep the bounds.

    A quartile's rank lies within 2 % of the rows, the distinct count within 10 % of the true one.
    """
    rows = t("lineitem")
    sketch = materialise(profiles.quick_profile(rows, SKETCHED), "sketch")
    long = rows.select(*[F.col(c).cast("double").alias(c) for c in SKETCHED]).unpivot([], SKETCHED, "column", "value")
    checks = []
    for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        at_most, below = F.avg((F.col("value") <= F.col(name)).cast("double")), F.avg((F.col("value") < F.col(name)).cast("double"))
        checks += [at_most >= q - 0.02, below <= q + 0.02]
    within = checks[0]
    for check in checks[1:]:
        within = within & check
    exact = F.count_distinct("value")
    near = F.abs(F.first("distinct_values") - exact) <= exact * 0.1 + 1
    return long.join(F.broadcast(sketch), "column").groupBy("column").agg(
        F.first("n").alias("n"), F.round(F.first("mean"), 6).alias("mean"),
        within.cast("int").alias("quartiles_within"), near.cast("int").alias("distinct_within"),
    )


TEXTS = {"documents": ["text", "lang", "source"], "pages": ["url", "html"]}
TIMES = {"lineitem": ["l_shipdate"], "events": ["ts"], "orders": ["o_orderdate"]}


@query(
    "text_profile",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", count(*) AS rows, round(avg(({c} IS NULL)::INT), 6) AS nulls, round(avg((length({c}) = 0)::INT), 6) AS empty,
        round(avg((trim({c}, ' ') = '')::INT), 6) AS blank, min(length({c})) AS shortest, max(length({c})) AS longest, round(avg(length({c})), 6) AS mean_length,
        count(DISTINCT {c}) AS distinct_values FROM {t}"""
        for t, columns in TEXTS.items() for c in columns
    ),
)
def text_profile(t: Tables) -> DataFrame:
    """Lengths, empty shares and distinct numbers of the texts of documents and pages."""
    parts = [rounded(profiles.text_profile(t(name), columns), []).select(F.lit(name).alias("table"), "*") for name, columns in TEXTS.items()]
    return parts[0].unionByName(parts[1])


@query(
    "time_profile",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", sum(n)::BIGINT AS rows, round(sum(CASE WHEN d IS NULL THEN n ELSE 0 END) / sum(n), 6) AS nulls, strftime(min(lo), '%Y-%m-%d %H:%M:%S') AS "first", strftime(max(hi), '%Y-%m-%d %H:%M:%S') AS "last",
        count(d) AS days, max(n) FILTER (d IS NOT NULL) AS most_in_a_day
        FROM (SELECT {c}::DATE AS d, count(*) AS n, min({c})::TIMESTAMP AS lo, max({c})::TIMESTAMP AS hi FROM {t} GROUP BY 1)"""
        for t, columns in TIMES.items() for c in columns
    ),
)
def time_profile(t: Tables) -> DataFrame:
    """Ranges and fullest days of three timestamp columns."""
    out = None
    for name, columns in TIMES.items():
        part = rounded(profiles.time_profile(t(name), columns), []).select(F.lit(name).alias("table"), "*")
        part = part.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first", "last")})
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "heavy_values",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", md5({c}) AS value_md5, count(*) AS n FROM documents WHERE {c} IS NOT NULL GROUP BY {c}
        HAVING count(*) >= 0.005e0 * (SELECT count(*) FROM documents)"""
        for c in TEXTS["documents"]
    ),
)
def heavy_values(t: Tables) -> DataFrame:
    """Languages, sources and whole texts that at least one document in two hundred has, from sketches merged over the sources."""
    docs, columns = t("documents"), TEXTS["documents"]
    share = 0.005
    halves = [docs.where(F.col("lang") == "en"), docs.where(F.coalesce(F.col("lang") != "en", F.lit(True)))]
    stored = materialise(profiles.value_sketches(halves[0], columns, share).unionByName(profiles.value_sketches(halves[1], columns, share)), "sketches")
    found = profiles.heavy_values(docs, columns, share, profiles.merged_sketches(stored, share))
    return found.select("column", F.md5("value").alias("value_md5"), "n")


CORR = list(FEATURES)


@query(
    "correlations",
    "WITH " + LABELED_SQL + " " + " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(corr({a}, {b}), 6) AS corr FROM labeled WHERE label = 'testing'"
        for i, a in enumerate(CORR) for b in CORR[i + 1:]
    ),
)
def correlations(t: Tables) -> DataFrame:
    return rounded(profiles.correlations(pair(t)[1], CORR), [])


# --- drift --------------------------------------------------------------------------------------------------------


@query(
    "ks_drift",
    f"""WITH {LONG}, {KS} SELECT "column", round(ks, 6) AS ks, round(p_value, 6) AS p_value, (p_value < 0.05e0)::INT AS drifted,
    (avg((p_value < 0.05e0)::INT) OVER () >= 0.5)::INT AS dataset_drift FROM tested""",
)
def ks_drift(t: Tables) -> DataFrame:
    return rounded(drift.drift_test(*pair(t), FEATURES), [])


@query(
    "drift_report",
    f"""WITH {LONG}, {KS}, {PSI} SELECT "column", round(ks, 6) AS ks, round(wasserstein, 6) AS wasserstein, round(mean_shift, 6) AS mean_shift, round(q25_shift, 6) AS q25_shift, round(q50_shift, 6) AS q50_shift, round(q75_shift, 6) AS q75_shift,
    n1::BIGINT AS n_ref, n2::BIGINT AS n_cur, round(p_value, 6) AS p_value, round(psi, 6) AS psi FROM tested JOIN psi USING ("column")""",
)
def drift_report(t: Tables) -> DataFrame:
    return rounded(drift.drift_report(*pair(t), FEATURES), [])


@query(
    "drift_not_labelled",
    f"""WITH {LABELED_SQL}, long AS (
      SELECT label, "column", "value" FROM (
        SELECT CASE WHEN fid % 5 = 0 THEN 'testing' ELSE 'validation' END AS label, {FEATURE_LIST} FROM labeled WHERE fid % 5 = 0 OR label = 'testing')
      UNPIVOT ("value" FOR "column" IN ({FEATURE_LIST}))), {KS}
    SELECT "column", round(ks, 6) AS ks, round(p_value, 6) AS p_value, n1::BIGINT AS n_ref, n2::BIGINT AS n_cur FROM tested""",
)
def drift_not_labelled(t: Tables) -> DataFrame:
    """The testing set against documents that have no label yet (every fifth food)."""
    rows = materialise(views.labeled_features(t), "features", "label")
    labelled = rows.where(F.col("fid") % 5 != 0)
    fresh = joins.unlabeled(rows, labelled)
    counts = materialise(drift.side_counts(term(labelled, "label", "testing"), fresh, FEATURES), "drift-counts")
    return drift.drift_measures(counts, stored=True).select(
        "column", F.round("ks", 6).alias("ks"), F.round("p_value", 6).alias("p_value"), "n_ref", "n_cur"
    )


LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "line_drift",
    f"""WITH long AS (SELECT label, "column", "value" FROM (SELECT CASE WHEN l_shipdate < TIMESTAMP '1998-06-01' THEN 'validation' ELSE 'testing' END AS label,
      {', '.join(LINE_COLUMNS)} FROM lineitem) UNPIVOT ("value" FOR "column" IN ({', '.join(LINE_COLUMNS)}))), {KS}, {PSI}
    SELECT "column", round(ks, 6) AS ks, round(wasserstein, 4) AS wasserstein, round(p_value, 6) AS p_value, round(psi, 6) AS psi FROM tested JOIN psi USING ("column")""",
)
def line_drift(t: Tables) -> DataFrame:
    """Early against late shipments of all line items."""
    early = F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp_ntz")
    lines = t("lineitem")
    done = drift.drift_report(lines.where(early), lines.where(~early), LINE_COLUMNS)
    return done.select("column", F.round("ks", 6).alias("ks"), F.round("wasserstein", 4).alias("wasserstein"), F.round("p_value", 6).alias("p_value"), F.round("psi", 6).alias("psi"))


@query(
    "target_drift",
    f"""WITH {LOG_SQL}, recent AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY ts DESC, fid) AS rn FROM log),
    long AS (SELECT CASE WHEN rn <= 500 THEN 'testing' ELSE 'validation' END AS label, model || '.' || "column" AS "column", "value"
      FROM (SELECT rn, model, target, prediction FROM recent) UNPIVOT ("value" FOR "column" IN (target, prediction))), {KS}
    SELECT "column", round(ks, 6) AS ks, round(p_value, 6) AS p_value, n1::BIGINT AS n_ref, n2::BIGINT AS n_cur FROM tested""",
)
def target_drift(t: Tables) -> DataFrame:
    """Targets and predictions of the last 500 rows of each model against the rows before them."""
    found = drift.rolling_drift(views.prediction_log(t), 500)
    return found.select("column", F.round("ks", 6).alias("ks"), F.round("p_value", 6).alias("p_value"), "n_ref", "n_cur")


CATEGORIES = ["lang", "source"]

#: Documents with a label against those without, and the chi-square and Jensen-Shannon measures of their categories.
CATEGORY_SQL = """docs AS (SELECT d.*, d.doc_id IN (SELECT doc_id FROM labels) AS seen FROM documents d),
cells AS (SELECT "column", "value", count(*) FILTER (seen) AS r, count(*) FILTER (NOT seen) AS c
  FROM (SELECT 'lang' AS "column", lang AS "value", seen FROM docs UNION ALL SELECT 'source', source, seen FROM docs) GROUP BY "column", "value"),
sized AS (SELECT *, sum(r) OVER (PARTITION BY "column") AS nr, sum(c) OVER (PARTITION BY "column") AS nc FROM cells),
parts AS (SELECT *, (r + c) * nr / (nr + nc) AS er, (r + c) * nc / (nr + nc) AS ec, r / nr AS p, c / nc AS q FROM sized),
of_columns AS (SELECT "column", nr::BIGINT AS n_ref, nc::BIGINT AS n_cur, count(*) AS categories, count(*) FILTER (r = 0) AS new_categories,
  sum((r - er) * (r - er) / er + (c - ec) * (c - ec) / ec) AS chi2,
  sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS js_distance
  FROM parts GROUP BY "column", nr, nc),
chi AS (SELECT *, CASE WHEN chi2 <= 0 OR categories < 2 THEN 1e0 ELSE 1 - list_sum(list_transform(range(0, 2000),
  lambda n: exp(((categories - 1) / 2 + n) * ln(chi2 / 2) - chi2 / 2 - lgamma((categories - 1) / 2 + n + 1)))) END AS p_value FROM of_columns)"""


def labelled_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Documents that have a label, and those without."""
    docs, labels = t("documents").select("doc_id", "lang", "source", "n_chars"), t("labels").select("doc_id")
    return docs.join(labels, "doc_id", "left_semi"), docs.join(labels, "doc_id", "left_anti")


@query(
    "category_drift",
    f"""WITH {CATEGORY_SQL} SELECT "column", n_ref, n_cur, categories, new_categories, round(chi2, 6) AS chi2,
    round(js_distance, 6) AS js_distance, round(greatest(p_value, 0e0), 6) AS p_value FROM chi""",
)
def category_drift(t: Tables) -> DataFrame:
    """Languages and sources of the labelled documents against those of the others."""
    counts = materialise(drift.category_counts(*labelled_sides(t), CATEGORIES), "category-counts")
    return rounded(drift.category_drift(counts), [])


@query(
    "drift_by_role",
    f"""WITH {CATEGORY_SQL}, long AS (SELECT CASE WHEN seen THEN 'validation' ELSE 'testing' END AS label, 'n_chars' AS "column", n_chars::DOUBLE AS "value" FROM docs),
    {KS}, both_roles AS (SELECT "column", 'numeric' AS role, 'ks' AS test, ks AS statistic, p_value FROM tested
      UNION ALL SELECT "column", 'categorical', 'chi2', chi2, p_value FROM chi)
    SELECT "column", role, test, round(statistic, 6) AS statistic, round(greatest(p_value, 0e0), 6) AS p_value, (p_value < 0.05e0)::INT AS drifted,
    (avg((p_value < 0.05e0)::INT) OVER () >= 0.5)::INT AS dataset_drift FROM both_roles""",
)
def drift_by_role(t: Tables) -> DataFrame:
    """The test of each column follows from its role."""
    roles = ColumnRoles(numeric=["n_chars"], categorical=CATEGORIES, ident=["doc_id"])
    return rounded(drift.drift_by_role(*labelled_sides(t), roles), [])


# --- model performance --------------------------------------------------------------------------------------------

QUALITY = """count(*) AS n, round(avg(error), 6) AS mean_error, round(stddev_samp(error), 6) AS error_std, round(avg(abs(error)), 6) AS mae,
  round(stddev_samp(abs(error)), 6) AS abs_error_std, round(avg(ape), 6) AS mape, round(stddev_samp(ape), 6) AS ape_std, round(sqrt(avg(error * error)), 6) AS rmse,
  round(1 - sum(error * error) / (var_pop(target) * count(*)), 6) AS r2"""


def errors(t: Tables) -> DataFrame:
    return performance.with_errors(views.prediction_log(t), "target", "prediction")


@query("regression_quality", f"WITH {LOG_SQL} SELECT model, {QUALITY} FROM log GROUP BY model")
def regression_quality(t: Tables) -> DataFrame:
    return rounded(performance.regression_quality(views.prediction_log(t), ["model"], "target", "prediction"), [])


@query(
    "mse_rmse_r2",
    f"""WITH {LOG_SQL} SELECT count(*) AS n, round(avg(error * error), 4) AS mse, round(sqrt(avg(error * error)), 6) AS rmse,
    round(1 - sum(error * error) / (var_pop(target) * count(*)), 6) AS r2 FROM log""",
)
def mse_rmse_r2(t: Tables) -> DataFrame:
    m = agg.regression_measures(views.prediction_log(t), [], "target", "prediction")
    return m.select("n", F.round("mse", 4).alias("mse"), F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


@query(
    "r2_by_label",
    f"""WITH {LABELED_SQL}, p AS (SELECT label, score, protein / 65 * 0.2e0 - sodium / 2400 * 0.2e0 AS guess FROM labeled)
    SELECT label, count(*) AS n, round(1 - sum((score - guess) * (score - guess)) / (var_pop(score) * count(*)), 6) AS r2 FROM p GROUP BY label""",
)
def r2_by_label(t: Tables) -> DataFrame:
    guess = F.col("protein") / 65 * 0.2 - F.col("sodium") / 2400 * 0.2
    m = agg.regression_measures(views.labeled_features(t).withColumn("guess", guess), ["label"], "score", "guess")
    return m.select("label", "n", F.round("r2", 6).alias("r2"))


@query("residuals", f"WITH {LOG_SQL} SELECT fid, round(target - prediction, 6) AS residual FROM log")
def residuals(t: Tables) -> DataFrame:
    return views.prediction_log(t).select("fid", F.round(performance.residual(F.col("target"), F.col("prediction")), 6).alias("residual"))


@query(
    "predicted_vs_actual",
    f"""WITH {LOG_SQL}, e AS (SELECT min(target) x0, max(target) x1, min(prediction) y0, max(prediction) y1 FROM log)
    SELECT least(floor((target - x0) / ((x1 - x0) / 20)), 19)::BIGINT AS x_bin, least(floor((prediction - y0) / ((y1 - y0) / 20)), 19)::BIGINT AS y_bin,
    count(*) AS n FROM log, e GROUP BY ALL""",
)
def predicted_vs_actual(t: Tables) -> DataFrame:
    return performance.scatter_bins(views.prediction_log(t), "target", "prediction")


@query(
    "report_scatter",
    f"""WITH {LOG_SQL}, e AS (SELECT model, min(target) x0, max(target) x1, min(prediction) y0, max(prediction) y1 FROM log GROUP BY model)
    SELECT model, least(floor((target - x0) / ((x1 - x0) / 20)), 19)::BIGINT AS x_bin, least(floor((prediction - y0) / ((y1 - y0) / 20)), 19)::BIGINT AS y_bin,
    count(*) AS n FROM log JOIN e USING (model) GROUP BY ALL""",
)
def report_scatter(t: Tables) -> DataFrame:
    """Predicted against actual values of every model, as the performance report gives them."""
    log = views.prediction_log(t)
    return performance.performance_report(log, ["model"], "target", "prediction", F.col("fid").cast("double"))["predicted_vs_actual"]


@query(
    "errors_over_order",
    f"""WITH {LOG_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY fid) - 1 AS b, count(*) OVER (PARTITION BY model) AS n FROM log)
    SELECT model, floor(b * 50 / n)::BIGINT AS bin, count(*) AS n, round(avg(target), 6) AS target_mean, round(stddev_samp(target), 6) AS target_std,
    round(avg(prediction), 6) AS prediction_mean, round(stddev_samp(prediction), 6) AS prediction_std, round(avg(error), 6) AS error_mean,
    round(stddev_samp(error), 6) AS error_std, round(avg(ape), 6) AS ape_mean, round(stddev_samp(ape), 6) AS ape_std FROM o GROUP BY ALL""",
)
def errors_over_order(t: Tables) -> DataFrame:
    """Target, prediction, error and percentage error along the row order of every model."""
    columns = ["target", "prediction", "error", "ape"]
    return rounded(performance.over_order(errors(t), ["model"], F.col("fid").cast("double"), columns), [])


@query(
    "error_distribution",
    f"""WITH {LOG_SQL}, e AS (SELECT model, min(error) lo, max(error) hi FROM log GROUP BY model)
    SELECT model, bin, round(lo + (hi - lo) / 30 * bin, 6) AS bin_start, count(*) AS n
    FROM (SELECT model, lo, hi, least(floor((error - lo) / ((hi - lo) / 30)), 29)::BIGINT AS bin FROM log JOIN e USING (model)) GROUP BY ALL""",
)
def error_distribution(t: Tables) -> DataFrame:
    return rounded(agg.histogram(errors(t), "error", 30, ["model"]), [])


def qq_sql() -> str:
    from statistics import NormalDist

    grid = [i / 100 for i in range(1, 100)]
    normal = [NormalDist().inv_cdf(p) for p in grid]
    return f"""points AS (SELECT model, unnest(range(1, 100)) AS point, unnest({[float(z) for z in normal]}::DOUBLE[]) AS theoretical,
      unnest(quantile_cont(error, {grid})) AS "value" FROM log GROUP BY model)"""


@query(
    "qq_points",
    f'WITH {LOG_SQL}, {qq_sql()} SELECT model, point, round(theoretical, 6) AS theoretical, round("value", 6) AS "value" FROM points',
)
def qq_points(t: Tables) -> DataFrame:
    return rounded(performance.qq_points(errors(t), ["model"], "error"), [])


@query(
    "qq_line",
    f"""WITH {LOG_SQL}, {qq_sql()} SELECT model, round(regr_slope("value", theoretical), 6) AS slope, round(regr_intercept("value", theoretical), 6) AS intercept,
    round(corr("value", theoretical), 6) AS corr FROM points GROUP BY model""",
)
def qq_line(t: Tables) -> DataFrame:
    points = performance.qq_points(errors(t), ["model"], "error")
    return rounded(performance.qq_line(points, ["model"]), [])


TOP = """cuts AS (SELECT model, quantile_cont(error, 0.05) lo, quantile_cont(error, 0.95) hi FROM log GROUP BY model),
marked AS (SELECT log.*, CASE WHEN error <= lo THEN 'under' WHEN error >= hi THEN 'over' ELSE 'majority' END AS error_group FROM log JOIN cuts USING (model))"""


@query(
    "top_errors",
    f"""WITH {LOG_SQL}, {TOP} SELECT model, error_group, count(*) AS n, round(avg(error), 6) AS error_mean, round(stddev_samp(error), 6) AS error_std
    FROM marked GROUP BY ALL""",
)
def top_errors(t: Tables) -> DataFrame:
    return rounded(performance.top_errors(errors(t), ["model"]), [])


@query(
    "top_error_ranges",
    f"""WITH {LOG_SQL}, {TOP} SELECT model, error_group, 'target' AS "column", min(target) AS low, round(avg(target), 6) AS mean, max(target) AS high FROM marked GROUP BY ALL
    UNION ALL SELECT model, error_group, 'prediction', min(prediction), round(avg(prediction), 6), max(prediction) FROM marked GROUP BY ALL""",
)
def top_error_ranges(t: Tables) -> DataFrame:
    marked = performance.error_groups(errors(t), ["model"])
    return rounded(agg.feature_ranges(marked, ["model", "error_group"], ["target", "prediction"]), ["low", "high"])


@query("largest_errors", f"WITH {LOG_SQL} SELECT fid, model, round(error, 6) AS error FROM log ORDER BY abs(error) DESC, fid LIMIT 10")
def largest_errors(t: Tables) -> DataFrame:
    return performance.largest_errors(errors(t).select("fid", "model", "error"), "fid").select("fid", "model", F.round("error", 6).alias("error"))


RECENT = "recent AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY model ORDER BY ts DESC, fid) <= {n})"


@query(
    "last_n_window",
    f"WITH {LOG_SQL} SELECT model, fid, row_number() OVER (PARTITION BY model ORDER BY ts DESC, fid)::INTEGER AS rn FROM log QUALIFY rn <= 1000",
)
def last_n_window(t: Tables) -> DataFrame:
    return splits.last_rows(views.prediction_log(t), 1000).select("model", "fid", "rn")


@query("rolling_quality", f"WITH {LOG_SQL}, {RECENT.format(n=700)} SELECT model, {QUALITY} FROM recent GROUP BY model")
def rolling_quality(t: Tables) -> DataFrame:
    """Quality over the last 700 predictions of every model."""
    return rounded(performance.rolling_quality(views.prediction_log(t), 700), [])


@query(
    "rolling_top_errors",
    f"""WITH {LOG_SQL.replace('log AS', 'whole AS', 1)}, {RECENT.format(n=800).replace('recent AS', 'log AS').replace('FROM log', 'FROM whole')}, {TOP}
    SELECT model, error_group, count(*) AS n, round(avg(error), 6) AS error_mean, round(stddev_samp(error), 6) AS error_std FROM marked GROUP BY ALL""",
)
def rolling_top_errors(t: Tables) -> DataFrame:
    """One part of the rolling report: error groups over the last 800 predictions."""
    return rounded(performance.rolling_report(views.prediction_log(t), 800)["top_errors"], [])
