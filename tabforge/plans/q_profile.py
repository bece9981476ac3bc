"""Profiling / data-quality queries."""

from __future__ import annotations

from ..operators import aggregate as G
from ..operators import clean as C
from ..operators import profile as D
from ..operators import stats as ST
from ..sources.tables import ORDERLINES, docs, orderlines, read_table
from .catalog import query
from .q_clean import OL_COLS, OL_NUM
from .sqlparts import DOCS_CAP_CHAIN, DOCS_CLEAN_CHAIN, OL, OL_RAW, r6, union_all, with_

OL_CAT = ["l_returnflag", "l_linestatus", "l_linenumber"]
DOC_NUM = ["n_chars", "n_lines", "n_digits"]


def coerced(spark, sf_dir):
    df, spec = orderlines(spark, sf_dir)
    return C.coerce_numeric(df, spec), spec


# D1 ------------------------------------------------------------------------
@query("missing_counts", with_(OL) + union_all(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS missing FROM ol" for c in OL_COLS))
def q_missing_counts(spark, sf_dir):
    df, _ = coerced(spark, sf_dir)
    return D.missing_counts(df)


# D2 ------------------------------------------------------------------------
@query("sentinel_counts", with_(OL_RAW) + union_all(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} = 0) AS sentinels FROM olr" for c in ("l_discount", "l_tax")))
def q_sentinel_counts(spark, sf_dir):
    df, spec = orderlines(spark, sf_dir)
    return D.sentinel_counts(df, spec)


# D3 ------------------------------------------------------------------------
_RANGED = [c for c in ORDERLINES.ranges if c != ORDERLINES.target]
_VIOL = union_all(
    f"SELECT '{c}' AS column, l_orderkey, l_linenumber, CAST({c} AS DOUBLE) AS value FROM ol "
    f"WHERE {c} < {ORDERLINES.ranges[c][0]} OR {c} > {ORDERLINES.ranges[c][1]}" for c in _RANGED)
_DIMS = ", ".join(f"('{c}', CAST({ORDERLINES.ranges[c][0]} AS DOUBLE), CAST({ORDERLINES.ranges[c][1]} AS DOUBLE))"
                  for c in _RANGED)


@query("range_violations", with_(OL, f"v AS ({_VIOL})",
                                 "r AS (SELECT v.\"column\", value, row_number() OVER (PARTITION BY v.\"column\" ORDER BY l_orderkey, l_linenumber) AS rn FROM v)") +
       f"""SELECT d.column, {r6('d.lo')} AS lo, {r6('d.hi')} AS hi, c.violations, s.sample
FROM (VALUES {_DIMS}) d("column", lo, hi)
JOIN (SELECT v."column", count(*) AS violations FROM v GROUP BY v."column") c ON d.column = c.column
LEFT JOIN (SELECT r."column", string_agg(printf('%.2f', value), ',' ORDER BY rn) AS sample FROM r WHERE rn <= 10 GROUP BY r."column") s
  ON d.column = s.column
WHERE c.violations > 0""")
def q_range_violations(spark, sf_dir):
    df, spec = coerced(spark, sf_dir)
    return D.range_violations(df, spec)


# D4 ------------------------------------------------------------------------
_FEAT_T = [c for c in OL_COLS if c not in ("l_orderkey", "l_linenumber")] + ["l_linenumber"]


@query("duplicate_rows", with_(OL) + f"""SELECT CAST(coalesce(sum(cnt - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS cnt FROM ol GROUP BY {', '.join(c for c in OL_COLS if c not in ORDERLINES.key)})""")
def q_duplicate_rows(spark, sf_dir):
    df, spec = coerced(spark, sf_dir)
    return D.duplicate_rows(df, [c for c in OL_COLS if c not in spec.key])


@query("duplicate_rows_docs", """SELECT CAST(coalesce(sum(cnt - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS cnt FROM documents GROUP BY text, lang)""")
def q_duplicate_rows_docs(spark, sf_dir):
    """D4 on a table with real duplicates."""
    return D.duplicate_rows(read_table(spark, sf_dir, "documents", ["text", "lang"]))


# D5 ------------------------------------------------------------------------
_SPEC_COLS = [c for c in ORDERLINES.columns]
_VR = union_all(
    [f"SELECT 'missing' AS \"check\", '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS value FROM ol"
     for c in _SPEC_COLS] +
    [f"SELECT 'range', '{c}', count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) FROM ol"
     for c, (lo, hi) in ORDERLINES.ranges.items()] +
    ["SELECT 'rows', NULL, count(*) FROM ol",
     "SELECT 'is_valid', NULL, CAST((" + " + ".join(
         [f"count(*) FILTER (WHERE {c} IS NULL)" for c in _SPEC_COLS] +
         [f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi})" for c, (lo, hi) in ORDERLINES.ranges.items()]) +
     ") = 0 AS BIGINT) FROM ol",
     "SELECT 'duplicates', NULL, CAST(coalesce(sum(cnt - 1), 0) AS BIGINT) FROM (SELECT count(*) AS cnt FROM ol GROUP BY "
     + ", ".join(c for c in _SPEC_COLS if c not in ORDERLINES.key) + ")"])


@query("validation_report", with_(OL) + _VR)
def q_validation_report(spark, sf_dir):
    df, spec = coerced(spark, sf_dir)
    return D.validation_report(df, spec)


_ISSUES = union_all(
    ["SELECT 'missing' AS \"check\", NULL AS column, printf('Found %d missing values', CAST(sum(value) AS BIGINT)) AS text "
     "FROM vr WHERE \"check\" = 'missing' HAVING sum(value) > 0"] +
    [f"SELECT 'range', '{c}', printf('Column ''{c}'' has %d values outside valid range [{lo}, {hi}]', value) "
     f"FROM vr WHERE \"check\" = 'range' AND \"column\" = '{c}' AND value > 0" for c, (lo, hi) in ORDERLINES.ranges.items()] +
    ["SELECT 'duplicates', NULL, printf('Found %d duplicate rows', value) FROM vr WHERE \"check\" = 'duplicates' AND value > 0"])


@query("validation_issues", with_(OL, f"vr AS ({_VR})") + _ISSUES)
def q_validation_issues(spark, sf_dir):
    """The report's issues in words."""
    df, spec = coerced(spark, sf_dir)
    return D.validation_issues(D.validation_report(df, spec), spec)


# D6 ------------------------------------------------------------------------
def _describe_sql(src: str, cols: list[str], group: str | None = None) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS column{', ' + 'CAST(' + group + ' AS VARCHAR) AS grp' if group else ''}, "
            f"count({c}) AS count, {r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS std, "
            f"{r6(f'min({c})')} AS min, {r6(f'quantile_cont({c}, 0.25)')} AS q25, "
            f"{r6(f'quantile_cont({c}, 0.5)')} AS q50, {r6(f'quantile_cont({c}, 0.75)')} AS q75, "
            f"{r6(f'max({c})')} AS max FROM {src}" + (f" GROUP BY {group}" if group else ""))
    return union_all(parts)


@query("describe", with_(OL) + _describe_sql("ol", OL_NUM))
def q_describe(spark, sf_dir):
    df, _ = coerced(spark, sf_dir)
    return G.describe(df, OL_NUM)


# D7 ------------------------------------------------------------------------
@query("feature_summary", with_(OL) + union_all(
    f"SELECT '{c}' AS column, 'double' AS dtype, count({c}) AS non_null, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"count(DISTINCT {c}) AS n_unique, {r6(f'min({c})')} AS min, {r6(f'max({c})')} AS max, "
    f"{r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS std, {r6(f'quantile_cont({c}, 0.5)')} AS median FROM ol"
    for c in OL_NUM))
def q_feature_summary(spark, sf_dir):
    df, _ = coerced(spark, sf_dir)
    return D.feature_summary(df, OL_NUM)


# D8 ------------------------------------------------------------------------
@query("value_counts", with_(OL, "vc AS (" + union_all(
    f"SELECT '{c}' AS column, CAST({c} AS VARCHAR) AS value, count(*) AS cnt FROM ol WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in OL_CAT) + ")") +
    f"SELECT vc.\"column\", value, cnt, {r6('cnt / sum(cnt) OVER (PARTITION BY vc.\"column\")')} AS share FROM vc")
def q_value_counts(spark, sf_dir):
    df, _ = coerced(spark, sf_dir)
    return D.value_counts(df, OL_CAT)


# D9 ------------------------------------------------------------------------
@query("dataset_info", with_(OL) + union_all([
    "SELECT 'rows' AS metric, count(*) AS value FROM ol",
    f"SELECT 'columns', CAST({len(OL_COLS)} AS BIGINT)",
    f"SELECT 'numeric', CAST({len(ORDERLINES.numeric)} AS BIGINT)",
    f"SELECT 'categorical', CAST({len(ORDERLINES.categorical)} AS BIGINT)",
    "SELECT 'missing', CAST(" + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in OL_COLS) + " AS BIGINT) FROM ol",
    "SELECT 'duplicate_rows', CAST(coalesce(sum(cnt - 1), 0) AS BIGINT) FROM (SELECT count(*) AS cnt FROM ol GROUP BY "
    + ", ".join(c for c in OL_COLS if c not in ORDERLINES.key) + ")"]))
def q_dataset_info(spark, sf_dir):
    df, spec = coerced(spark, sf_dir)
    return D.dataset_info(df, spec)


_STAT_NAMES = (("count", "count({c})"), ("mean", "avg({c})"), ("std", "stddev_samp({c})"), ("min", "min({c})"),
               ("q25", "quantile_cont({c}, 0.25)"), ("q50", "quantile_cont({c}, 0.5)"), ("q75", "quantile_cont({c}, 0.75)"),
               ("max", "max({c})"))


@query("dataset_statistics", with_(OL) + union_all(
    [f"SELECT 'statistics' AS section, '{c}' AS column, '{n}' AS name, {r6(e.format(c=c))} AS value FROM ol"
     for c in OL_NUM for n, e in _STAT_NAMES] +
    [f"SELECT 'value_counts', '{c}', CAST({c} AS VARCHAR), CAST(count(*) AS DOUBLE) FROM ol WHERE {c} IS NOT NULL GROUP BY {c}"
     for c in OL_CAT] +
    [f"SELECT 'correlation', '{a}', '{b}', {r6(f'corr({a}, {b})')} FROM ol" for i, a in enumerate(OL_NUM) for b in OL_NUM[i + 1:]]))
def q_dataset_statistics(spark, sf_dir):
    """Statistics, value counts and correlations of the dataset."""
    df, _ = coerced(spark, sf_dir)
    return D.dataset_statistics(df, OL_NUM, OL_CAT)


# D10 -----------------------------------------------------------------------
_DT = {"l_orderkey": "bigint", "l_linenumber": "int", "l_returnflag": "string", "l_linestatus": "string",
       "severity": "int"}


@query("column_types", with_(OL) + union_all(
    f"SELECT '{c}' AS column, '{_DT.get(c, 'double')}' AS dtype, count({c}) AS non_null, "
    f"count(DISTINCT {c}) AS n_unique FROM ol" for c in OL_COLS))
def q_column_types(spark, sf_dir):
    df, _ = coerced(spark, sf_dir)
    return D.column_types(df)


# D11 -----------------------------------------------------------------------
def _describe_long(src: str, cols: list[str], name: str) -> str:
    stats = [("count", "count({c})"), ("mean", "avg({c})"), ("std", "stddev_samp({c})"), ("min", "min({c})"),
             ("q25", "quantile_cont({c}, 0.25)"), ("q50", "quantile_cont({c}, 0.5)"),
             ("q75", "quantile_cont({c}, 0.75)"), ("max", "max({c})")]
    return union_all(f"SELECT '{c}' AS column, '{s}' AS stat, CAST({e.format(c=c)} AS DOUBLE) AS {name} FROM {src}"
                     for c in cols for s, e in stats)


@query("outlier_delta", with_(*DOCS_CAP_CHAIN, f"b AS ({_describe_long('docs_clean', DOC_NUM, 'v')})",
                              f"a AS ({_describe_long('docs_cap', DOC_NUM, 'v')})") +
       f"""SELECT b.column, b.stat, {r6('b.v')} AS before, {r6('a.v')} AS after, {r6('a.v - b.v')} AS delta
FROM b JOIN a ON b.column = a.column AND b.stat = a.stat""")
def q_outlier_delta(spark, sf_dir):
    df, spec = docs(spark, sf_dir)
    cl = C.clean(df, spec)
    return D.compare_describe(cl, C.cap_iqr(cl, spec), DOC_NUM)


_DOC_OUT = union_all(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS outliers, "
    f"{r6(f'any_value({lo})')} AS lower_bound, {r6(f'any_value({hi})')} AS upper_bound FROM docs_clean CROSS JOIN docs_b"
    for c, lo, hi in [("n_chars", "l1", "h1"), ("n_lines", "l2", "h2"), ("n_digits", "l3", "h3")])


@query("outlier_report_docs", with_(*DOCS_CAP_CHAIN[:-1]) + f"SELECT * FROM ({_DOC_OUT}) WHERE outliers > 0")
def q_outlier_report_docs(spark, sf_dir):
    df, spec = docs(spark, sf_dir)
    cl = C.clean(df, spec)
    return C.outlier_report(cl, C.fit_iqr_bounds(cl, DOC_NUM))


@query("cap_iqr_docs", with_(*DOCS_CAP_CHAIN) +
       f"SELECT doc_id, {', '.join(f'{r6(c)} AS {c}' for c in DOC_NUM)}, lang, source, toxic, quality FROM docs_cap")
def q_cap_iqr_docs(spark, sf_dir):
    df, spec = docs(spark, sf_dir)
    return C.cap_iqr(C.clean(df, spec), spec)


# C1 ------------------------------------------------------------------------
@query("corr_matrix", with_(OL) + union_all(
    f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})')} AS r FROM ol"
    for i, a in enumerate(OL_NUM + ['severity']) for b in (OL_NUM + ['severity'])[i + 1:]))
def q_corr_matrix(spark, sf_dir):
    df, _ = coerced(spark, sf_dir)
    return ST.corr_matrix(df, OL_NUM + ["severity"])


# C2 ------------------------------------------------------------------------
@query("corr_target", with_(*DOCS_CLEAN_CHAIN, "ct AS (" + union_all(
    f"SELECT '{c}' AS feature, corr({c}, quality) AS r FROM docs_clean" for c in DOC_NUM + ['toxic']) + ")") +
    f"SELECT feature, {r6('r')} AS r, {r6('abs(r)')} AS abs_r, "
    "CAST(row_number() OVER (ORDER BY abs(r) DESC, feature) AS INTEGER) AS rank FROM ct")
def q_corr_target(spark, sf_dir):
    df, spec = docs(spark, sf_dir)
    return ST.corr_target(C.clean(df, spec), DOC_NUM + ["toxic"], "quality")

