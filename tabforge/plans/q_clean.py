"""Cleaning / encoding / scaling / splitting queries (T1-T12, G1+G2 flagship)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as G
from ..operators import clean as C
from ..operators import split as S
from ..sources.tables import docs, orderlines
from .catalog import query
from .sqlparts import (DOCS, OL, OL_BOUNDS, OL_CAP_CHAIN, OL_CAPPED, OL_CLEAN_CHAIN, OL_IMP, OL_MED, OL_Q, r6, with_)

OL_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "l_returnflag", "l_linestatus", "severity"]
OL_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _ol_select(prefix: str = "", scaled: dict | None = None) -> str:
    out = []
    for c in OL_COLS:
        out.append(f"{r6(prefix + c)} AS {c}" if c in OL_NUM else f"{prefix}{c} AS {c}")
    return ", ".join(out)


# Quantity bands of the flagship risk table, left-closed.
BAND_EDGES = [0, 10, 20, 30, 40, 50]
BAND_LABELS = ["<10", "10-19", "20-29", "30-39", "40-49"]


def cleaned_orderlines(spark, sf_dir, numeric=None, categorical=None, keyed=True):
    """Cleaned orderlines.  With ``numeric`` / ``categorical`` the table is
    projected to those columns (plus target and, if ``keyed``, key) BEFORE the fit, so the
    fit aggregate computes only statistics the query's output can use; the
    returned spec is the full one (feature counts stay as declared)."""
    df, spec = orderlines(spark, sf_dir)
    if numeric is None and categorical is None:
        return C.clean(df, spec), spec
    num, cat = tuple(numeric or ()), tuple(categorical or ())
    sub = spec.with_(numeric=num, categorical=cat, ordinal=tuple(c for c in spec.ordinal if c in cat),
                     binary=tuple(c for c in spec.binary if c in cat))
    cols = list(dict.fromkeys([*(spec.key if keyed else ()), *num, *cat, spec.target]))
    return C.clean(df.select(*cols), sub), spec


def capped_orderlines(spark, sf_dir, numeric=None, categorical=None):
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric, categorical)
    cols = [c for c in spec.numeric if numeric is None or c in numeric]
    return C.cap_iqr(cl, spec, cols=cols), spec


def risk_by_band_df(spark, sf_dir):
    """Flagship: clean -> cap -> risk by quantity band.  Projected to the
    columns the result uses before any fit, so the fill and IQR fits compute
    only the band column's statistics (the other columns' fills and caps
    cannot change this output)."""
    df, spec = orderlines(spark, sf_dir)
    band = "l_quantity"
    sub = spec.with_(numeric=(band,), categorical=(), ordinal=(), binary=(),
                     ranges={k: v for k, v in spec.ranges.items() if k in (band, spec.target)})
    df = df.select(*spec.key, band, spec.target)
    capped = C.cap_iqr(C.clean(df, sub), sub)
    return G.risk_by_band(capped, band, BAND_EDGES, BAND_LABELS, spec.target)


_BAND_CASE = " ".join(
    f"WHEN l_quantity >= {lo} AND l_quantity < {hi} THEN {i}"
    for i, (lo, hi) in enumerate(zip(BAND_EDGES, BAND_EDGES[1:])))
_BAND_VALUES = ", ".join(
    f"({i}, '{BAND_LABELS[i]}', CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE))"
    for i, (lo, hi) in enumerate(zip(BAND_EDGES, BAND_EDGES[1:])))

RISK_BY_BAND_SQL = with_(*OL_CAP_CHAIN, f"""dim AS (SELECT * FROM (VALUES {_BAND_VALUES}) t(bin, band, lo, hi))""",
                         f"""agg AS (SELECT CASE {_BAND_CASE} END AS bin, count(*) AS total,
  CAST(sum(severity) AS BIGINT) AS positives, avg(CAST(severity AS DOUBLE)) * 100 AS risk_rate
  FROM ol_cap GROUP BY 1)""") + f"""
SELECT coalesce(dim.bin, agg.bin) AS bin, dim.band, {r6('dim.lo')} AS lo, {r6('dim.hi')} AS hi,
       coalesce(agg.total, 0) AS total, coalesce(agg.positives, 0) AS positives, {r6('agg.risk_rate')} AS risk_rate
FROM dim FULL OUTER JOIN agg ON dim.bin = agg.bin"""

query("risk_by_band", RISK_BY_BAND_SQL)(risk_by_band_df)


@query("coerce_numeric", with_(OL) + f"SELECT {_ol_select()} FROM ol")
def q_coerce_numeric(spark, sf_dir):
    df, spec = orderlines(spark, sf_dir)
    return C.coerce_numeric(df, spec)


@query("impute_median", with_(OL, OL_MED, OL_IMP) + f"SELECT {_ol_select()} FROM ol_imp")
def q_impute_median(spark, sf_dir):
    df, spec = orderlines(spark, sf_dir)
    return C.impute_median(C.coerce_numeric(df, spec), spec)


@query("impute_mode", with_(DOCS, """m AS (SELECT
    (SELECT lang FROM docs WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1) AS m_lang,
    (SELECT source FROM docs WHERE source IS NOT NULL GROUP BY source ORDER BY count(*) DESC, source LIMIT 1) AS m_source,
    (SELECT toxic FROM docs WHERE toxic IS NOT NULL GROUP BY toxic ORDER BY count(*) DESC, toxic LIMIT 1) AS m_toxic)""") +
    f"""SELECT doc_id, {r6('n_chars')} AS n_chars, {r6('n_lines')} AS n_lines, {r6('n_digits')} AS n_digits,
       coalesce(lang, m_lang) AS lang, coalesce(source, m_source) AS source,
       coalesce(toxic, m_toxic) AS toxic, quality
FROM docs CROSS JOIN m""")
def q_impute_mode(spark, sf_dir):
    df, spec = docs(spark, sf_dir)
    return C.impute_mode(C.coerce_numeric(df, spec), spec)


@query("clean", with_(*OL_CLEAN_CHAIN) + f"SELECT {_ol_select()} FROM ol_clean")
def q_clean(spark, sf_dir):
    return cleaned_orderlines(spark, sf_dir)[0]


@query("encode", with_(*OL_CLEAN_CHAIN, """rf AS (SELECT l_returnflag AS v, CAST(row_number() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS i
  FROM (SELECT DISTINCT l_returnflag FROM ol_clean))""",
                       """ls AS (SELECT l_linestatus AS v, CAST(row_number() OVER (ORDER BY l_linestatus) - 1 AS INTEGER) AS i
  FROM (SELECT DISTINCT l_linestatus FROM ol_clean))""") +
       f"""SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, {r6('l_quantity')} AS l_quantity,
       {r6('l_extendedprice')} AS l_extendedprice, {r6('l_discount')} AS l_discount, {r6('l_tax')} AS l_tax,
       rf.i AS l_returnflag, ls.i AS l_linestatus, severity
FROM ol_clean JOIN rf ON ol_clean.l_returnflag = rf.v JOIN ls ON ol_clean.l_linestatus = ls.v""")
def q_encode(spark, sf_dir):
    df, spec = orderlines(spark, sf_dir)
    cl, levels = C.clean_with_levels(df, spec)      # fills and levels from one pass
    return C.encode(cl, spec, levels)[0]


def _scaled_sql(method: str) -> str:
    stats = ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}, min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in OL_NUM)
    cols = []
    for c in OL_COLS:
        if c in OL_NUM:
            if method == "standard":
                e = f"({c} - m_{c}) / (CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END)"
            else:
                e = f"CASE WHEN hi_{c} = lo_{c} THEN 0 ELSE ({c} - lo_{c}) / (hi_{c} - lo_{c}) END"
            cols.append(f"{r6(e)} AS {c}")
        else:
            cols.append(c)
    return with_(*OL_CLEAN_CHAIN, f"st AS (SELECT {stats} FROM ol_clean)") + \
        f"SELECT {', '.join(cols)} FROM ol_clean CROSS JOIN st"


@query("scale_standard", _scaled_sql("standard"))
def q_scale_standard(spark, sf_dir):
    cl, spec = cleaned_orderlines(spark, sf_dir)
    return C.scale(cl, OL_NUM, C.fit_scaler(cl, OL_NUM), "standard")


@query("scale_minmax", _scaled_sql("minmax"))
def q_scale_minmax(spark, sf_dir):
    cl, spec = cleaned_orderlines(spark, sf_dir)
    return C.scale(cl, OL_NUM, C.fit_scaler(cl, OL_NUM), "minmax")


@query("cap_iqr", with_(*OL_CAP_CHAIN) + f"SELECT {_ol_select()} FROM ol_cap")
def q_cap_iqr(spark, sf_dir):
    return capped_orderlines(spark, sf_dir)[0]


_OUTLIER_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS outliers, "
    f"{r6(lo)} AS lower_bound, {r6(hi)} AS upper_bound FROM ol_clean CROSS JOIN ol_b GROUP BY {lo}, {hi}"
    for c, lo, hi in [("l_quantity", "lq", "hq"), ("l_extendedprice", "lp", "hp"),
                      ("l_discount", "ld", "hd"), ("l_tax", "lt", "ht")])


@query("outlier_report", with_(*OL_CAP_CHAIN[:-1]) + f"SELECT * FROM ({_OUTLIER_ROWS}) WHERE outliers > 0")
def q_outlier_report(spark, sf_dir):
    cl, spec = cleaned_orderlines(spark, sf_dir)
    return C.outlier_report(cl, C.fit_iqr_bounds(cl, OL_NUM))


_HASH = ("CAST(('0x' || substr(md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
         "'42')), 1, 13)) AS BIGINT)")
# per class the rows with the smallest hashes, a fifth of them, are the test set
_SPLIT = (f"CASE WHEN row_number() OVER (PARTITION BY severity ORDER BY {_HASH}) "
          "<= floor(0.2 * count(*) OVER (PARTITION BY severity) + 0.5) THEN 'test' ELSE 'train' END")


@query("split_stratified", with_(*OL_CLEAN_CHAIN) +
       f"""SELECT split, severity, count(*) AS cnt FROM (SELECT {_SPLIT} AS split, severity FROM ol_clean)
GROUP BY split, severity""")
def q_split_stratified(spark, sf_dir):
    cl, spec = cleaned_orderlines(spark, sf_dir)
    sp = S.add_split(cl, spec, test_size=0.2, seed=42)
    return sp.groupBy("split", "severity").agg(F.count(F.lit(1)).alias("cnt"))


@query("split_rows", with_(*OL_CLEAN_CHAIN) +
       f"SELECT l_orderkey, l_linenumber, {_SPLIT} AS split FROM ol_clean")
def q_split_rows(spark, sf_dir):
    cl, spec = cleaned_orderlines(spark, sf_dir)
    return S.add_split(cl, spec, test_size=0.2, seed=42).select("l_orderkey", "l_linenumber", "split")


def _split_scale_sql(cap: bool) -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in OL_NUM)
    cols = [f"{r6(f'({c} - m_{c}) / (CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END)')} AS {c}" for c in OL_NUM]
    chain = OL_CLEAN_CHAIN + (f"ol_split AS (SELECT *, {_SPLIT} AS split FROM ol_clean)",)
    src, enc = "ol_split", ""
    head = "l_orderkey, l_linenumber, l_returnflag, l_linestatus, severity"
    if cap:
        src = "ol_cap"
        chain = chain + (      # bounds from the train rows
            OL_Q.replace("FROM ol_clean", "FROM ol_split WHERE split = 'train'"), OL_BOUNDS,
            OL_CAPPED.replace("FROM ol_clean", "FROM ol_split").replace("severity\n", "severity, split\n"),
            """rf AS (SELECT l_returnflag AS v, CAST(row_number() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS i
  FROM (SELECT DISTINCT l_returnflag FROM ol_clean))""",
            """ls AS (SELECT l_linestatus AS v, CAST(row_number() OVER (ORDER BY l_linestatus) - 1 AS INTEGER) AS i
  FROM (SELECT DISTINCT l_linestatus FROM ol_clean))""")
        enc = " JOIN rf ON s.l_returnflag = rf.v JOIN ls ON s.l_linestatus = ls.v"
        head = "l_orderkey, l_linenumber, rf.i AS l_returnflag, ls.i AS l_linestatus, severity"
    return with_(*chain, f"s AS (SELECT * FROM {src})",
                 f"st AS (SELECT {stats} FROM s WHERE split = 'train')") + \
        f"SELECT {head}, split, {', '.join(cols)} FROM s CROSS JOIN st{enc}"


@query("split_scale", _split_scale_sql(cap=False))
def q_split_scale(spark, sf_dir):
    """Scaler fitted on the train split only, applied to both splits."""
    cl, spec = cleaned_orderlines(spark, sf_dir)
    sp = S.add_split(cl, spec, test_size=0.2, seed=42)
    stats = C.fit_scaler(sp.filter(F.col("split") == "train"), OL_NUM)
    return C.scale(sp, OL_NUM, stats, "standard").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "severity", "split", *OL_NUM)


@query("preprocess", _split_scale_sql(cap=True))
def q_preprocess(spark, sf_dir):
    """Clean -> encode -> split -> cap and scale with statistics of the train rows."""
    df, spec = orderlines(spark, sf_dir)
    pp = C.preprocess(df, spec, test_size=0.2, seed=42, scaling="standard")
    return pp.scaled.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "severity",
                            "split", *OL_NUM)
