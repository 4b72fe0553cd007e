"""Encoding, feature selection and weight-of-evidence queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators import encode, woe
from lendmill.plans.portfolio import base, feature_table, with_history
from lendmill.plans.registry import query
from lendmill.session import materialize
from lendmill.sources.domain import Domain

# ---- encoding and selection -----------------------------------------------------------------


@query("enc_binary", sql="""
    SELECT sk_id_curr, CASE flag_own_car WHEN 'N' THEN 0 WHEN 'Y' THEN 1 END AS flag_own_car,
      CASE WHEN occupied = 'employed' THEN 0 ELSE 1 END AS occupied
    FROM (SELECT sk_id_curr, flag_own_car, CASE WHEN occupation_type IS NOT NULL THEN 'employed' ELSE 'nan' END AS occupied FROM application)""")
def enc_binary(dom: Domain) -> DataFrame:
    """Two text columns with at most two values; the missing one of the second is a label too."""
    rows = dom.application.select(
        "sk_id_curr", "flag_own_car", F.when(F.col("occupation_type").isNotNull(), "employed").alias("occupied"), "name_income_type")
    return encode.encode_binary(rows, encode.fit_encoding(rows)).drop("name_income_type")


_EDU = ["Higher education", "Incomplete higher", "Lower secondary", "Secondary / secondary special"]


@query("enc_one_hot", sql="SELECT sk_id_curr, " + ", ".join(
    f"CASE WHEN name_education_type = '{v}' THEN 1 ELSE 0 END AS {n}" for v, n in encode.one_hot_names("name_education_type", _EDU).items())
    + ", " + ", ".join(f"CASE WHEN occupation_type = 'NATION_{i}' THEN 1 ELSE 0 END AS occupation_type_NATION_{i}" for i in range(25)) + " FROM application")
def enc_one_hot(dom: Domain) -> DataFrame:
    rows = dom.application.select("sk_id_curr", "name_education_type", "occupation_type")
    return encode.encode_one_hot(rows, encode.fit_encoding(rows))


_SPARSE = ["name_income_type", "occupation_type", "code_gender"]


@query("enc_one_hot_sparse", sql="SELECT * FROM (WITH long AS (" + " UNION ALL ".join(f"SELECT sk_id_curr, {k} AS place, {c} AS value FROM application" for k, c in enumerate(_SPARSE)) + """),
    coded AS (SELECT place, value, row_number() OVER (ORDER BY place, value) - 1 AS code FROM (SELECT DISTINCT place, value FROM long WHERE value IS NOT NULL))
    SELECT sk_id_curr, (SELECT count(*) FROM coded) AS size, string_agg(code::VARCHAR, ',' ORDER BY code) AS ones FROM long JOIN coded USING (place, value) GROUP BY sk_id_curr)""")
def enc_one_hot_sparse(dom: Domain) -> DataFrame:
    """One-hot vectors through a distributed dictionary; the indices of the ones as text."""
    codes = materialize(encode.dictionary(dom.application, _SPARSE), "dictionary")
    return encode.sparse_one_hot(dom.application, _SPARSE, codes).select("sk_id_curr", "size", F.array_join("indices", ",").alias("ones"))


_TRAIN_FILL = ["amt_goods_price", "ext_source_1", "days_last_phone_change"]


@query("enc_train_median", sql="SELECT sk_id_curr, " + ", ".join(
    f"coalesce({c}, (SELECT median({c}) FROM application WHERE is_train = 1)) AS {c}" for c in _TRAIN_FILL) + " FROM application",
    digits=dict.fromkeys(_TRAIN_FILL, 6))
def enc_train_median(dom: Domain) -> DataFrame:
    rows = dom.application.select("sk_id_curr", "is_train", *_TRAIN_FILL)
    return encode.impute_train_median(rows, _TRAIN_FILL).drop("is_train")


STATS = ["amt_credit", "amt_income_total", "ext_source_1", "ext_source_2", "credit_income_ratio", "credit_term", "years_employed"]


@query("enc_feature_stats", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, median({c}) AS median, avg({c}) AS mean, stddev_samp({c}) AS std, quantile_cont({c}, 0.01) AS p01,
      quantile_cont({c}, 0.99) AS p99 FROM base_app WHERE is_train = 1""" for c in STATS), digits=dict.fromkeys(["median", "mean", "std", "p01", "p99"], 5))
def enc_feature_stats(dom: Domain) -> DataFrame:
    return encode.feature_stats(base(dom).filter("is_train = 1"), STATS)


# ---- weight of evidence ---------------------------------------------------------------------

QUANTILE_FEATURES = ["ext_source_1", "ext_source_2", "ext_source_3", "credit_term", "age_years", "credit_income_ratio"]
VALUE_FEATURES = ["code_gender", "name_income_type", "region_rating_client_w_city", "cnt_children"]
ALL_FEATURES = QUANTILE_FEATURES + VALUE_FEATURES
_TRAIN = "(SELECT * FROM base_app WHERE is_train = 1)"


def train_rows(dom: Domain) -> DataFrame:
    """Bins and WoE are fitted on the train applications only."""
    return base(dom).filter("is_train = 1")


def _binned(source: str, features: list[str], fit_where: str = "TRUE") -> str:
    """(feature, bin, y) rows: quantile bins numbered from 1, or the value as text."""
    parts = []
    for f in features:
        if f in VALUE_FEATURES:
            parts.append(f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS bin, target AS y FROM {source} WHERE {f} IS NOT NULL")
        else:
            grid = ", ".join(str(k / 10) for k in range(11))
            parts.append(f"""SELECT '{f}' AS feature, CAST(greatest(len(list_filter(e, lambda m: m < {f})), 1) AS VARCHAR) AS bin, target AS y
              FROM {source}, (SELECT list_sort(list_distinct(quantile_cont({f}, [{grid}]))) AS e FROM {source} WHERE {fit_where}) WHERE {f} IS NOT NULL""")
    return " UNION ALL ".join(parts)


def _woe_sql(source: str, features: list[str], where: str = "TRUE") -> str:
    rows = f"SELECT * FROM {source} WHERE {where}"
    binned = _binned(f"({rows})", features)
    return f"""SELECT feature, bin, events, total, total - events AS nonevents,
        (events + 5e-1) / (ev + 5e-1) AS pct_events, (total - events + 5e-1) / (nev + 5e-1) AS pct_nonevents,
        ln(((events + 5e-1) / (ev + 5e-1)) / ((total - events + 5e-1) / (nev + 5e-1))) AS woe,
        ((events + 5e-1) / (ev + 5e-1) - (total - events + 5e-1) / (nev + 5e-1))
          * ln(((events + 5e-1) / (ev + 5e-1)) / ((total - events + 5e-1) / (nev + 5e-1))) AS iv_part
      FROM (SELECT feature, bin, sum(y)::BIGINT AS events, count(*) AS total FROM ({binned}) GROUP BY feature, bin),
        (SELECT count(*) FILTER (WHERE target = 1) AS ev, count(*) FILTER (WHERE target = 0) AS nev FROM ({rows}))"""


WOE_DIGITS = {"pct_events": 8, "pct_nonevents": 8, "woe": 7, "iv_part": 8}


@query("woe_bin_quantile", sql=f"SELECT feature, bin, sum(y)::BIGINT AS events, count(*) AS total FROM ({_binned(_TRAIN, QUANTILE_FEATURES)}) GROUP BY feature, bin")
def woe_bin_quantile(dom: Domain) -> DataFrame:
    rows = feature_table(train_rows(dom), ["target", *QUANTILE_FEATURES])
    return woe.bin_counts(rows, woe.fit_bins(rows, QUANTILE_FEATURES))


@query("woe_bin_category", sql=f"SELECT feature, bin, sum(y)::BIGINT AS events, count(*) AS total FROM ({_binned(_TRAIN, VALUE_FEATURES)}) GROUP BY feature, bin")
def woe_bin_category(dom: Domain) -> DataFrame:
    rows = feature_table(train_rows(dom), ["target", *VALUE_FEATURES])
    return woe.bin_counts(rows, woe.fit_bins(rows, VALUE_FEATURES))


@query("woe_table", sql=_woe_sql(_TRAIN, ALL_FEATURES), digits=WOE_DIGITS)
def woe_table(dom: Domain) -> DataFrame:
    rows = feature_table(train_rows(dom), ["target", *ALL_FEATURES])
    return woe.woe_table(rows, woe.fit_bins(rows, ALL_FEATURES))


_FLAG = "CASE WHEN raw > 5e-1 THEN 'Suspicious' WHEN raw > 3e-1 THEN 'Strong' WHEN raw > 1e-1 THEN 'Medium' WHEN raw > 2e-2 THEN 'Weak' ELSE 'Useless' END"


@query("woe_iv", sql=f"SELECT feature, sum(iv_part) AS iv FROM ({_woe_sql(_TRAIN, ALL_FEATURES)}) GROUP BY feature", digits={"iv": 6})
def woe_iv(dom: Domain) -> DataFrame:
    rows = feature_table(train_rows(dom), ["target", *ALL_FEATURES])
    return woe.information_value(woe.woe_table(rows, woe.fit_bins(rows, ALL_FEATURES))).select("feature", "iv")


# a target that does depend on features, so that every grade can occur
_GRADED = """(SELECT * REPLACE (CASE WHEN ext_source_2 + (CASE WHEN code_gender = 'M' THEN 15e-2 ELSE 0e0 END) + coalesce(ext_source_3, 5e-1) * 3e-1 > 8e-1
  THEN 0 ELSE 1 END AS target) FROM base_app WHERE is_train = 1)"""


def _graded(dom: Domain) -> DataFrame:
    gender = F.when(F.col("code_gender") == "M", 0.15).otherwise(0.0)
    score = F.col("ext_source_2") + gender + F.coalesce(F.col("ext_source_3"), F.lit(0.5)) * 0.3
    graded = train_rows(dom).withColumn("target", F.when(score > 0.8, 0).otherwise(1))
    return feature_table(graded, ["target", *ALL_FEATURES])


@query("woe_iv_flag", sql=f"""SELECT feature, {_FLAG} AS flag FROM (SELECT feature, sum(iv_part) AS raw FROM ({_woe_sql(_GRADED, ALL_FEATURES)}) GROUP BY feature)""")
def woe_iv_flag(dom: Domain) -> DataFrame:
    rows = _graded(dom)
    return woe.information_value(woe.woe_table(rows, woe.fit_bins(rows, ALL_FEATURES))).select("feature", "flag")


@query("woe_screen", sql=f"""
    SELECT feature, iv, flag, CASE WHEN flag IN ('Useless', 'Suspicious') THEN 0 ELSE 1 END AS keep,
      row_number() OVER (ORDER BY iv DESC, feature)::INTEGER AS iv_rank
    FROM (SELECT feature, round_even(raw, 6) AS iv, {_FLAG} AS flag
      FROM (SELECT feature, sum(iv_part) AS raw FROM ({_woe_sql(_GRADED, ALL_FEATURES)}) GROUP BY feature))""", digits={"iv": 6})
def woe_screen(dom: Domain) -> DataFrame:
    return woe.screen(_graded(dom), ALL_FEATURES)


_FIT_FEATURES = ["ext_source_2", "credit_term", "code_gender"]


@query("woe_fit", sql=f"""
    SELECT w.feature, bin, woe, e[try_cast(bin AS INTEGER)] AS lo, e[try_cast(bin AS INTEGER) + 1] AS hi
    FROM ({_woe_sql('base_app', _FIT_FEATURES, 'is_train = 1')}) w LEFT JOIN (
      SELECT 'ext_source_2' AS feature, list_sort(list_distinct(quantile_cont(ext_source_2, [{', '.join(str(k / 10) for k in range(11))}]))) AS e
        FROM base_app WHERE is_train = 1
      UNION ALL SELECT 'credit_term', list_sort(list_distinct(quantile_cont(credit_term, [{', '.join(str(k / 10) for k in range(11))}])))
        FROM base_app WHERE is_train = 1) m ON m.feature = w.feature""", digits={"woe": 7, "lo": 6, "hi": 6})
def woe_fit(dom: Domain) -> DataFrame:
    """Fitted on the train rows only."""
    rows = feature_table(base(dom).filter("is_train = 1"), ["target", *_FIT_FEATURES])
    fitted = woe.fit_woe(rows, _FIT_FEATURES)
    return fitted.select("feature", F.coalesce("category", F.col("bin_id").cast("string")).alias("bin"), "woe", "lo", "hi")


def _apply_sql() -> str:
    out = "SELECT b.sk_id_curr"
    joins = ""
    for i, f in enumerate(ALL_FEATURES):
        out += f", coalesce(w{i}.woe, 0) AS {f}_woe"
        if f in VALUE_FEATURES:
            joins += f" LEFT JOIN w AS w{i} ON w{i}.feature = '{f}' AND w{i}.bin = b.{f}::VARCHAR"
        else:
            grid = ", ".join(str(k / 10) for k in range(11))
            joins += f""" CROSS JOIN (SELECT list_sort(list_distinct(quantile_cont({f}, [{grid}]))) AS e FROM base_app WHERE is_train = 1) AS m{i}
              LEFT JOIN w AS w{i} ON w{i}.feature = '{f}' AND b.{f} >= m{i}.e[1] AND b.{f} <= m{i}.e[len(m{i}.e)]
                AND w{i}.bin = CAST(greatest(len(list_filter(m{i}.e, lambda v: v < b.{f})), 1) AS VARCHAR)"""
    return f"SELECT * FROM (WITH w AS ({_woe_sql('base_app', ALL_FEATURES, 'is_train = 1')}) {out} FROM base_app b {joins})"


@query("woe_apply", sql=_apply_sql(), digits={f"{f}_woe": 7 for f in ALL_FEATURES})
def woe_apply(dom: Domain) -> DataFrame:
    """Train-fitted WoE of all features on all rows; test values outside the fitted range are neutral."""
    rows = feature_table(base(dom), ["sk_id_curr", "is_train", "target", *ALL_FEATURES])
    fitted = woe.fit_woe(rows.filter("is_train = 1"), ALL_FEATURES)
    return woe.apply_woe(rows, fitted).select("sk_id_curr", *[f"{f}_woe" for f in ALL_FEATURES])


@query("woe_equal_width", sql="""
    SELECT bin, sum(target)::BIGINT AS events, count(*) AS total FROM (
      SELECT target, CAST(greatest(len(list_filter(e, lambda m: m < credit_term)), 1) AS VARCHAR) AS bin FROM base_app,
        (SELECT [lo + (hi - lo) * k / 1e1 FOR k IN range(10)] || [hi] AS e FROM (SELECT min(credit_term) AS lo, max(credit_term) AS hi FROM base_app WHERE is_train = 1))
      WHERE is_train = 1
    ) GROUP BY bin""")
def woe_equal_width(dom: Domain) -> DataFrame:
    rows = train_rows(dom).select("target", "credit_term")
    return woe.bin_counts(rows, [woe.equal_width_bins(rows, "credit_term")]).select("bin", "events", "total")


@query("woe_flag_counts", sql=f"""SELECT flag, count(*) AS n_features FROM (
    SELECT {_FLAG} AS flag FROM (SELECT feature, sum(iv_part) AS raw FROM ({_woe_sql(_GRADED, ALL_FEATURES)}) GROUP BY feature)) GROUP BY flag""")
def woe_flag_counts(dom: Domain) -> DataFrame:
    return woe.flag_counts(woe.screen(_graded(dom), ALL_FEATURES))


@query("woe_history_features", sql=f"""SELECT feature, sum(iv_part) AS iv FROM ({_woe_sql('hist_filled', ['inst_late_ratio', 'prev_refused_ratio'], 'is_train = 1')}) GROUP BY feature""",
       digits={"iv": 6})
def woe_history_features(dom: Domain) -> DataFrame:
    """Rollup ratios have many equal values, so quantile edges repeat and bins merge."""
    features = ["inst_late_ratio", "prev_refused_ratio"]
    rows = feature_table(with_history(dom).filter("is_train = 1").fillna(0, subset=features), ["target", *features])
    return woe.information_value(woe.woe_table(rows, woe.fit_bins(rows, features))).select("feature", "iv")
