"""Model queries on the whole feature table. Models have no SQL twin: what SQL can say about them is checked, the rest is tested.

What several queries share (the table, the fitted candidates) is made once for a session and a data folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators import boosting, explain, isotonic, pd_model, scoring, tree_explain
from lendmill.operators.quantiles import median
from lendmill.plans.evaluate_queries import folds_sql
from lendmill.plans.model_table import model_table
from lendmill.plans.portfolio import base
from lendmill.plans.registry import query
from lendmill.session import materialize
from lendmill.sources.domain import Domain

# The candidates: the forest counts gaps as 0, the logistic model takes medians, the boosted ones see the gaps.
FOREST = pd_model.ForestParams()
BOOSTED = {"boosted_by_leaf": pd_model.BY_LEAF, "boosted_by_depth": pd_model.BY_DEPTH}
CANDIDATES = ["logistic", "forest", *BOOSTED]
# The candidate whose first fold's model is explained.
EXPLAINED = "boosted_by_leaf"


_TRAINING: dict[tuple[str, str, bool], DataFrame] = {}
_BINNED: dict[tuple[str, str], boosting.Binned] = {}
_FIRST: dict[tuple[str, str], boosting.Model] = {}


def training(dom: Domain, gaps: bool = False) -> DataFrame:
    """Train rows with folds and class weights, written once: every fit reads them many times."""
    key = (dom.spark.sparkContext.applicationId, dom.folder, gaps)
    if key not in _TRAINING:
        table = model_table(dom)
        rows = (table.gaps if gaps else table.filled).filter("is_train = 1").drop("is_train")
        _TRAINING[key] = materialize(pd_model.with_balance(pd_model.stratified_folds(rows)), "training", "zstd")
    return _TRAINING[key]


def binned(dom: Domain) -> boosting.Binned:
    """The train rows as quantised blocks, written once for all boosted candidates."""
    key = (dom.spark.sparkContext.applicationId, dom.folder)
    if key not in _BINNED:
        _BINNED[key] = boosting.quantise(training(dom, gaps=True), model_table(dom).selected, "target", "weight", "fold")
    return _BINNED[key]


def testing(dom: Domain, gaps: bool = False) -> DataFrame:
    table = model_table(dom)
    return (table.gaps if gaps else table.filled).filter("is_train = 0").drop("is_train", "target")


def _out_of_fold(dom: Domain, name: str) -> pd_model.Fitted:
    features = model_table(dom).selected
    if name in BOOSTED:
        first = _FIRST.get((dom.spark.sparkContext.applicationId, dom.folder)) if name == EXPLAINED else None
        fitted = pd_model.boosted_out_of_fold(training(dom, gaps=True), features, BOOSTED[name], data=binned(dom), known={0: first} if first else None)
    else:
        make = {"logistic": lambda: pd_model.logistic(features, gaps=False), "forest": lambda: pd_model.forest(features, FOREST)}[name]
        fitted = pd_model.out_of_fold(training(dom), make)
    return pd_model.Fitted(fitted.models, materialize(fitted.oof, "oof"))


_FITTED: dict[tuple[str, str, str], pd_model.Fitted] = {}


def fitted(dom: Domain, name: str) -> pd_model.Fitted:
    """Five fold models of a candidate and their out-of-fold scores."""
    key = (dom.spark.sparkContext.applicationId, dom.folder, name)
    if key not in _FITTED:
        _FITTED[key] = _out_of_fold(dom, name)
    return _FITTED[key]


@dataclass(frozen=True)
class Winner:
    name: str
    fitted: pd_model.Fitted
    calibrator: isotonic.Curve
    edges: tuple[float, ...]
    gaps: bool


def _board(dom: Domain) -> DataFrame:
    return pd_model.leaderboard({name: fitted(dom, name).oof for name in CANDIDATES})


def winner(dom: Domain) -> Winner:
    """The candidate with the best out-of-fold AUC, its calibration and the tier edges of its calibrated scores."""
    name = _board(dom).select("model").first()["model"]
    best = fitted(dom, name)
    calibrator = pd_model.fit_calibrator(best.oof)
    edges = scoring.fit_tiers(pd_model.calibrate(best.oof, calibrator), "pd_calibrated").edges
    return Winner(name, best, calibrator, edges, name in BOOSTED)


def _holdout(rows: DataFrame, pipeline) -> DataFrame:
    model = pipeline.fit(rows.filter("fold <> 0"))
    return scoring.positive_probability(rows.filter("fold = 0"), model, "pred_prob").select("sk_id_curr", "target", "pred_prob")


@query("mod_logistic")
def mod_logistic(dom: Domain) -> DataFrame:
    return _holdout(training(dom), pd_model.logistic(model_table(dom).selected, gaps=False))


@query("mod_forest")
def mod_forest(dom: Domain) -> DataFrame:
    """300 trees of depth 10."""
    return _holdout(training(dom), pd_model.forest(model_table(dom).selected, FOREST))


@query("mod_gbt")
def mod_gbt(dom: Domain) -> DataFrame:
    """Up to 1,000 rounds with gaps as they are, ended by 30 rounds without gain on one fold, scored on another."""
    rows = training(dom, gaps=True)
    data = boosting.quantise(rows.filter("fold <> 0"), model_table(dom).selected, "target", "weight", "fold")
    model = boosting.fit(data, pd_model.BY_LEAF, held=1)
    return boosting.score(rows.filter("fold = 0"), {"pred_prob": model}, ["sk_id_curr", "target"])


@query("mod_oof")
def mod_oof(dom: Domain) -> DataFrame:
    """Out-of-fold scores of the train rows and mean scores of the test rows, boosted by leaf."""
    models = fitted(dom, "boosted_by_leaf")
    test = pd_model.mean_score(testing(dom, gaps=True).select("sk_id_curr", *model_table(dom).selected), models.models)
    return models.oof.select("sk_id_curr", "fold", "pred_prob").unionByName(test.select("sk_id_curr", F.lit(None).cast("int").alias("fold"), "pred_prob"))


@query("mod_leaderboard")
def mod_leaderboard(dom: Domain) -> DataFrame:
    """All candidates over five folds."""
    return _board(dom)


_FOLD_ROWS = f"SELECT fold, count(*) AS n_rows, sum(target)::BIGINT AS n_positives FROM ({folds_sql('(SELECT * FROM application WHERE is_train = 1)')}) GROUP BY fold"


@query("mod_fold_checks", sql=" UNION ALL ".join(f"SELECT '{m}' AS model, fold, n_rows, n_positives, n_rows AS n_in_range, n_rows AS n_ids FROM ({_FOLD_ROWS})" for m in CANDIDATES))
def mod_fold_checks(dom: Domain) -> DataFrame:
    """Per candidate and fold: rows, positives, scores between 0 and 1, distinct clients."""
    parts = []
    for name in CANDIDATES:
        rows = fitted(dom, name).oof
        parts.append(rows.groupBy("fold").agg(
            F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows"), F.sum("target").cast("bigint").alias("n_positives"),
            F.count_if(F.col("pred_prob").between(0, 1)).alias("n_in_range"), F.count_distinct("sk_id_curr").alias("n_ids"),
        ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("model", "fold", "n_rows", "n_positives", "n_in_range", "n_ids")


@query("mod_winner_scored")
def mod_winner_scored(dom: Domain) -> DataFrame:
    """The best of all candidates by out-of-fold AUC, its calibration and tier edges, and the scored test table."""
    best = winner(dom)
    features = model_table(dom).selected
    test = pd_model.calibrate(pd_model.mean_score(testing(dom, best.gaps).select("sk_id_curr", *features), best.fitted.models), best.calibrator)
    return test.select("sk_id_curr", F.lit(best.name).alias("model"), "pred_prob", "pd_calibrated", scoring.assign_tier(F.col("pd_calibrated"), best.edges).alias("risk_tier"))


# Isotonic fit in closed form over the distinct scores: max over a <= i of min over b >= i of the mean of a..b;
# other scores lie on the line between their neighbours.
_ISOTONIC = f"""
    WITH fitted AS (SELECT score, n, row_number() OVER (ORDER BY score) AS i, sum(n) OVER w AS cn, sum(bad) OVER w AS cb, bad FROM (
        SELECT pred_prob AS score, count(*)::DOUBLE AS n, sum(target)::DOUBLE AS bad FROM (
          SELECT a.*, fold FROM application a JOIN ({folds_sql('(SELECT * FROM application WHERE is_train = 1)')}) f ON f.sk_id_curr = a.sk_id_curr) WHERE fold <> 0 GROUP BY 1)
      WINDOW w AS (ORDER BY score ROWS UNBOUNDED PRECEDING)),
    means AS (SELECT a.i AS a, b.i AS b, (b.cb - a.cb + a.bad) / (b.cn - a.cn + a.n) AS m FROM fitted a JOIN fitted b ON a.i <= b.i),
    lows AS (SELECT a, b AS i, min(m) OVER (PARTITION BY a ORDER BY b DESC ROWS UNBOUNDED PRECEDING) AS low FROM means),
    curve AS (SELECT f.score, max(l.low) AS y FROM lows l JOIN fitted f ON f.i = l.i GROUP BY f.score),
    scores AS (SELECT DISTINCT pred_prob AS s FROM application),
    near AS (SELECT s, (SELECT max(score) FROM curve WHERE score <= s) AS lo, (SELECT min(score) FROM curve WHERE score >= s) AS hi FROM scores),
    line AS (SELECT s, CASE WHEN lo IS NULL THEN h.y WHEN hi IS NULL OR lo = hi THEN l.y ELSE l.y + (h.y - l.y) * (s - lo) / (hi - lo) END AS y
      FROM near LEFT JOIN curve l ON l.score = lo LEFT JOIN curve h ON h.score = hi)
    SELECT sk_id_curr, target, pred_prob, least(greatest(y, 0e0), 1e0) AS pd_calibrated FROM application JOIN line ON s = pred_prob"""


@query("mod_calibrate", sql=f"SELECT * FROM ({_ISOTONIC})", digits={"pd_calibrated": 8})
def mod_calibrate(dom: Domain) -> DataFrame:
    """Isotonic calibration of the given scores, fitted on 80 % of the train rows, applied to all."""
    rows = dom.application.select("sk_id_curr", "is_train", "target", "pred_prob")
    calibrator = pd_model.fit_calibrator(rows.filter("is_train = 1"))
    return pd_model.calibrate(rows, calibrator).select("sk_id_curr", "target", "pred_prob", "pd_calibrated")


# Trials of the registered search; README gives the time of a full one.
TRIALS = 9


@query("mod_tune")
def mod_tune(dom: Domain) -> DataFrame:
    """Random settings over the full ranges, three folds, every trial to its end."""
    rows = training(dom, gaps=True).withColumn("fold", F.pmod(F.col("fold"), F.lit(3)))
    return pd_model.tune(rows, model_table(dom).selected, trials=TRIALS)


# ---- explanations of the fitted model ----------------------------------------------------------

_EXPLAINED: dict[tuple[str, str], DataFrame] = {}
# Feature and interaction of each dependence view; a pair whose feature was not selected is left out.
PAIRS = [("ext_source_2", "ext_source_3"), ("credit_income_ratio", "age_years"), ("bureau_days_credit_mean", "bureau_bad_debt_flag")]
HELD = ["ext_source_2", "ext_source_3", "credit_income_ratio", "age_years"]


def explained_model(dom: Domain) -> boosting.Model:
    """The first fold's boosted model; it needs none of the other folds' models, and they take it over where they are fitted later."""
    app = dom.spark.sparkContext.applicationId
    if (app, dom.folder, EXPLAINED) in _FITTED:
        return _FITTED[app, dom.folder, EXPLAINED].models[0]
    if (app, dom.folder) not in _FIRST:
        _FIRST[app, dom.folder] = boosting.fit(binned(dom), BOOSTED[EXPLAINED], held=0)
    return _FIRST[app, dom.folder]


def _contributions(dom: Domain) -> DataFrame:
    """Contributions of every feature to the margin of every train row, with its probability and features; written once."""
    key = (dom.spark.sparkContext.applicationId, dom.folder)
    if key not in _EXPLAINED:
        rows = model_table(dom).gaps.filter("is_train = 1")
        model = explained_model(dom)
        found = tree_explain.tree_contributions(rows, model, keep=[c for c in rows.columns if c not in ("sk_id_curr", "target", "is_train")])
        _EXPLAINED[key] = materialize(found.withColumn("pred_prob", 1 / (1 + F.exp(-F.col("margin")))), "contributions")
    return _EXPLAINED[key]


@query("xai_contrib")
def xai_contrib(dom: Domain) -> DataFrame:
    """Shapley values of the boosted model's margin, one column per feature."""
    features = model_table(dom).selected
    return _contributions(dom).select("sk_id_curr", F.lit(tree_explain.mean_margin(explained_model(dom))).alias("mean_margin"), "margin", *[f"{f}_contrib" for f in features])


@query("xai_additivity", sql="SELECT count(*) AS n_rows, count(*) AS n_adding_up FROM application WHERE is_train = 1")
def xai_additivity(dom: Domain) -> DataFrame:
    """Rows whose contributions add up to their margin."""
    features = model_table(dom).selected
    total = F.aggregate(F.array(*[f"{f}_contrib" for f in features]), F.lit(tree_explain.mean_margin(explained_model(dom))), lambda s, x: s + x)
    return _contributions(dom).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(total - F.col("margin")) < 1e-8).alias("n_adding_up"))


@query("xai_global_rank")
def xai_global_rank(dom: Domain) -> DataFrame:
    return explain.global_rank(_contributions(dom), model_table(dom).selected)


@query("xai_waterfall")
def xai_waterfall(dom: Domain) -> DataFrame:
    return explain.waterfall(_contributions(dom), model_table(dom).selected)


@query("xai_dependence")
def xai_dependence(dom: Domain) -> DataFrame:
    selected = model_table(dom).selected
    pairs = [(f, g) for f, g in PAIRS if f in selected and g in selected] or [(selected[0], selected[-1])]
    return explain.dependence(_contributions(dom), pairs)


@query("xai_by_tier")
def xai_by_tier(dom: Domain) -> DataFrame:
    """Mean contribution per feature in the tiers of the model's own scores."""
    rows = _contributions(dom)
    tiers = scoring.fit_tiers(rows)
    return explain.by_tier(rows.withColumn("risk_tier", scoring.risk_tier(F.col("pred_prob"), tiers)), model_table(dom).selected)


@query("xai_pdp")
def xai_pdp(dom: Domain) -> DataFrame:
    """Partial dependence of four features of the boosted model, over all train rows in one pass."""
    rows = model_table(dom).gaps.filter("is_train = 1")
    held = [f for f in HELD if f in model_table(dom).selected]
    return tree_explain.partial_dependence(rows, explained_model(dom), tree_explain.grid(rows, held, 50))


# ---- scoring with the winner -------------------------------------------------------------------


@query("sco_ensemble")
def sco_ensemble(dom: Domain) -> DataFrame:
    """Mean of the winner's five fold models, calibrated on their out-of-fold scores."""
    best = winner(dom)
    rows = testing(dom, best.gaps).select("sk_id_curr", *model_table(dom).selected)
    return scoring.ensemble(rows, best.fitted.models, best.calibrator).select("sk_id_curr", "pd_raw", "pd_calibrated")


def _applications(dom: Domain) -> DataFrame:
    """Scoring requests with their gaps."""
    return base(dom).select("sk_id_curr", "amt_credit", "amt_income_total", "amt_annuity", "amt_goods_price", "age_years", "years_employed", "cnt_children",
                            "ext_source_1", "ext_source_2", "ext_source_3", F.col("region_rating_client_w_city").cast("double").alias("region_rating_client_w_city"))


@query("sco_batch")
def sco_batch(dom: Domain) -> DataFrame:
    """All applications in one plan, made five years younger: those under 18 come back as 'Unknown'.

    A request holds the applicant's own fields; every other feature takes its train median.
    """
    best = winner(dom)
    table = model_table(dom)
    aged = _applications(dom).withColumn("age_years", F.col("age_years") - 5)
    medians = table_medians(dom)
    return scoring.score_batch(aged, best.fitted.models, best.calibrator, {f: medians[f] for f in table.selected}, best.edges)


def table_medians(dom: Domain) -> dict[str, float]:
    """Train medians of the selected features; those made of others are included."""
    table = model_table(dom)
    made = [f for f in table.selected if f not in table.medians]
    found = median(table.filled.filter("is_train = 1"), made) if made else {}
    return table.medians | {f: v or 0.0 for f, v in found.items()}
