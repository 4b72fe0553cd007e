"""Tables built on the contributions of features to a score (`tree_explain` has those of boosted trees).

For a linear score the exact additive attribution of feature j is beta_j * (x_j - mean_j), so
its contributions are plain columns and scale like any projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.functions.nullsafe import melt
from lendmill.operators.scoring import top_factors

HASH_MULTIPLIER = 48271
HASH_MODULUS = 2147483647


def id_hash(key: str = "sk_id_curr", seed: int = 0) -> Column:
    """A portable hash of an integer id in [0, 2^31 - 1): the same in any SQL engine."""
    return F.pmod((F.col(key).cast("bigint") + seed) * HASH_MULTIPLIER, F.lit(HASH_MODULUS))


def sample_rows(df: DataFrame, n: int, key: str = "sk_id_curr", seed: int = 0) -> DataFrame:
    """n rows in hash order: a seeded sample that does not depend on the partitioning."""
    return df.orderBy(id_hash(key, seed), key).limit(n)


def contributions(df: DataFrame, coefficients: dict[str, float], means: dict[str, float] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One contribution column per feature; a missing value contributes 0."""
    if means is None:
        row = df.agg(*[F.avg(f).alias(f) for f in coefficients]).first()
        means = {f: row[f] or 0.0 for f in coefficients}
    cols = [
        F.coalesce((F.col(f).cast("double") - F.lit(float(means[f]))) * F.lit(float(b)), F.lit(0.0)).alias(f"{f}_contrib")
        for f, b in coefficients.items()
    ]
    return df.select("sk_id_curr", *keep, *cols)


def _long(contrib: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    renamed = contrib.select(*keep, *[F.col(f"{f}_contrib").alias(f) for f in features])
    return melt(renamed, features, keep=keep, value="contribution")


def global_rank(contrib: DataFrame, features: Sequence[str], top: int = 20) -> DataFrame:
    """Features by mean absolute contribution."""
    long = _long(contrib, features)
    return long.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs")).orderBy(F.desc("mean_abs"), "feature").limit(top)


def waterfall(contrib: DataFrame, features: Sequence[str], top: int = 15) -> DataFrame:
    """The largest contributions of the highest- and the lowest-PD client (ties: smaller id).

    The two rows are found by a map-side aggregate; ranking happens inside each row.
    """
    row = F.struct("pred_prob", "sk_id_curr", *[f"{f}_contrib" for f in features])
    known = contrib.filter(F.col("pred_prob").isNotNull())
    high = F.max_by(row, F.struct(F.col("pred_prob"), -F.col("sk_id_curr")))
    low = F.min_by(row, F.struct(F.col("pred_prob"), F.col("sk_id_curr")))
    clients = known.agg(high.alias("high"), low.alias("low")).select(
        F.inline(F.array(F.struct(F.lit("high").alias("client"), F.col("high").alias("r")), F.struct(F.lit("low").alias("client"), F.col("low").alias("r"))))
    )
    entries = F.array(*[
        F.struct((-F.abs(F.col(f"r.{f}_contrib"))).alias("size"), F.lit(f).alias("feature"), F.col(f"r.{f}_contrib").alias("contribution"))
        for f in features
    ])
    ranked = clients.select("client", F.col("r.sk_id_curr"), F.col("r.pred_prob"), F.posexplode(F.slice(F.sort_array(entries), 1, top)).alias("pos", "e"))
    return ranked.select("client", "sk_id_curr", "pred_prob", (F.col("pos") + 1).alias("rank"), "e.feature", "e.contribution")


def dependence(contrib_columns: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(feature, x, contribution, interaction value) rows for each listed pair.

    `contrib_columns` must carry the feature columns beside the contributions.
    """
    structs = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.lit(g).alias("interaction"), F.col(f).cast("double").alias("x"),
                 F.col(f"{f}_contrib").alias("contribution"), F.col(g).cast("double").alias("z"))
        for f, g in pairs
    ])
    return contrib_columns.select("sk_id_curr", F.inline(structs))


def by_tier(contrib: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean contribution per (tier, feature)."""
    long = _long(contrib, features, keep=["risk_tier"])
    return long.groupBy("risk_tier", "feature").agg(F.avg("contribution").alias("mean_contribution"))


def join_scores(sample: DataFrame, scored: DataFrame) -> DataFrame:
    """Scores of the sampled clients; clients without a score drop out."""
    scores = scored.select("sk_id_curr", "pred_prob", "risk_tier", "target")
    return sample.select("sk_id_curr").join(scores, "sk_id_curr", "left").dropna(subset=["pred_prob"])


def deviation_top(df: DataFrame, medians: dict[str, float | None], n: int = 3) -> DataFrame:
    """Per client the n features furthest from the median, one row per rank."""
    names = top_factors(df, medians, n)
    return df.select("sk_id_curr", F.posexplode(names).alias("pos", "feature")).select("sk_id_curr", (F.col("pos") + 1).alias("rank"), "feature")
