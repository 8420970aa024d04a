"""Scoring criteria for greedy information-theoretic selection.

Per-feature running state, one row per candidate feature:
``k, rel, sum_m, sum_c, max_d, sum_pos, valid`` where, over the selected
set S, m_j = I(X_k; X_j), c_j = I(X_k; X_j | Y):

* sum_m = sum m_j, sum_c = sum c_j
* max_d = max (m_j - c_j), sum_pos = sum max(0, m_j - c_j)

Scores (r = relevance, s = |S|; with S empty every criterion scores r):

=======  ===============================  =====================================
mim      r                                Lewis 1992
mifs     r - beta * sum m_j               Battiti 1994 (beta default 0.5)
jmi      r - (1/s) sum (m_j - c_j)        Yang & Moody 1999
mrmr     r - (1/s) sum m_j                Peng, Long & Ding 2005
icap     r - sum max(0, m_j - c_j)        Jakulin 2005
cmim     r - max_j (m_j - c_j)            Fleuret 2004
if       min_j [I(X_k X_j; Y) - I(X_j; Y)] = r - max_j (m_j - c_j)
=======  ===============================  =====================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Criterion names and the default criterion.
CRITERIA = ("mim", "mifs", "jmi", "mrmr", "icap", "cmim", "if")
DEFAULT_CRITERION = "mrmr"
DEFAULT_BETA = 0.5


def check_criterion(name: str) -> str:
    crit = name.lower()
    if crit not in CRITERIA:
        raise ValueError(f"unknown criterion {name!r}; expected one of {', '.join(CRITERIA)}")
    return crit


def initial_state(rel: DataFrame) -> DataFrame:
    """State before any selection, from (k, rel)."""
    return rel.selectExpr("CAST(k AS INT) AS k", "CAST(rel AS DOUBLE) AS rel", "0.0D AS sum_m",
                          "0.0D AS sum_c", "CAST(NULL AS DOUBLE) AS max_d", "0.0D AS sum_pos",
                          "true AS valid")


def score_sql(criterion: str, n_selected: int, beta: float = DEFAULT_BETA) -> str:
    """SQL text of the score of a state row once ``n_selected`` features are chosen."""
    crit = check_criterion(criterion)
    if n_selected == 0 or crit == "mim":
        return "rel"
    s = f"{float(n_selected)!r}D"
    if crit == "mifs":
        return f"rel - {float(beta)!r}D * sum_m"
    if crit == "jmi":
        return f"rel - (sum_m - sum_c) / {s}"
    if crit == "mrmr":
        return f"rel - sum_m / {s}"
    if crit == "icap":
        return "rel - sum_pos"
    return "rel - max_d"       # cmim, if


# ------------------------------------------------------- several criteria at once

def initial_states(rel: DataFrame, criteria: list[str]) -> DataFrame:
    """One state row per (criterion, feature)."""
    names = ", ".join(f"'{check_criterion(c)}'" for c in criteria)
    return initial_state(rel).selectExpr(f"explode(array({names})) AS crit", "*")


def score_case_sql(criteria: list[str], n_selected: int, beta: float = DEFAULT_BETA) -> str:
    """Score of a multi-criterion state row, dispatched on its ``crit`` column."""
    arms = " ".join(f"WHEN '{c}' THEN {score_sql(c, n_selected, beta)}" for c in criteria)
    return f"CASE crit {arms} END"


def update_many(state: DataFrame, info: DataFrame, winners: dict[str, int],
                broadcast_info: bool) -> DataFrame:
    """Mark each criterion's winner and fold in (j, k, mi, cmi) of that winner."""
    arms = " ".join(f"WHEN '{c}' THEN {int(j)}" for c, j in winners.items())
    marked = state.selectExpr("*", f"CASE crit {arms} END AS j").selectExpr(
        "crit", "k", "rel", "sum_m", "sum_c", "max_d", "sum_pos", "valid AND k <> j AS valid", "j")
    side = F.broadcast(info) if broadcast_info else info
    j = marked.join(side, ["j", "k"], "left").selectExpr(
        "crit", "k", "rel", "sum_m", "sum_c", "max_d", "sum_pos", "valid",
        "coalesce(mi, 0.0D) AS m", "coalesce(mi, 0.0D) - coalesce(cmi, 0.0D) AS d",
        "coalesce(cmi, 0.0D) AS c")
    return j.selectExpr(
        "crit", "k", "rel",
        "CASE WHEN valid THEN sum_m + m ELSE sum_m END AS sum_m",
        "CASE WHEN valid THEN sum_c + c ELSE sum_c END AS sum_c",
        "CASE WHEN valid THEN greatest(max_d, d) ELSE max_d END AS max_d",
        "CASE WHEN valid THEN sum_pos + greatest(d, 0.0D) ELSE sum_pos END AS sum_pos",
        "valid")


# ------------------------------------------------------------- scores as upper bounds

def lazy_bound_sql(criterion: str) -> str:
    """SQL text of the score of a state row against the winners it has seen: no more than its score against later ones too."""
    return "rel - sum_pos" if criterion == "icap" else "coalesce(rel - max_d, double('infinity'))"


def update_lazily(state: DataFrame, info: DataFrame, won: list[int]) -> DataFrame:
    """Fold (j, k, mi, cmi) of the winners a feature has not seen, in their order; features absent from ``info`` stay."""
    place = F.element_at(F.create_map(*[F.lit(x) for i, j in enumerate(won) for x in (int(j), i)]), F.col("j"))
    per = info.groupBy("k").agg(F.array_sort(F.collect_list(F.struct(place.alias("i"), (F.coalesce("mi", F.lit(0.0)) - F.coalesce("cmi", F.lit(0.0))).alias("d")))).alias("ds"))
    new = state.join(per, "k", "left").withColumn("ds", F.filter("ds", lambda e: e["i"] >= F.col("seen")))
    fold = "valid AND ds IS NOT NULL"
    return new.selectExpr(
        "k", "rel", "sum_m", "sum_c",
        f"CASE WHEN {fold} THEN aggregate(ds, max_d, (a, e) -> greatest(a, e.d)) ELSE max_d END AS max_d",
        f"CASE WHEN {fold} THEN aggregate(ds, sum_pos, (a, e) -> a + greatest(e.d, 0.0D)) ELSE sum_pos END AS sum_pos",
        "valid", f"CASE WHEN {fold} THEN {len(won)} ELSE seen END AS seen")
