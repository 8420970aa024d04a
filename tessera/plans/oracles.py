"""DuckDB texts for the driver queries (same names as ``catalog.QUERIES``)."""

from __future__ import annotations

from tessera.plans import catalog as Q
from tessera.plans.views import SPA_THRESHOLD
from tessera.operators.criteria import CRITERIA
from tessera.operators.split import HASH_SPACE
from tessera.plans.oracle_sql import (EMB, FAC, LIN, RAT, RATLINE, REL_CELLS, ROW_HASH, SPA, SPLIT,
                                      SVML, SVMV, SVMV_UNWEIGHTED, SVMV_WEIGHTED, TRAIN_CUT, R,
                                      cells_given, greedy_ctes, info_select, selected_union,
                                      selection_sql, sgd_chain, md5_hash)

ORACLES: dict[str, str] = {}

# ------------------------------------------------------------ feature selection

ORACLES["fs_training_rows"] = f"""WITH {EMB}
SELECT id, CAST(y AS DOUBLE) AS label, CAST(len(x) AS INTEGER) AS n_features FROM emb"""

ORACLES["unpivot_dense"] = f"""WITH {EMB}
SELECT id, CAST(k AS INTEGER) AS k, CAST(v AS INTEGER) AS v, CAST(y AS INTEGER) AS y FROM lf"""

ORACLES["contingency_counts"] = f"""WITH {LIN},
lf AS (SELECT y, generate_subscripts(x, 1) - 1 AS k, unnest(x) AS v FROM lin)
SELECT CAST(k AS INTEGER) AS k, CAST(v AS INTEGER) AS v, CAST(y AS INTEGER) AS y,
       CAST(count(*) AS BIGINT) AS c
FROM lf GROUP BY k, v, y"""

ORACLES["mi_relevance"] = f"""WITH {EMB},
info AS ({info_select(REL_CELLS)})
SELECT CAST(k AS INTEGER) AS k, {R('rel')} AS mi FROM info"""

_J = "SELECT k FROM relv ORDER BY round(rel, 10) DESC, k LIMIT 1"

ORACLES["mi_redundancy"] = f"""WITH {EMB},
relv AS ({info_select(REL_CELLS)}),
red AS ({info_select(cells_given(_J))})
SELECT CAST(k AS INTEGER) AS k, {R('mi')} AS mi FROM red"""

ORACLES["cmi_redundancy"] = f"""WITH {EMB},
relv AS ({info_select(REL_CELLS)}),
red AS ({info_select(cells_given(_J))})
SELECT CAST(k AS INTEGER) AS k, {R('cmi')} AS cmi FROM red"""

ORACLES["score_update_lookup"] = f"""WITH {EMB},
{greedy_ctes('mrmr', 2)}
SELECT CAST(k AS INTEGER) AS k, {R('rel - sum_m / 1.0')} AS score FROM st1 WHERE valid"""

ORACLES["argmax_feature"] = f"""WITH {EMB},
{greedy_ctes('mrmr', 2)}
SELECT CAST(k AS INTEGER) AS feat, {R('score')} AS score FROM b2"""

for _crit in CRITERIA:
    ORACLES[f"select_{_crit}"] = selection_sql(EMB, _crit, Q.SELECT_N)

_MODEL = f"""WITH {EMB},
{greedy_ctes('mrmr', Q.MODEL_N)},
sel AS ({selected_union(Q.MODEL_N)})"""

ORACLES["selected_sorted"] = _MODEL + """
SELECT CAST(row_number() OVER (ORDER BY feat) - 1 AS INTEGER) AS pos, feat FROM sel"""

ORACLES["fs_model_roundtrip"] = ORACLES["selected_sorted"]

ORACLES["selected_report"] = _MODEL + """
SELECT CAST(feat + 1 AS INTEGER) AS feature, printf('%.4f', score) AS score FROM sel"""

ORACLES["maxrel_report"] = f"""WITH {EMB},
relv AS ({info_select(REL_CELLS)})
SELECT CAST(k + 1 AS INTEGER) AS feature, printf('%.4f', rel) AS score
FROM relv ORDER BY round(rel, 10) DESC, k LIMIT {Q.MAXREL_N}"""

_dense_keep = ", ".join(str(i) for i in sorted(Q.SLICE_DENSE))
ORACLES["slice_dense"] = f"""WITH {EMB},
keep AS (SELECT unnest([{_dense_keep}]) AS k, generate_subscripts([{_dense_keep}], 1) - 1 AS new_k)
SELECT lf.id, CAST(keep.new_k AS INTEGER) AS k, CAST(lf.v AS INTEGER) AS v
FROM lf JOIN keep ON lf.k = keep.k"""

_sparse_keep = ", ".join(str(i) for i in sorted(set(Q.SLICE_SPARSE)))
ORACLES["slice_sparse"] = f"""WITH {SPA},
keep AS (SELECT unnest([{_sparse_keep}]) AS k, generate_subscripts([{_sparse_keep}], 1) - 1 AS new_k)
SELECT spa.id, CAST(keep.new_k AS INTEGER) AS k, CAST(spa.v AS INTEGER) AS v
FROM spa JOIN keep ON spa.k = keep.k"""

ORACLES["fs_transform"] = _MODEL + """,
keep AS (SELECT feat AS k, row_number() OVER (ORDER BY feat) - 1 AS new_k FROM sel)
SELECT lf.id, CAST(keep.new_k AS INTEGER) AS k, CAST(lf.v AS INTEGER) AS v
FROM lf JOIN keep ON lf.k = keep.k"""

ORACLES["assemble_sparse_columns"] = f"""WITH {SPA}
SELECT CAST(k AS INTEGER) AS k, CAST(count(*) AS BIGINT) AS n_nonzero,
       CAST(sum(id * v) AS BIGINT) AS checksum
FROM spa GROUP BY k"""

ORACLES["sparse_column_layout"] = f"""WITH {SPA}
SELECT CAST(k AS INTEGER) AS k, id, CAST(v AS INTEGER) AS v FROM spa"""

ORACLES["sparse_column_chunks"] = f"""WITH {SPA},
n AS (SELECT count(*) AS n FROM embeddings),
g AS (SELECT k, id // {Q.COLUMN_CHUNK} AS chunk, count(*) AS stored, sum((id % {Q.COLUMN_CHUNK} + 1) * v) AS checksum FROM spa GROUP BY 1, 2),
s AS (SELECT *, least({Q.COLUMN_CHUNK}, (SELECT n FROM n) - chunk * {Q.COLUMN_CHUNK}) AS size FROM g)
SELECT CAST(k AS INTEGER) AS k, CAST(chunk AS BIGINT) AS chunk, stored >= 0.5 * size AS dense, CAST(size AS INTEGER) AS size, CAST(checksum AS BIGINT) AS checksum FROM s"""
ORACLES["sparse_column_round_trip"] = ORACLES["sparse_column_layout"]

ORACLES["mi_relevance_sparse"] = f"""WITH {SPA},
info AS ({info_select(REL_CELLS)})
SELECT CAST(k AS INTEGER) AS k, {R('rel')} AS mi FROM info"""

ORACLES["mi_redundancy_sparse"] = f"""WITH {SPA},
relv AS ({info_select(REL_CELLS)}),
red AS ({info_select(cells_given(_J))})
SELECT CAST(k AS INTEGER) AS k, {R('mi')} AS mi, {R('cmi')} AS cmi FROM red"""

for _crit in ("jmi", "mrmr"):
    ORACLES[f"select_bit_sliced_{_crit}"] = ORACLES[f"select_{_crit}"]
for _crit in ("icap", "cmim", "if"):
    ORACLES[f"select_lazy_{_crit}"] = ORACLES[f"select_{_crit}"]
ORACLES["contingency_bit_sliced"] = ORACLES["contingency_counts"]
ORACLES["select_mrmr_sparse"] = selection_sql(SPA, "mrmr", Q.SELECT_N)
ORACLES["fs_fit_sparse_vectors"] = ORACLES["select_mrmr_sparse"]


# ------------------------------------------------------------- sources and checks


_RATPARSE = RATLINE + """,
p AS (SELECT value, string_split(value, '::') AS f FROM ratline),
t AS (SELECT value,
             CASE WHEN len(f) = 4 THEN TRY_CAST(f[1] AS INTEGER) END AS "user",
             CASE WHEN len(f) = 4 THEN TRY_CAST(f[2] AS INTEGER) END AS item,
             CASE WHEN len(f) = 4 THEN TRY_CAST(f[3] AS FLOAT) END AS rating,
             CASE WHEN len(f) = 4 THEN TRY_CAST(f[4] AS BIGINT) END AS ts
      FROM p)"""
_GOOD = '"user" IS NOT NULL AND item IS NOT NULL AND rating IS NOT NULL AND ts IS NOT NULL'

ORACLES["ratings_parse"] = f"""WITH {_RATPARSE}
SELECT "user", item, CAST(rating AS DOUBLE) AS rating, ts FROM t WHERE {_GOOD}"""

ORACLES["ratings_bad_lines"] = f"""WITH {_RATPARSE}
SELECT value AS line FROM t WHERE NOT ({_GOOD})"""

ORACLES["ratings_csv_scan"] = f"""WITH {RAT}
SELECT CAST("user" AS BIGINT) AS "user", CAST(item AS BIGINT) AS item, rating,
       CAST(ts AS VARCHAR) AS ts FROM rat"""

_FEED = f"""{RAT},
feed AS (SELECT *, concat_ws(',', CAST("user" AS VARCHAR), CAST(item AS VARCHAR), CAST(rating AS VARCHAR), CAST(ts AS VARCHAR)) AS line FROM rat),
kinds AS (SELECT *, substr(md5(line), 1, 1) AS kind FROM feed)"""
ORACLES["ratings_csv_files"] = f"""WITH {_FEED}
SELECT CAST("user" AS BIGINT) AS "user", CAST(item AS BIGINT) AS item, rating, CAST(ts AS VARCHAR) AS ts FROM kinds WHERE kind NOT IN ('0', '1')"""
ORACLES["ratings_csv_files_bad"] = f"""WITH {_FEED}
SELECT concat_ws(',', CAST("user" AS VARCHAR), CAST(item AS VARCHAR), CASE kind WHEN '0' THEN CAST(rating AS VARCHAR) ELSE 'n/a' END,
                 CASE kind WHEN '1' THEN CAST(ts AS VARCHAR) END) AS line FROM kinds WHERE kind IN ('0', '1')"""
ORACLES["split_exact"] = f"""WITH {SPLIT},
n AS (SELECT *, row_number() OVER (ORDER BY h, "user", item) AS pos, count(*) OVER () AS n FROM rat_b)
SELECT "user", item, rating, ts, CASE WHEN pos <= floor(0.8::DOUBLE * n + 0.5::DOUBLE) THEN 'train' ELSE 'test' END AS side FROM n"""
ORACLES["split_exact_repeated_keys"] = f"""WITH {RAT}
SELECT CAST(floor(0.5::DOUBLE * count(*) + 0.5::DOUBLE) AS BIGINT) AS n_train, CAST(count(*) - floor(0.5::DOUBLE * count(*) + 0.5::DOUBLE) AS BIGINT) AS n_test FROM rat"""
ORACLES["labeled_parse"] = """WITH e AS (
  SELECT vec_id AS id, CAST(CAST(label < 5 AS INTEGER) AS DOUBLE) AS label,
         generate_subscripts(embedding, 1) - 1 AS k, unnest(embedding) AS e FROM embeddings)
SELECT id, label, CAST(k AS INTEGER) AS k,
       CAST(CAST(round(CAST(e AS DOUBLE) * 1000.0::DOUBLE) AS INTEGER) AS DOUBLE) AS v FROM e"""

ORACLES["label_domain_violations"] = """SELECT doc_id, CAST(quality + toxic AS DOUBLE) AS label
FROM documents JOIN labels USING (doc_id)
WHERE CAST(quality + toxic AS DOUBLE) NOT IN (0.0, 1.0)"""

ORACLES["byte_range_violations"] = """SELECT doc_id FROM (
  SELECT doc_id, [CAST(n_chars AS DOUBLE), CAST(quality AS DOUBLE), CAST(toxic AS DOUBLE)] AS f
  FROM documents JOIN labels USING (doc_id))
WHERE len(list_filter(f, lambda v: v < -128 OR v > 127 OR v % 1 <> 0)) > 0"""

ORACLES["dimension_check"] = """SELECT CAST(min(len(embedding)) AS INTEGER) AS min_dim,
       CAST(max(len(embedding)) AS INTEGER) AS max_dim FROM embeddings"""

# ------------------------------------------------------------------------ splits

ORACLES["split_train"] = f"WITH {SPLIT}\nSELECT * FROM train"
ORACLES["split_test"] = f"WITH {SPLIT}\nSELECT * FROM test"
ORACLES["split_counts"] = f"""WITH {SPLIT}
SELECT CAST(count(*) FILTER (WHERE h < {TRAIN_CUT}) AS BIGINT) AS n_train,
       CAST(count(*) FILTER (WHERE h >= {TRAIN_CUT}) AS BIGINT) AS n_test FROM rat_b"""

ORACLES["row_ids"] = f"""WITH {RAT}
SELECT *, CAST(row_number() OVER (ORDER BY "user", item) - 1 AS BIGINT) AS rid FROM rat"""

ORACLES["row_ids_orders"] = """
SELECT *, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS rid FROM orders"""

ORACLES["subset_ids"] = f"""WITH {RAT}
SELECT * FROM (SELECT 'user' AS kind, CAST("user" AS BIGINT) AS id
               FROM (SELECT DISTINCT "user" FROM rat) ORDER BY id LIMIT {Q.SUBSET_N})
UNION ALL
SELECT * FROM (SELECT 'item' AS kind, CAST(item AS BIGINT) AS id
               FROM (SELECT DISTINCT item FROM rat) ORDER BY id LIMIT {Q.SUBSET_N})"""

# --------------------------------------------------------------- recommendation

_DOT = "list_dot_product(uf.features, vf.features)"

ORACLES["factor_predict"] = f"""WITH {FAC}
SELECT t."user", t.item, t.rating, {R(_DOT)} AS prediction
FROM test t LEFT JOIN uf ON uf.id = t."user" LEFT JOIN vf ON vf.id = t.item"""

ORACLES["factor_predict_drop"] = f"""WITH {FAC}
SELECT t."user", t.item, t.rating, {R(_DOT)} AS prediction
FROM test t JOIN uf ON uf.id = t."user" JOIN vf ON vf.id = t.item"""

ORACLES["rmse"] = f"""WITH {FAC},
p AS (SELECT t.rating - {_DOT} AS e
      FROM test t JOIN uf ON uf.id = t."user" JOIN vf ON vf.id = t.item)
SELECT {R('sqrt(avg(e * e))')} AS rmse FROM p"""


def _topk(left: str, right: str, lname: str, rname: str, subset: str = "") -> str:
    where = f"WHERE l.id IN ({subset})" if subset else ""
    return f"""WITH {FAC},
s AS (SELECT l.id AS lid, r.id AS rid,
             round(list_dot_product(l.features, r.features), 6) + 0.0 AS score
      FROM {left} l CROSS JOIN {right} r {where}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lid ORDER BY score DESC, rid) AS rank FROM s)
SELECT CAST(lid AS INTEGER) AS {lname}, CAST(rank AS INTEGER) AS rank,
       CAST(rid AS INTEGER) AS {rname}, score
FROM ranked WHERE rank <= {Q.TOP_K}"""


ORACLES["topk_items_per_user"] = _topk("uf", "vf", '"user"', "item")
ORACLES["topk_users_per_item"] = _topk("vf", "uf", "item", '"user"')
ORACLES["topk_user_subset"] = _topk(
    "uf", "vf", '"user"', "item",
    f'SELECT "user" FROM (SELECT DISTINCT "user" FROM rat) ORDER BY 1 LIMIT {Q.SUBSET_N}')
ORACLES["topk_pruned_counts"] = f"""WITH {FAC}
SELECT id AS "user", (SELECT CAST(count(*) AS BIGINT) FROM vf) AS items, true AS enough FROM uf"""
ORACLES["topk_item_subset"] = _topk(
    "vf", "uf", "item", '"user"',
    f"SELECT item FROM (SELECT DISTINCT item FROM rat) ORDER BY 1 LIMIT {Q.SUBSET_N}")

ORACLES["als_rank1_steps"] = f"""WITH {SPLIT},
items0 AS (SELECT DISTINCT item AS id, 1.0::DOUBLE AS f FROM train),
u AS (SELECT t."user" AS id,
             sum(t.rating * i.f) / (sum(i.f * i.f) + {Q.ALS_LAMBDA_RANK1!r}::DOUBLE * count(*)) AS f
      FROM train t JOIN items0 i ON i.id = t.item GROUP BY t."user"),
v AS (SELECT t.item AS id,
             sum(t.rating * u.f) / (sum(u.f * u.f) + {Q.ALS_LAMBDA_RANK1!r}::DOUBLE * count(*)) AS f
      FROM train t JOIN u ON u.id = t."user" GROUP BY t.item)
SELECT id AS item, {R('f')} AS v FROM v"""



def _als_chain() -> str:
    """The rank 2 fit: every half step sums the normal equations and solves them in closed form."""
    start = ", ".join(f"""{md5_hash(f"concat_ws(':', '42', CAST(id AS VARCHAR), '{d}')")} / {float(HASH_SPACE)!r}::DOUBLE AS f{d}""" for d in range(2))
    ctes = [f'u0 AS (SELECT id, {start} FROM (SELECT DISTINCT CAST("user" AS BIGINT) AS id FROM train))']
    for step in range(1, Q.ALS_STEPS + 1):
        for name, mine, fixed, other in ((f"i{step}", "item", f"u{step - 1}", '"user"'), (f"u{step}", '"user"', f"i{step}", "item")):
            ctes.append(f"""{name} AS (
  SELECT id, ((c + l) * p - b * q) / ((a + l) * (c + l) - b * b) AS f0, ((a + l) * q - b * p) / ((a + l) * (c + l) - b * b) AS f1
  FROM (SELECT CAST(t.{mine} AS BIGINT) AS id, {Q.ALS_REG!r}::DOUBLE * count(*) AS l, sum(f.f0 * f.f0) AS a, sum(f.f0 * f.f1) AS b,
               sum(f.f1 * f.f1) AS c, sum(t.rating * f.f0) AS p, sum(t.rating * f.f1) AS q
        FROM train t JOIN {fixed} f ON f.id = t.{other} GROUP BY 1))""")
    return ",\n".join(ctes)


_ALS = f"WITH {SPLIT},\n{_als_chain()}"
ORACLES["als_chunked_factors"] = f"""{_ALS}
SELECT 'user' AS kind, id, {R('f0')} AS f0, {R('f1')} AS f1 FROM u{Q.ALS_STEPS}
UNION ALL SELECT 'item', id, {R('f0')}, {R('f1')} FROM i{Q.ALS_STEPS}"""
ORACLES["als_chunked_rmse"] = f"""{_ALS},
pairs AS (SELECT 'train' AS side, * FROM train UNION ALL SELECT 'test', * FROM test)
SELECT side, {R('sqrt(avg((rating - (u.f0 * i.f0 + u.f1 * i.f1)) ^ 2))')} AS rmse
FROM pairs p JOIN u{Q.ALS_STEPS} u ON u.id = p."user" JOIN i{Q.ALS_STEPS} i ON i.id = p.item GROUP BY side"""
ORACLES["als_chunked_spark_setting"] = f"""WITH {SPLIT}
SELECT "user" AS id, true AS solved FROM (SELECT DISTINCT "user" FROM train)"""

# --------------------------------------------------------------------------- SVM

ORACLES["svc_training_rows"] = f"""WITH {SVMV}
SELECT y AS label, wt AS weight, CAST(len(features) AS INTEGER) AS n_features FROM svmv"""

ORACLES["svm_sgd_weights"] = f"""WITH {SVMV_UNWEIGHTED},
{sgd_chain(Q.SVM_STEPS, 'sgd')}
SELECT CAST(k AS INTEGER) AS k, {R('w')} AS w FROM w{Q.SVM_STEPS}"""

ORACLES["svm_sgd_minibatch"] = f"""WITH {SVMV_UNWEIGHTED},
{sgd_chain(Q.SVM_STEPS, 'sgd', fraction='0.5::DOUBLE')}
SELECT CAST(k AS INTEGER) AS k, {R('w')} AS w FROM w{Q.SVM_STEPS}"""

ORACLES["hinge_gradient"] = f"""WITH {SVMV_UNWEIGHTED},
{sgd_chain(2, 'sgd')}
SELECT CAST(k AS INTEGER) AS k, {R('g / (SELECT n FROM s2)')} AS g FROM g2"""

ORACLES["svc_weights"] = f"""WITH {SVMV_WEIGHTED},
{sgd_chain(Q.SVM_STEPS, 'svc', lr=0.1, reg=0.01, alpha=0.0, tol=1e-6)}
SELECT CAST(k AS INTEGER) AS k, {R('w')} AS w FROM w{Q.SVM_STEPS}"""

ORACLES["svc_predict"] = f"""WITH {SVMV_WEIGHTED},
{sgd_chain(Q.SVM_STEPS, 'svc', lr=0.1, reg=0.01, alpha=0.0, tol=1e-6)},
pm AS (SELECT xk.id, any_value(xk.y) AS label, sum(xk.x * w.w) AS margin
       FROM xk JOIN w{Q.SVM_STEPS} w ON xk.k = w.k GROUP BY xk.id)
SELECT id, CAST(margin > 0 AS DOUBLE) AS prediction, label FROM pm"""

ORACLES["svc_elastic_net"] = f"""WITH {SVMV_WEIGHTED},
{sgd_chain(Q.SVM_STEPS, 'svc', lr=0.5, reg=0.01, alpha=0.5, tol=1e-6)}
SELECT CAST(k AS INTEGER) AS k, {R('w')} AS w FROM w{Q.SVM_STEPS}"""

ORACLES["svc_minibatch"] = f"""WITH {SVMV_WEIGHTED},
{sgd_chain(Q.SVM_STEPS, 'svc', lr=0.1, reg=0.01, alpha=0.0, tol=1e-6, fraction=f'{Q.SVC_BATCH}::DOUBLE / (SELECT count(*) FROM svm_train)')}
SELECT CAST(k AS INTEGER) AS k, {R('w')} AS w FROM w{Q.SVM_STEPS}"""

ORACLES["svc_default_params"] = f"""WITH {SVMV_UNWEIGHTED},
{sgd_chain(Q.SVM_STEPS, 'svc', lr=0.1, reg=0.0, alpha=0.0, tol=1e-6, row_hash=ROW_HASH,
           fraction='32::DOUBLE / (SELECT count(*) FROM svm_train)')}
SELECT CAST(k AS INTEGER) AS k, {R('w')} AS w FROM w{Q.SVM_STEPS}"""

ORACLES["svc_model_roundtrip"] = ORACLES["svc_predict"]

_SVM_PRED = f"""WITH {SVML},
{sgd_chain(Q.SVM_STEPS, 'sgd')},
tk AS (SELECT id, y, generate_subscripts(features, 1) - 1 AS k, unnest(features) AS x FROM svm_test),
pm AS (SELECT tk.id, any_value(tk.y) AS label, sum(tk.x * w.w) AS margin
       FROM tk JOIN w{Q.SVM_STEPS} w ON tk.k = w.k GROUP BY tk.id),
pred AS (SELECT id, CAST(margin > 0 AS DOUBLE) AS prediction, label FROM pm)"""

ORACLES["svm_predict"] = _SVM_PRED + "\nSELECT id, prediction, label FROM pred"

ORACLES["svm_accuracy"] = _SVM_PRED + f"""
SELECT {R('avg(CAST(CAST(prediction AS INTEGER) = CAST(label AS INTEGER) AS DOUBLE))')} AS accuracy,
       (SELECT CAST(count(*) AS BIGINT) FROM svm_train) AS n_train,
       (SELECT CAST(count(*) AS BIGINT) FROM svm_test) AS n_test
FROM pred"""

# ------------------------------- facts of trained models that hold for every random start

ORACLES["als_fit"] = f"""WITH {SPLIT}
SELECT 'user' AS kind, "user" AS id, true AS ok FROM (SELECT DISTINCT "user" FROM train)
UNION ALL SELECT 'item', item, true FROM (SELECT DISTINCT item FROM train)"""

ORACLES["als_predict"] = f"""WITH {SPLIT}
SELECT "user", item, rating, true AS ok FROM test
WHERE "user" IN (SELECT "user" FROM train) AND item IN (SELECT item FROM train)"""

ORACLES["als_predict_flink_setting"] = ORACLES["als_predict"]


def _lists(side: str, other: str, first: str = "", descending: str = "true AS descending, ") -> str:
    return f"""WITH {SPLIT},
ids AS (SELECT DISTINCT {side} AS id FROM train {first}),
n AS (SELECT least({Q.TOP_K}, count(DISTINCT {other})) AS n FROM train)
SELECT id, CAST(n AS BIGINT) AS n, CAST(n AS BIGINT) AS n_distinct, {descending}true AS exact FROM ids, n"""


ORACLES["als_recs_users"] = _lists('"user"', "item")
ORACLES["als_recs_items"] = _lists("item", '"user"')
ORACLES["als_recs_users_native"] = _lists('"user"', "item", descending="")
ORACLES["als_recs_user_subset"] = _lists('"user"', "item", f"ORDER BY 1 LIMIT {Q.SUBSET_N}")
ORACLES["als_recs_item_subset"] = _lists("item", '"user"', f"ORDER BY 1 LIMIT {Q.SUBSET_N}")

# --------------------------------------------------------------- strict readers, faults

ORACLES["ratings_parse_strict"] = f"""WITH {RAT}
SELECT "user", item, rating, ts FROM rat"""

ORACLES["labeled_parse_strict"] = f"""WITH {SVML}
SELECT id, y AS label, CAST(len(features) AS INTEGER) AS n_features FROM svml_all"""

ORACLES["vector_violations"] = """
WITH r AS (SELECT doc_id, CAST(quality AS DOUBLE) AS q, CAST(toxic AS DOUBLE) AS t, n_chars % 200.0 AS c
           FROM documents LEFT JOIN labels USING (doc_id)),
v AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN [q, t] ELSE [q, t, CAST(c AS DOUBLE)] END AS x FROM r),
f AS (SELECT doc_id, CASE WHEN x IS NULL THEN 'null vector' WHEN len(list_filter(x, lambda e: e IS NULL)) > 0 THEN 'null element'
                          WHEN len(x) <> (SELECT len(x) FROM v WHERE x IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) THEN 'length'
                          WHEN len(list_filter(x, lambda e: e < -128 OR e > 127 OR e % 1 <> 0)) > 0 THEN 'not a byte' END AS fault FROM v)
SELECT doc_id, fault FROM f WHERE fault IS NOT NULL"""

# Sparse rows: the same recurrences over the embeddings with small entries as zeros.
SVMS = f"""svmv AS (
  SELECT vec_id AS id, CAST(label < 5 AS DOUBLE) AS y, CAST(label % 3 + 1 AS DOUBLE) AS wt,
         list_transform(embedding, lambda v: CASE WHEN abs(CAST(v AS DOUBLE)) < {SPA_THRESHOLD} THEN 0.0::DOUBLE ELSE CAST(v AS DOUBLE) END) AS features
  FROM embeddings),
svm_train AS (SELECT id, y, WT AS wt, features FROM svmv)"""
SVMS_UNWEIGHTED, SVMS_WEIGHTED = SVMS.replace("WT AS wt", "1.0::DOUBLE AS wt"), SVMS.replace("WT AS wt", "wt")
_NONZERO = f"SELECT CAST(k AS INTEGER) AS k, {R('w')} AS w FROM w{Q.SVM_STEPS} WHERE w <> 0"

ORACLES["svm_sparse_weights"] = f"""WITH {SVMS_UNWEIGHTED},
{sgd_chain(Q.SVM_STEPS, 'sgd')}
{_NONZERO}"""

ORACLES["svm_sparse_minibatch"] = f"""WITH {SVMS_UNWEIGHTED},
{sgd_chain(Q.SVM_STEPS, 'sgd', fraction='0.5::DOUBLE')}
{_NONZERO}"""

ORACLES["svc_sparse_elastic_net"] = f"""WITH {SVMS_WEIGHTED},
{sgd_chain(Q.SVM_STEPS, 'svc', lr=0.5, reg=0.01, alpha=0.5, tol=1e-6)}
{_NONZERO}"""

ORACLES["svm_sparse_predict"] = f"""WITH {SVMS_UNWEIGHTED},
{sgd_chain(Q.SVM_STEPS, 'sgd')},
pm AS (SELECT xk.id, any_value(xk.y) AS label, sum(xk.x * w.w) AS margin
       FROM xk JOIN w{Q.SVM_STEPS} w ON xk.k = w.k GROUP BY xk.id)
SELECT id, CAST(margin > 0 AS DOUBLE) AS prediction, label FROM pm"""
