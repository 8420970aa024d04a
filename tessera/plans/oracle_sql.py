"""DuckDB oracle texts: the same views and results as ``catalog``, in SQL.

Every double that is compared is rounded to 6 places (plus 0.0, to fold -0.0)
and every limit has a total order, so both engines give identical rows.
"""

from __future__ import annotations

from tessera.operators.split import HASH_SPACE, hash_cut

TRAIN_CUT = hash_cut(0.8)


def md5_hash(text: str) -> str:
    """60 bits of the text's md5, as ``split.text_hash``."""
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


# ------------------------------------------------------------------ views (CTEs)

RAT = """rat AS (
  SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(l_partkey AS INTEGER) AS item,
         CAST(floor(avg(l_quantity) / 12.5) + 1 AS DOUBLE) AS rating,
         CAST(epoch(min(o_orderdate)) AS BIGINT) AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey)"""

RATLINE = RAT + """,
ratline AS (
  SELECT CASE WHEN substr(md5(full_line), 1, 1) = '0' THEN short_line ELSE full_line END AS value
  FROM (SELECT concat_ws('::', CAST("user" AS VARCHAR), CAST(item AS VARCHAR),
                         CAST(rating AS VARCHAR), CAST(ts AS VARCHAR)) AS full_line,
               concat_ws('::', CAST("user" AS VARCHAR), CAST(item AS VARCHAR),
                         CAST(rating AS VARCHAR)) AS short_line
        FROM rat))"""

SPLIT = RAT + f""",
rat_b AS (
  SELECT *, {md5_hash("""concat_ws('::', CAST("user" AS VARCHAR), CAST(item AS VARCHAR))""")} AS h FROM rat),
train AS (SELECT "user", item, rating, ts FROM rat_b WHERE h < {TRAIN_CUT}),
test AS (SELECT "user", item, rating, ts FROM rat_b WHERE h >= {TRAIN_CUT})"""

FAC = SPLIT + """,
emb_n AS (SELECT count(*) AS n FROM embeddings),
vecs AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS features
         FROM embeddings),
uf AS (SELECT u.id, vecs.features FROM (SELECT DISTINCT "user" AS id FROM train) u
       JOIN vecs ON vecs.vec_id = CAST(u.id AS BIGINT) % (SELECT n FROM emb_n)),
vf AS (SELECT i.id, vecs.features FROM (SELECT DISTINCT item AS id FROM train) i
       JOIN vecs ON vecs.vec_id = CAST(i.id AS BIGINT) % (SELECT n FROM emb_n))"""

EMB = """emb AS (
  SELECT vec_id AS id, CAST(label % 3 AS TINYINT) AS y,
         list_transform(embedding, lambda v: CAST(floor(least(greatest(
             (CAST(v AS DOUBLE) + 0.4::DOUBLE) * 10.0::DOUBLE, 0.0::DOUBLE), 7.0::DOUBLE)) AS TINYINT)) AS x
  FROM embeddings),
lf AS (SELECT id, y, generate_subscripts(x, 1) - 1 AS k, unnest(x) AS v FROM emb)"""

# Dense sign matrix of the sparse view; the oracle counts zeros explicitly.
SPA = """spa_dense AS (
  SELECT vec_id AS id, CAST(label % 3 AS TINYINT) AS y,
         list_transform(embedding, lambda v: CAST(CASE WHEN abs(CAST(v AS DOUBLE)) < 0.1::DOUBLE THEN 0
                                                  ELSE sign(CAST(v AS DOUBLE)) END AS TINYINT)) AS x
  FROM embeddings),
lf AS (SELECT id, y, generate_subscripts(x, 1) - 1 AS k, unnest(x) AS v FROM spa_dense),
spa AS (SELECT id, y, k, v FROM lf WHERE v <> 0)"""

LIN = """lin AS (
  SELECT [CAST(round(l_quantity) AS TINYINT), CAST(round(l_discount * 100) AS TINYINT),
          CAST(round(l_tax * 100) AS TINYINT), CAST(l_linenumber AS TINYINT)] AS x,
         CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS TINYINT) AS y
  FROM lineitem)"""

SVMV = """svmv AS (
  SELECT vec_id AS id, CAST(label < 5 AS DOUBLE) AS y, CAST(label % 3 + 1 AS DOUBLE) AS wt,
         list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS features
  FROM embeddings)"""


def R(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0.0)"


# ----------------------------------------------------------- information measures

def info_select(cells: str) -> str:
    """(k, rel, mi, cmi) from a cell relation (k, v, z, y, c)."""
    return f"""SELECT k,
         sum(c / n * log2(c_vy * n / (c_v * c_y))) AS rel,
         sum(c / n * log2(c_vz * n / (c_v * c_z))) AS mi,
         sum(c / n * log2(c * c_y / (c_vy * c_zy))) AS cmi
  FROM (SELECT k, c,
               sum(c) OVER (PARTITION BY k) AS n,
               sum(c) OVER (PARTITION BY k, v) AS c_v,
               sum(c) OVER (PARTITION BY k, z) AS c_z,
               sum(c) OVER (PARTITION BY k, y) AS c_y,
               sum(c) OVER (PARTITION BY k, v, z) AS c_vz,
               sum(c) OVER (PARTITION BY k, v, y) AS c_vy,
               sum(c) OVER (PARTITION BY k, z, y) AS c_zy
        FROM (SELECT k, v, z, y, CAST(c AS DOUBLE) AS c FROM {cells}))
  GROUP BY k"""


REL_CELLS = "(SELECT k, v, 0 AS z, y, count(*) AS c FROM lf GROUP BY k, v, y)"


def cells_given(j_expr: str) -> str:
    """Cells of every feature against the feature chosen by ``j_expr`` (same row)."""
    return f"""(SELECT a.k, a.v, b.v AS z, a.y, count(*) AS c
   FROM lf a JOIN lf b ON a.id = b.id AND b.k = ({j_expr})
   GROUP BY a.k, a.v, b.v, a.y)"""


def score_sql(criterion: str, s: int, beta: float = 0.5) -> str:
    if s == 0 or criterion == "mim":
        return "rel"
    if criterion == "mifs":
        return f"rel - {float(beta)!r} * sum_m"
    if criterion == "jmi":
        return f"rel - (sum_m - sum_c) / {float(s)!r}"
    if criterion == "mrmr":
        return f"rel - sum_m / {float(s)!r}"
    if criterion == "icap":
        return "rel - sum_pos"
    return "rel - max_d"


def greedy_ctes(criterion: str, n: int, beta: float = 0.5) -> str:
    """Unrolled greedy rounds over ``lf``: CTEs rel, st0, b1..bn (k, score)."""
    parts = [f"relv AS ({info_select(REL_CELLS)})",
             """st0 AS (SELECT k, rel, 0.0::DOUBLE AS sum_m, 0.0::DOUBLE AS sum_c,
                NULL::DOUBLE AS max_d, 0.0::DOUBLE AS sum_pos, true AS valid FROM relv)"""]
    if criterion == "mim":
        parts.append("""ranked AS (SELECT k, rel AS score,
                row_number() OVER (ORDER BY round(rel, 10) DESC, k) AS rk FROM relv)""")
        for i in range(1, n + 1):
            parts.append(f"b{i} AS (SELECT k, score FROM ranked WHERE rk = {i})")
        return ",\n".join(parts)
    for i in range(1, n + 1):
        s = i - 1
        parts.append(f"""b{i} AS (SELECT k, {score_sql(criterion, s, beta)} AS score FROM st{s}
                WHERE valid ORDER BY round({score_sql(criterion, s, beta)}, 10) DESC, k LIMIT 1)""")
        if i == n:
            break
        parts.append(f"rd{i} AS ({info_select(cells_given(f'SELECT k FROM b{i}'))})")
        parts.append(f"""st{i} AS (
  SELECT st.k, st.rel,
         CASE WHEN st.valid THEN st.sum_m + coalesce(rd.mi, 0.0) ELSE st.sum_m END AS sum_m,
         CASE WHEN st.valid THEN st.sum_c + coalesce(rd.cmi, 0.0) ELSE st.sum_c END AS sum_c,
         CASE WHEN st.valid THEN greatest(st.max_d, coalesce(rd.mi, 0.0) - coalesce(rd.cmi, 0.0))
              ELSE st.max_d END AS max_d,
         CASE WHEN st.valid THEN st.sum_pos + greatest(coalesce(rd.mi, 0.0) - coalesce(rd.cmi, 0.0), 0.0)
              ELSE st.sum_pos END AS sum_pos,
         st.valid AND st.k <> (SELECT k FROM b{i}) AS valid
  FROM st{s} st LEFT JOIN rd{i} rd ON st.k = rd.k)""")
    return ",\n".join(parts)


def selected_union(n: int) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {i} AS rank, CAST(k AS INTEGER) AS feat, score FROM b{i}" for i in range(1, n + 1))


def selection_sql(view: str, criterion: str, n: int, beta: float = 0.5) -> str:
    return f"""WITH {view},
{greedy_ctes(criterion, n, beta)},
sel AS ({selected_union(n)})
SELECT CAST(rank AS INTEGER) AS rank, feat, {R('score')} AS score FROM sel"""


# ------------------------------------------------------------------ SVM chains

SVML = f"""svml_all AS (
  SELECT vec_id AS id, CAST(CAST(label < 5 AS INTEGER) AS DOUBLE) AS y,
         list_transform(embedding, lambda v: CAST(CAST(round(CAST(v AS DOUBLE) * 1000.0::DOUBLE) AS INTEGER)
                                                   AS DOUBLE)) AS features
  FROM embeddings),
svml_b AS (SELECT *, {md5_hash("CAST(id AS VARCHAR)")} AS h FROM svml_all),
svm_train AS (SELECT id, y, 1.0::DOUBLE AS wt, features FROM svml_b WHERE h < {TRAIN_CUT}),
svm_test AS (SELECT id, y, features FROM svml_b WHERE h >= {TRAIN_CUT})"""

SVMV_UNWEIGHTED = SVMV + """,
svm_train AS (SELECT id, y, 1.0::DOUBLE AS wt, features FROM svmv)"""

SVMV_WEIGHTED = SVMV + """,
svm_train AS (SELECT id, y, wt, features FROM svmv)"""


KEY_HASH = md5_hash("CAST(id AS VARCHAR)")


def _micro(c: str) -> str:
    return f"CAST(CAST(round({c} * 1000000.0::DOUBLE) AS BIGINT) AS VARCHAR)"


#: Of a row without a key: label, weight and features in millionths.
ROW_HASH = md5_hash(f"concat_ws('::', {_micro('y')}, {_micro('wt')}, "
                    f"array_to_string(list_transform(features, lambda v: {_micro('v')}), '::'))")


def sgd_chain(steps: int, rule: str, step: float = 1.0, reg: float = 0.01, tol: float = 0.001,
              lr: float = 0.1, alpha: float = 0.0, fraction: str | None = None, row_hash: str = KEY_HASH) -> str:
    """CTEs xk, w0..w{steps} over ``svm_train(id, y, wt, features)``.

    rule 'sgd': w <- w (1 - st reg) - st g/n, st = step/sqrt(i), stop when
    ||dw|| < tol max(||w||, 1).  rule 'svc': w <- soft(w (1 - lr reg (1-a)) - lr g/wsum,
    lr reg a), stop when the mean weighted loss changes by less than tol.
    ``fraction`` (SQL text): step i takes the i-th interval of that share of the row hashes.
    """
    parts = [f"""xk AS (SELECT id, y, wt, h, generate_subscripts(features, 1) - 1 AS k, unnest(features) AS x
        FROM (SELECT *, {row_hash} AS h FROM svm_train))""",
             """w0 AS (SELECT DISTINCT k, 0.0::DOUBLE AS w, false AS done, NULL::DOUBLE AS loss FROM xk)"""]
    if fraction:
        parts.append(f"width AS (SELECT CAST(floor(({fraction}) * {float(HASH_SPACE)!r}::DOUBLE) AS HUGEINT) AS n)")
    for i in range(1, steps + 1):
        p = f"w{i - 1}"
        batch = "" if not fraction else (
            f" WHERE (xk.h - ({i - 1} * (SELECT n FROM width)) % {HASH_SPACE} + {HASH_SPACE}) % {HASH_SPACE} < (SELECT n FROM width)")
        parts.append(f"""b{i} AS (SELECT xk.* FROM xk{batch})""")
        parts.append(f"""m{i} AS (SELECT b.id, any_value(b.y) AS y, any_value(b.wt) AS wt,
                sum(b.x * w.w) AS margin
         FROM b{i} b JOIN {p} w ON b.k = w.k GROUP BY b.id)""")
        parts.append(f"""s{i} AS (SELECT sum(wt * greatest(0.0, 1.0 - (2 * y - 1) * margin)) AS loss,
                sum(wt) AS wsum, count(*) AS n FROM m{i})""")
        parts.append(f"""g{i} AS (SELECT b.k, sum(CASE WHEN (2 * m.y - 1) * m.margin < 1.0
                                    THEN -m.wt * (2 * m.y - 1) * b.x ELSE 0.0 END) AS g
         FROM b{i} b JOIN m{i} m ON b.id = m.id GROUP BY b.k)""")
        if rule == "sgd":
            st = step / (i ** 0.5)
            parts.append(f"""n{i} AS (SELECT w.k, w.w AS old,
                CASE WHEN w.done THEN w.w
                     ELSE w.w * (1.0 - {st!r} * {reg!r}) - {st!r} * coalesce(g.g, 0.0) / (SELECT n FROM s{i})
                END AS w, w.done
         FROM {p} w LEFT JOIN g{i} g ON w.k = g.k)""")
            parts.append(f"""w{i} AS (SELECT k, w, done OR (
                  (SELECT sqrt(sum((w - old) * (w - old))) FROM n{i})
                  < {tol!r} * greatest((SELECT sqrt(sum(w * w)) FROM n{i}), 1.0)) AS done,
                NULL::DOUBLE AS loss FROM n{i})""")
        else:
            shrink = 1.0 - lr * reg * (1.0 - alpha)
            thr = lr * reg * alpha
            parts.append(f"""v{i} AS (SELECT w.k,
                w.w * {shrink!r} - {lr!r} * (coalesce(g.g, 0.0) / (SELECT wsum FROM s{i})) AS v,
                w.w AS old, w.done, w.loss AS prev
         FROM {p} w LEFT JOIN g{i} g ON w.k = g.k)""")
            mean = f"((SELECT loss FROM s{i}) / (SELECT wsum FROM s{i}))"
            stop = f"(prev IS NOT NULL AND abs(prev - {mean}) < {tol!r})"
            parts.append(f"""w{i} AS (SELECT k,
                CASE WHEN done OR {stop} THEN old
                     WHEN abs(v) - {thr!r} > 0.0 THEN sign(v) * (abs(v) - {thr!r})
                     ELSE 0.0 END AS w,
                done OR {stop} AS done,
                CASE WHEN done OR {stop} THEN prev ELSE {mean} END AS loss
         FROM v{i})""")
    return ",\n".join(parts)
