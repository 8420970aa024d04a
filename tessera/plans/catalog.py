"""Driver queries: one entry per operator of the inventory.

Each entry takes (spark, sf_dir) and returns a DataFrame whose column names
and types match the DuckDB text of the same name in ``oracles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import bitslices as B
from tessera.operators import checks as K
from tessera.operators import columns as CO
from tessera.operators import criteria as C
from tessera.operators import infotheory as I
from tessera.operators import recommend as RC
from tessera.operators import selection as S
from tessera.operators import sparse_svm as SS
from tessera.operators import svm as SV
from tessera.operators.als import fit_chunked_als
from tessera.operators.split import exact_split, hash_cut, hash_split, key_hash, with_row_id
from tessera.plans import views as V
from tessera.session import scratch_path
from tessera.sources import labeled as LB
from tessera.sources import ratings as RS
from tessera.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

SELECT_N = 3          # rounds in the select_<criterion> queries
MODEL_N = 5           # features kept by the fitted-model queries
MAXREL_N = 10
SLICE_DENSE = [3, 17, 40, 63]
SLICE_SPARSE = [3, 5, 7, 11, 13, 60]
TOP_K = 10
COLUMN_CHUNK = 64      # rows of a column chunk in the queries, so that small tables have several
SUBSET_N = 3
SVM_STEPS = 3
SVC_FULL_BATCH = 1_000_000_000     # >= rows: every iteration uses the whole table
SVC_BATCH = 100
ALS_LAMBDA_RANK1 = 0.1
ALS_STEPS, ALS_REG = 2, 0.1      # the rank 2 fit held against SQL


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def r6(col):
    return I.clean(col, 6)


# ------------------------------------------------------------ feature selection

@query("fs_training_rows")
def fs_training_rows(spark, sf):
    """(label double, features) rows of EMB with their dimension."""
    emb = V.byte_matrix(spark, sf)
    rows = S.training_rows(emb, label="y", features="x", keep=["id"])
    return rows.select("id", "label", F.size("features").alias("n_features"))


@query("unpivot_dense")
def unpivot_dense(spark, sf):
    """Per-feature long form of EMB."""
    lf = I.long_form(V.byte_matrix(spark, sf), id_col="id")
    return lf.select("id", F.col("k").cast("int").alias("k"), F.col("v").cast("int").alias("v"),
                     F.col("y").cast("int").alias("y"))


@query("contingency_counts")
def contingency_counts(spark, sf):
    """class/feature contingency cells of LIN (600k rows at sf0.1)."""
    cells = I.dense_cells(V.lineitem_matrix(spark, sf))
    return cells.select(F.col("k").cast("int").alias("k"), F.col("v").cast("int").alias("v"),
                        F.col("y").cast("int").alias("y"), F.col("c").cast("bigint").alias("c"))


@query("mi_relevance")
def mi_relevance(spark, sf):
    """A10: I(X_k; Y) for every EMB feature."""
    rel = I.relevance(I.dense_cells(V.byte_matrix(spark, sf)))
    return rel.select(F.col("k").cast("int").alias("k"), r6(F.col("mi")).alias("mi"))


def _most_relevant(rel: DataFrame) -> int:
    return int(rel.orderBy(F.round("rel", S.TIE_DIGITS).desc(), F.col("k").asc()).first()["k"])


@query("mi_redundancy")
def mi_redundancy(spark, sf):
    """I(X_k; X_j) against the most relevant feature j."""
    emb = V.byte_matrix(spark, sf)
    j = _most_relevant(I.information(I.dense_cells(emb)))
    red = I.redundancy(I.dense_cells(emb, given=j))
    return red.select(F.col("k").cast("int").alias("k"), r6(F.col("mi")).alias("mi"))


@query("cmi_redundancy")
def cmi_redundancy(spark, sf):
    """I(X_k; X_j | Y) against the most relevant feature j."""
    emb = V.byte_matrix(spark, sf)
    j = _most_relevant(I.information(I.dense_cells(emb)))
    red = I.redundancy(I.dense_cells(emb, given=j))
    return red.select(F.col("k").cast("int").alias("k"), r6(F.col("cmi")).alias("cmi"))


def _mrmr_second_round(spark, sf) -> DataFrame:
    """The selection loop's state after its first round, with the score of every feature left."""
    emb = V.byte_matrix(spark, sf)
    state = C.initial_states(I.information(I.dense_cells(emb)).select("k", "rel"), ["mrmr"])
    j = S.winners(state, C.score_case_sql(["mrmr"], 0))["mrmr"][0]
    info = I.information(I.dense_cells_many(emb, [j]), keys=("j", "k")).select("j", "k", "mi", "cmi")
    return C.update_many(state, info, {"mrmr": j}, broadcast_info=False)


@query("score_update_lookup")
def score_update_lookup(spark, sf):
    """J4 + C4: mrmr scores of the remaining features after the first pick."""
    state = _mrmr_second_round(spark, sf).filter("valid")
    return state.select(F.col("k").cast("int").alias("k"), r6(F.expr(C.score_case_sql(["mrmr"], 1))).alias("score"))


@query("argmax_feature")
def argmax_feature(spark, sf):
    """The second mrmr pick, (round(score,10) desc, feature asc)."""
    feat, score = S.winners(_mrmr_second_round(spark, sf), C.score_case_sql(["mrmr"], 1))["mrmr"]
    return spark.createDataFrame([(feat, score)], "feat int, score double").select("feat", r6(F.col("score")).alias("score"))


def _select(criterion: str):
    def run(spark, sf):
        src = S.DenseFeatures(V.byte_matrix(spark, sf))
        try:
            sel = S.greedy_select(src, criterion, SELECT_N)
        finally:
            src.release()
        out = S.selection_frame(spark, sel)
        return out.select("rank", "feat", r6(F.col("score")).alias("score"))
    run.__name__ = f"select_{criterion}"
    run.__doc__ = f"E1 + C: greedy {criterion} selection of {SELECT_N} EMB features."
    return run


for _crit in C.CRITERIA:
    query(f"select_{_crit}")(_select(_crit))


def _fitted_model(spark, sf) -> S.FeatureSelectorModel:
    emb = V.byte_matrix(spark, sf)
    return S.FeatureSelector(selectCriterion="mrmr", numTopFeatures=MODEL_N,
                             featuresCol="x", labelCol="y").fit(emb)


@query("selected_sorted")
def selected_sorted(spark, sf):
    """Fitted mrmr indices, ascending, with position."""
    return S.sorted_selection(spark, _fitted_model(spark, sf).selectedFeatures)


@query("maxrel_report")
def maxrel_report(spark, sf):
    """The 10 most relevant features, 1-based, score %.4f."""
    rel = I.information(I.dense_cells(V.byte_matrix(spark, sf))).select("k", "rel")
    return S.maxrel_report(rel, MAXREL_N)


@query("selected_report")
def selected_report(spark, sf):
    """The fitted mrmr selection, 1-based, score %.4f."""
    model = _fitted_model(spark, sf)
    return S.selected_report(model.selection(spark))


@query("fs_model_roundtrip")
def fs_model_roundtrip(spark, sf):
    """Save the fitted model under the checkpoint folder, load it back."""
    model = _fitted_model(spark, sf)
    path = scratch_path(spark, "selector-model")
    model.write().overwrite().save(path)
    loaded = S.FeatureSelectorModel.load(path)
    return S.sorted_selection(spark, loaded.selectedFeatures)


@query("slice_dense")
def slice_dense(spark, sf):
    """P10: keep fixed indices of the EMB arrays; (id, new index, value)."""
    emb = V.byte_matrix(spark, sf)
    out = S.slice_dense(emb, "x", SLICE_DENSE, "sel")
    return out.select("id", F.posexplode("sel").alias("k", "v")).select(
        "id", F.col("k").cast("int").alias("k"), F.col("v").cast("int").alias("v"))


@query("slice_sparse")
def slice_sparse(spark, sf):
    """Keep fixed indices of the SPA long form, renumbered 0..m-1."""
    spa = V.sparse_sign_entries(spark, sf)
    out = S.slice_sparse_entries(spa.select("id", "k", "v"), SLICE_SPARSE)
    return out.select("id", F.col("k").cast("int").alias("k"), F.col("v").cast("int").alias("v"))


@query("fs_transform")
def fs_transform(spark, sf):
    """Fit mrmr on EMB, transform EMB; exploded output column."""
    emb = V.byte_matrix(spark, sf)
    model = _fitted_model(spark, sf).setFeaturesCol("x").setOutputCol("sel")
    out = model.transform(emb)
    return out.select("id", F.posexplode("sel").alias("k", "v")).select(
        "id", F.col("k").cast("int").alias("k"), F.col("v").cast("int").alias("v"))


@query("assemble_sparse_columns")
def assemble_sparse_columns(spark, sf):
    """Per-feature column summary of the SPA long form."""
    spa = V.sparse_sign_entries(spark, sf)
    cols = I.column_summary(spa)
    return cols.select(F.col("k").cast("int").alias("k"), F.col("n_nonzero").cast("bigint"),
                       F.col("checksum").cast("bigint"))


@query("sparse_column_layout")
def sparse_column_layout(spark, sf):
    """SPA non-zeros laid out feature-major (range partitioned on (k, id))."""
    spa = V.sparse_sign_entries(spark, sf).select("k", "id", "v")
    laid = I.columnar_layout(spa)
    return laid.select(F.col("k").cast("int").alias("k"), "id", F.col("v").cast("int").alias("v"))


@query("sparse_column_chunks")
def sparse_column_chunks(spark, sf):
    """SPA columns as chunks of vectors: kind, size, number of stored values and a checksum of each."""
    n = table(spark, sf, "embeddings").count()
    chunks = CO.column_chunks(V.sparse_sign_entries(spark, sf).select("k", "id", "v"), n, COLUMN_CHUNK)
    check = F.expr("aggregate(transform(vals, (v, i) -> (coalesce(positions[i], i) + 1) * CAST(v AS BIGINT)), 0L, (a, x) -> a + x)")
    return chunks.select("k", "chunk", F.col("positions").isNull().alias("dense"), "size", check.alias("checksum"))


@query("sparse_column_round_trip")
def sparse_column_round_trip(spark, sf):
    """The SPA non-zeros read back from their column chunks."""
    n = table(spark, sf, "embeddings").count()
    chunks = CO.column_chunks(V.sparse_sign_entries(spark, sf).select("k", "id", "v"), n, COLUMN_CHUNK)
    return CO.column_entries(chunks, COLUMN_CHUNK).select("k", "id", F.col("v").cast("int").alias("v"))


def _sparse_inputs(spark, sf):
    """(entries partitioned by row id, all rows, dimension) -- lazy, nothing persisted."""
    spa = V.sparse_sign_entries(spark, sf)
    rows = V.byte_matrix(spark, sf).select("id", "y")
    return I.partition_entries(spa), rows, V.sparse_dimension(spark, sf)


@query("mi_relevance_sparse")
def mi_relevance_sparse(spark, sf):
    """I(X_k; Y) from non-zero entries only."""
    entries, rows, d = _sparse_inputs(spark, sf)
    rel = I.relevance(I.sparse_cell_parts(entries, rows, d))
    return rel.select(F.col("k").cast("int").alias("k"), r6(F.col("mi")).alias("mi"))


@query("mi_redundancy_sparse")
def mi_redundancy_sparse(spark, sf):
    """(I(X_k; X_j), I(X_k; X_j|Y)) from non-zeros, j = most relevant."""
    entries, rows, d = _sparse_inputs(spark, sf)
    totals = I.class_totals(rows)
    j = _most_relevant(I.information(I.sparse_cell_parts(entries, rows, d, None, totals)))
    red = I.redundancy(I.sparse_cell_parts(entries, rows, d, j, totals))
    return red.select(F.col("k").cast("int").alias("k"), r6(F.col("mi")).alias("mi"),
                      r6(F.col("cmi")).alias("cmi"))


@query("fs_fit_sparse_vectors")
def fs_fit_sparse_vectors(spark, sf):
    """E3 on a sparse ml vector column: FeatureSelector.fit takes the sparse path."""
    vec = V.sparse_sign_vectors(spark, sf)
    model = S.FeatureSelector(selectCriterion="mrmr", numTopFeatures=SELECT_N).fit(vec)
    return model.selection(spark).select("rank", "feat", r6(F.col("score")).alias("score"))


def _select_otherwise(name: str, criterion: str, source, select):
    @query(name)
    def run(spark, sf):
        src = source(V.byte_matrix(spark, sf))
        try:
            out = S.selection_frame(spark, select(src, criterion, SELECT_N))
            return out.select("rank", "feat", r6(F.col("score")).alias("score"))
        finally:
            src.release()
    run.__name__ = name
    run.__doc__ = f"E1 with criterion {criterion} by {select.__name__} over {source.__name__}: rank, feature, score."


for _crit in ("jmi", "mrmr"):
    _select_otherwise(f"select_bit_sliced_{_crit}", _crit, S.BitSlicedFeatures, S.greedy_select)
for _crit in S.LAZY_CRITERIA:
    _select_otherwise(f"select_lazy_{_crit}", _crit, S.BitSlicedFeatures, S.lazy_select)


@query("contingency_bit_sliced")
def contingency_bit_sliced(spark, sf):
    """The cells of LIN as bit counts."""
    cells = B.cells(B.bit_slices(V.lineitem_matrix(spark, sf)), [None])
    return cells.select(F.col("k").cast("int").alias("k"), F.col("v").cast("int").alias("v"),
                        F.col("y").cast("int").alias("y"), F.col("c").cast("bigint").alias("c"))


@query("select_mrmr_sparse")
def select_mrmr_sparse(spark, sf):
    """E1 on the sparse path: mrmr, 3 features of SPA."""
    entries, rows, d = _sparse_inputs(spark, sf)
    src = S.SparseFeatures(entries, rows, d)
    try:
        sel = S.greedy_select(src, "mrmr", SELECT_N)
    finally:
        src.release()
    return S.selection_frame(spark, sel).select("rank", "feat", r6(F.col("score")).alias("score"))


# ------------------------------------------------------------- sources and checks


@query("ratings_parse")
def ratings_parse(spark, sf):
    """Parse ``user::item::rating::ts`` lines; good rows of a feed with bad lines."""
    good, _ = RS.split_rating_lines(V.rating_lines(spark, sf))
    return good.select("user", "item", F.col("rating").cast("double").alias("rating"), "ts")


@query("ratings_parse_strict")
def ratings_parse_strict(spark, sf):
    """The strict reader over a feed without bad lines."""
    lines = V.clean_rating_lines(spark, sf)
    return RS.parse_rating_lines(lines).select("user", "item", F.col("rating").cast("double").alias("rating"), "ts")


@query("ratings_bad_lines")
def ratings_bad_lines(spark, sf):
    """Lines that do not have 4 parseable fields."""
    _, bad = RS.split_rating_lines(V.rating_lines(spark, sf))
    return bad


@query("ratings_csv_scan")
def ratings_csv_scan(spark, sf):
    """The delimited feed parsed with the declared schema."""
    parsed = RS.parse_csv_lines(V.rating_csv_lines(spark, sf))
    return parsed.select(F.col("userid").alias("user"), F.col("movieid").alias("item"),
                         "rating", F.col("timestamp").alias("ts"))


def _csv_files(spark, sf):
    path = scratch_path(spark, "rating-feed")
    V.rating_csv_feed(spark, sf).write.text(path)
    return RS.scan_rating_csv(spark, path)


@query("ratings_csv_files")
def ratings_csv_files(spark, sf):
    """A feed written as files and scanned with the declared schema: its good rows."""
    return _csv_files(spark, sf)[0].select(F.col("userid").alias("user"), F.col("movieid").alias("item"), "rating", F.col("timestamp").alias("ts"))


@query("ratings_csv_files_bad")
def ratings_csv_files_bad(spark, sf):
    """The lines of that feed that do not fit the schema."""
    return _csv_files(spark, sf)[1]


@query("labeled_parse")
def labeled_parse(spark, sf):
    """S3: ``label,tag,f1 ... fn`` lines; (id, label, k, v) exploded."""
    good, _ = LB.split_labeled_lines(V.svm_lines(spark, sf))
    return good.select(F.col("tag").cast("bigint").alias("id"), "label",
                       F.posexplode("features").alias("k", "v")).select(
        "id", "label", F.col("k").cast("int").alias("k"), "v")


@query("labeled_parse_strict")
def labeled_parse_strict(spark, sf):
    """S3: the strict reader over the same lines; (id, label, number of features)."""
    rows = LB.parse_labeled_lines(V.svm_lines(spark, sf))
    return rows.select(F.col("tag").cast("bigint").alias("id"), "label", F.size("features").alias("n_features"))


def _doc_labels(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf, "labels")
    return d.join(lab, "doc_id")


@query("label_domain_violations")
def label_domain_violations(spark, sf):
    """Labelled documents whose label quality + toxic is not 0 or 1."""
    rows = _doc_labels(spark, sf).select("doc_id", (F.col("quality") + F.col("toxic"))
                                         .cast("double").alias("label"))
    return K.label_violations(rows, "label")


@query("byte_range_violations")
def byte_range_violations(spark, sf):
    """P5: documents whose (n_chars, quality, toxic) vector leaves the byte domain."""
    rows = _doc_labels(spark, sf).select(
        "doc_id", F.array(F.col("n_chars").cast("double"), F.col("quality").cast("double"),
                          F.col("toxic").cast("double")).alias("features"))
    return K.byte_violations(rows, "features").select("doc_id")


@query("vector_violations")
def vector_violations(spark, sf):
    """P5/A5: documents whose (doc, n_chars, quality, toxic) vector is null, has a null, another length or a non-byte."""
    d, lab = table(spark, sf, "documents").select("doc_id", "n_chars"), table(spark, sf, "labels")
    num = lambda c: F.col(c).cast("double")
    few, many = F.array(num("quality"), num("toxic")), F.array(num("quality"), num("toxic"), F.col("n_chars") % 200.0)
    rows = d.join(lab, "doc_id", "left").select("doc_id", F.when(F.col("doc_id") % 11 == 0, None).when(F.col("doc_id") % 7 == 0, few)
                                                .otherwise(many).alias("features"))
    return K.vector_violations(rows, "features", byte=True).select("doc_id", "fault")


@query("dimension_check")
def dimension_check(spark, sf):
    """Smallest and largest embedding length."""
    e = table(spark, sf, "embeddings")
    return K.dimensions(e, "embedding").select("min_dim", "max_dim")


# ------------------------------------------------------------------------ splits

@query("split_train")
def split_train(spark, sf):
    """L1/L2: the 80% side of the key-hash split of RAT."""
    return V.rating_split(spark, sf)[0]


@query("split_test")
def split_test(spark, sf):
    """L1/L2: the 20% side output."""
    return V.rating_split(spark, sf)[1]


@query("split_counts")
def split_counts(spark, sf):
    """A1: row counts of both sides in one pass."""
    r = V.ratings(spark, sf)
    train = key_hash(["user", "item"]) < hash_cut(V.TRAIN_FRACTION)
    return r.agg(F.sum(train.cast("bigint")).alias("n_train"),
                 F.sum((~train).cast("bigint")).alias("n_test"))


@query("split_exact")
def split_exact(spark, sf):
    """L2: exactly round(0.8 n) rows of RAT on the training side; every row with its side."""
    main, rest = exact_split(V.ratings(spark, sf), ["user", "item"], V.TRAIN_FRACTION)
    return main.withColumn("side", F.lit("train")).unionByName(rest.withColumn("side", F.lit("test")))


@query("split_exact_repeated_keys")
def split_exact_repeated_keys(spark, sf):
    """L2 by a key that many rows share (the item): row counts of both sides."""
    main, rest = exact_split(V.ratings(spark, sf), ["item"], 0.5)
    return main.agg(F.count(F.lit(1)).alias("n_train")).crossJoin(rest.agg(F.count(F.lit(1)).alias("n_test")))


@query("row_ids")
def row_ids(spark, sf):
    """L3: consecutive row ids of RAT in (user, item) order, all columns, distributed."""
    return with_row_id(V.ratings(spark, sf), ["user", "item"], "rid")


@query("row_ids_orders")
def row_ids_orders(spark, sf):
    """L3: consecutive row ids of the whole orders table in key order, all columns."""
    return with_row_id(table(spark, sf, "orders"), ["o_orderkey"], "rid")


@query("subset_ids")
def subset_ids(spark, sf):
    """T4/A4: the 3 smallest user ids and item ids of RAT."""
    r = V.stored_ratings(spark, sf, ("user", "item"))
    u = RC.first_ids(r, "user", SUBSET_N).select(F.lit("user").alias("kind"),
                                                  F.col("user").cast("bigint").alias("id"))
    i = RC.first_ids(r, "item", SUBSET_N).select(F.lit("item").alias("kind"),
                                                  F.col("item").cast("bigint").alias("id"))
    return u.unionByName(i)


# --------------------------------------------------------------- recommendation

@query("factor_predict")
def factor_predict(spark, sf):
    """Score every test pair; cold-start pairs get a null prediction."""
    train, test = V.stored_split(spark, sf)
    uf, vf = V.factor_tables(spark, sf, train)
    p = RC.predict_pairs(test, uf, vf, drop_cold=False)
    return p.select("user", "item", "rating", r6(F.col("prediction")).alias("prediction"))


@query("factor_predict_drop")
def factor_predict_drop(spark, sf):
    """The same with cold-start pairs dropped."""
    train, test = V.stored_split(spark, sf)
    uf, vf = V.factor_tables(spark, sf, train)
    p = RC.predict_pairs(test, uf, vf, drop_cold=True)
    return p.select("user", "item", "rating", r6(F.col("prediction")).alias("prediction"))


@query("rmse")
def rmse(spark, sf):
    """A3: RMSE of the factor predictions on the test split."""
    train, test = V.stored_split(spark, sf)
    uf, vf = V.factor_tables(spark, sf, train)
    return RC.rmse(RC.predict_pairs(test, uf, vf)).select(r6(F.col("rmse")).alias("rmse"))


def _topk_out(df, left: str, right: str):
    return df.select(F.col("id").cast("int").alias(left), "rank",
                     F.col("other").cast("int").alias(right), "score")


@query("topk_items_per_user")
def topk_items_per_user(spark, sf):
    """10 best items for every user with factors."""
    uf, vf = V.factor_tables(spark, sf)
    return _topk_out(RC.top_k(uf, vf, TOP_K), "user", "item")


@query("topk_users_per_item")
def topk_users_per_item(spark, sf):
    """10 best users for every item with factors."""
    uf, vf = V.factor_tables(spark, sf)
    return _topk_out(RC.top_k(vf, uf, TOP_K), "item", "user")


@query("topk_pruned_counts")
def topk_pruned_counts(spark, sf):
    """Per user, how many items the pruned search decided on (scored or skipped), and whether it scored at least its list."""
    uf, vf = V.factor_tables(spark, sf)
    per = RC.top_k(uf, vf, TOP_K, counts=True).groupBy("id").agg(F.max(F.col("scored") + F.col("skipped")).alias("items"), F.min(F.col("scored") >= F.col("rank")).alias("enough"))
    return per.select(F.col("id").cast("int").alias("user"), "items", "enough")


@query("topk_user_subset")
def topk_user_subset(spark, sf):
    """10 best items for the 3 smallest user ids of RAT."""
    pairs = V.stored_ratings(spark, sf, ("user", "item"))
    uf, vf = V.factor_tables(spark, sf, hash_split(pairs, ["user", "item"], V.TRAIN_FRACTION)[0])
    ids = RC.first_ids(pairs, "user", SUBSET_N).withColumnRenamed("user", "id")
    return _topk_out(RC.top_k_subset(ids, uf, vf, TOP_K), "user", "item")


@query("topk_item_subset")
def topk_item_subset(spark, sf):
    """10 best users for the 3 smallest item ids of RAT."""
    pairs = V.stored_ratings(spark, sf, ("user", "item"))
    uf, vf = V.factor_tables(spark, sf, hash_split(pairs, ["user", "item"], V.TRAIN_FRACTION)[0])
    ids = RC.first_ids(pairs, "item", SUBSET_N).withColumnRenamed("item", "id")
    return _topk_out(RC.top_k_subset(ids, vf, uf, TOP_K), "item", "user")


@query("als_rank1_steps")
def als_rank1_steps(spark, sf):
    """ALS-WR update rule at rank 1: items start at 1, solve users, then items."""
    train, _ = V.stored_split(spark, sf)
    items0 = train.select(F.col("item").alias("id")).distinct().withColumn("f", F.lit(1.0))
    users = RC.rank1_half_step(train, items0, "user", "item", ALS_LAMBDA_RANK1)
    items = RC.rank1_half_step(train, users, "item", "user", ALS_LAMBDA_RANK1)
    return items.select(F.col("id").alias("item"), r6(F.col("f")).alias("v"))


def _chunked_als(spark, sf):
    train, test = V.stored_split(spark, sf)
    return fit_chunked_als(train, rank=2, maxIter=ALS_STEPS, regParam=ALS_REG), train, test


@query("als_chunked_factors")
def als_chunked_factors(spark, sf):
    """Both factor tables of a rank 2 fit on the training side, from a fixed start."""
    model, _, _ = _chunked_als(spark, sf)
    side = lambda name, t: t.select(F.lit(name).alias("kind"), "id", r6(F.col("features")[0]).alias("f0"), r6(F.col("features")[1]).alias("f1"))
    return side("user", model.userFactors).unionByName(side("item", model.itemFactors))


@query("als_chunked_rmse")
def als_chunked_rmse(spark, sf):
    """A3: RMSE of that fit on the training and on the test side (pairs of unseen ids dropped)."""
    model, train, test = _chunked_als(spark, sf)
    one = lambda name, pairs: RC.rmse(model.transform(pairs)).select(F.lit(name).alias("side"), r6(F.col("rmse")).alias("rmse"))
    return one("train", train).unionByName(one("test", test))


@query("als_chunked_spark_setting")
def als_chunked_spark_setting(spark, sf):
    """E5: 5 iterations, rank 10, lambda 0.01; whether each user's factors solve their normal equations."""
    train, _ = V.stored_split(spark, sf)
    model = fit_chunked_als(train, rank=10, **RC.SPARK_SETTING)
    return RC.fitted_users(model, train, RC.SPARK_SETTING["regParam"])


def _als(spark, sf, setting=None):
    train, test = V.stored_split(spark, sf)
    return RC.fit_als(train, setting=setting), train, test


def _both_factors(model):
    return (t.select("id", F.col("features").cast("array<double>").alias("features")) for t in (model.userFactors, model.itemFactors))


@query("als_fit")
def als_fit(spark, sf):
    """E5: Spark ALS (maxIter 5, regParam 0.01): the ids of both factor tables, and whether each
    user's factors solve their normal equations (items: whether all factors are finite)."""
    model, train, _ = _als(spark, sf)
    u = RC.fitted_users(model, train, RC.SPARK_SETTING["regParam"]).select(F.lit("user").alias("kind"), "id", F.col("solved").alias("ok"))
    finite = F.forall("features", lambda v: ~F.isnan(v) & (F.abs(v) != float("inf")))
    return u.unionByName(model.itemFactors.select(F.lit("item").alias("kind"), "id", finite.alias("ok")))


@query("als_predict")
def als_predict(spark, sf):
    """J1/J2 with the trained model: the test pairs that survive the cold-start drop; ok: the
    prediction is the dot product of the factors."""
    model, _, test = _als(spark, sf)
    return RC.prediction_facts(model, test).select("user", "item", "rating", "ok")


@query("als_predict_flink_setting")
def als_predict_flink_setting(spark, sf):
    """10 iterations, rank 10, lambda 0.1; the scored test pairs, as als_predict."""
    model, _, test = _als(spark, sf, RC.FLINK_SETTING)
    return RC.prediction_facts(model, test).select("user", "item", "rating", "ok")


@query("als_recs_users")
def als_recs_users(spark, sf):
    """T5 via the model: top 10 items for every user; facts of every list."""
    model, _, _ = _als(spark, sf)
    flat = RC.flatten_recommendations(model.recommendForAllUsers(TOP_K), "user", "item")
    uf, vf = _both_factors(model)
    return RC.list_facts(flat, uf, vf, "item", TOP_K)


@query("als_recs_items")
def als_recs_items(spark, sf):
    """T6 via the model: top 10 users for every item; facts of every list."""
    model, _, _ = _als(spark, sf)
    flat = RC.flatten_recommendations(model.recommendForAllItems(TOP_K), "item", "user")
    uf, vf = _both_factors(model)
    return RC.list_facts(flat, vf, uf, "user", TOP_K)


@query("als_recs_users_native")
def als_recs_users_native(spark, sf):
    """T5 over the trained factors with the native top-k; facts of every list, held against Spark's own lists."""
    model, _, _ = _als(spark, sf)
    flat = RC.flatten_recommendations(RC.recommend_for_all(model, TOP_K), "user", "item")
    own = RC.flatten_recommendations(model.recommendForAllUsers(TOP_K), "user", "item").select("id", "rank", F.col("score").alias("own"))
    near = F.abs(F.col("score") - F.col("own")) < RC.FACT_TOLERANCE
    return flat.join(own, ["id", "rank"], "left").groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("item").alias("n_distinct"), F.min(F.coalesce(near, F.lit(False))).alias("exact"))


@query("als_recs_user_subset")
def als_recs_user_subset(spark, sf):
    """T7 via the model: top 10 items for the 3 smallest user ids; facts of every list."""
    model, train, _ = _als(spark, sf)
    users = RC.first_ids(train, "user", SUBSET_N)
    flat = RC.flatten_recommendations(model.recommendForUserSubset(users, TOP_K), "user", "item")
    uf, vf = _both_factors(model)
    chosen = uf.join(users.select(F.col("user").alias("id")), "id", "left_semi")
    return RC.list_facts(flat, chosen, vf, "item", TOP_K)


@query("als_recs_item_subset")
def als_recs_item_subset(spark, sf):
    """T8 via the model: top 10 users for the 3 smallest item ids; facts of every list."""
    model, train, _ = _als(spark, sf)
    items = RC.first_ids(train, "item", SUBSET_N)
    flat = RC.flatten_recommendations(model.recommendForItemSubset(items, TOP_K), "item", "user")
    uf, vf = _both_factors(model)
    chosen = vf.join(items.select(F.col("item").alias("id")), "id", "left_semi")
    return RC.list_facts(flat, chosen, uf, "user", TOP_K)


# --------------------------------------------------------------------------- SVM

def _weights_frame(spark, w):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(w)], "k int, w double")


@query("svc_training_rows")
def svc_training_rows(spark, sf):
    """(label, weight, features) rows with their length."""
    v = V.svm_vectors(spark, sf)
    rows = SV.svc_rows(v.withColumnRenamed("y", "label"), "features", "label", "wt")     # what LinearSvc.fit trains on
    return rows.select("label", "weight", F.size("features").alias("n_features"))


@query("svm_sgd_weights")
def svm_sgd_weights(spark, sf):
    """Weights after 3 subgradient steps on SVMV."""
    v = V.svm_vectors(spark, sf).select(F.col("y").alias("label"), "features")
    w = SV.sgd_svm(v, SVM_STEPS)
    return _weights_frame(spark, w).select("k", r6(F.col("w")).alias("w"))


@query("svm_sgd_minibatch")
def svm_sgd_minibatch(spark, sf):
    """E7 with miniBatchFraction 0.5: each step samples rows by md5 of (id, step)."""
    v = V.svm_vectors(spark, sf).select("id", F.col("y").alias("label"), "features")
    w = SV.sgd_svm(v, SVM_STEPS, fraction=0.5, key="id")
    return _weights_frame(spark, w).select("k", r6(F.col("w")).alias("w"))


@query("hinge_gradient")
def hinge_gradient(spark, sf):
    """Mean hinge subgradient at the weights after one step."""
    v = V.svm_vectors(spark, sf).select(F.col("y").alias("label"), "features")
    w1 = SV.sgd_svm(v, 1)
    g, _, _, n = SV.gradient_sums(v, w1)
    return _weights_frame(spark, [x / n for x in g]).select(
        "k", r6(F.col("w")).alias("g"))


def _svc(spark, sf, **params):
    v = V.svm_vectors(spark, sf).withColumnRenamed("y", "label")
    est = SV.LinearSvc(weightCol="wt", idCol="id", maxIter=SVM_STEPS, **params)
    return est.fit(v), v


@query("svc_default_params")
def svc_default_params(spark, sf):
    """LinearSvc with its defaults (batches of 32 chosen by the hash of the row, no idCol), 3 steps."""
    v = V.svm_vectors(spark, sf).withColumnRenamed("y", "label").select("label", "features")
    model = SV.LinearSvc(maxIter=SVM_STEPS).fit(v)
    return model.weights(spark).select("k", r6(F.col("w")).alias("w"))


@query("svc_model_roundtrip")
def svc_model_roundtrip(spark, sf):
    """A fitted model saved, loaded and applied: predictions of the loaded one."""
    model, v = _svc(spark, sf, globalBatchSize=SVC_FULL_BATCH, reg=0.01, elasticNet=0.0)
    path = scratch_path(spark, "svc-model")
    model.write().overwrite().save(path)
    return SV.LinearSvcModel.load(path).transform(v).select("id", "prediction", "label")


@query("svc_weights")
def svc_weights(spark, sf):
    """Weighted full-batch steps, L2 penalty (lr 0.1, reg 0.01)."""
    model, _ = _svc(spark, sf, globalBatchSize=SVC_FULL_BATCH, reg=0.01, elasticNet=0.0)
    return model.weights(spark).select("k", r6(F.col("w")).alias("w"))


@query("svc_elastic_net")
def svc_elastic_net(spark, sf):
    """Weighted full-batch steps with elastic net (lr 0.5, reg 0.01, alpha 0.5)."""
    model, _ = _svc(spark, sf, globalBatchSize=SVC_FULL_BATCH, learningRate=0.5, reg=0.01,
                    elasticNet=0.5)
    return model.weights(spark).select("k", r6(F.col("w")).alias("w"))


@query("svc_minibatch")
def svc_minibatch(spark, sf):
    """Hash-sampled batches of ~100 rows per iteration (lr 0.1, reg 0.01)."""
    model, _ = _svc(spark, sf, globalBatchSize=SVC_BATCH, reg=0.01)
    return model.weights(spark).select("k", r6(F.col("w")).alias("w"))


@query("svc_predict")
def svc_predict(spark, sf):
    """The fitted LinearSvc model (weighted, 3 full-batch steps) scores SVMV."""
    model, v = _svc(spark, sf, globalBatchSize=SVC_FULL_BATCH, reg=0.01, elasticNet=0.0)
    return model.transform(v).select("id", "prediction", "label")


def _svm_test_split(spark, sf):
    """Train on the 80% id-hash side of the parsed SVMLINE, test on the rest."""
    good, _ = LB.split_labeled_lines(V.svm_lines(spark, sf))
    rows = good.select(F.col("tag").cast("bigint").alias("id"), "label", "features")
    return hash_split(rows, ["id"], V.TRAIN_FRACTION)


@query("svm_predict")
def svm_predict(spark, sf):
    """Test predictions after 3 steps on the training side."""
    train, test = _svm_test_split(spark, sf)
    w = SV.sgd_svm(train, SVM_STEPS)
    return SV.predict(test, w).select("id", "prediction", "label")


@query("svm_accuracy")
def svm_accuracy(spark, sf):
    """Test accuracy after 3 steps, with the train and test counts."""
    train, test = _svm_test_split(spark, sf)
    w, n_train = SV.sgd_svm_counted(train, SVM_STEPS)
    acc = SV.accuracy(SV.predict(test, w))
    return acc.select(r6(F.col("accuracy")).alias("accuracy"),
                      F.lit(n_train).cast("bigint").alias("n_train"), F.col("n").alias("n_test"))


@query("svm_sparse_weights")
def svm_sparse_weights(spark, sf):
    """E7/P3 on sparse rows: the weight table after 3 steps on SVMS, without zeros."""
    w, _ = SS.sgd(V.svm_sparse_vectors(spark, sf), SVM_STEPS)
    return w.select("k", r6(F.col("w")).alias("w"))


@query("svm_sparse_minibatch")
def svm_sparse_minibatch(spark, sf):
    """E7 on sparse rows with miniBatchFraction 0.5, by md5 of the id."""
    w, _ = SS.sgd(V.svm_sparse_vectors(spark, sf), SVM_STEPS, fraction=0.5, key="id")
    return w.select("k", r6(F.col("w")).alias("w"))


@query("svc_sparse_elastic_net")
def svc_sparse_elastic_net(spark, sf):
    """E8 on sparse rows: weighted full-batch steps with elastic net (lr 0.5, reg 0.01, alpha 0.5)."""
    w, _ = SS.svc(V.svm_sparse_vectors(spark, sf), SVM_STEPS, lr=0.5, reg=0.01, alpha=0.5, weight="wt")
    return w.select("k", r6(F.col("w")).alias("w"))


@query("svm_sparse_predict")
def svm_sparse_predict(spark, sf):
    """P16 on sparse rows: the weight table after 3 steps scores SVMS."""
    rows = V.svm_sparse_vectors(spark, sf)
    w, d = SS.sgd(rows, SVM_STEPS)
    return SS.predict(rows.select("id", "label", "features"), w, d).select("id", "prediction", "label")
