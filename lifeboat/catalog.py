"""Registered queries: one per operator of the inventory, each with its oracle.

``QUERIES[name] = (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql or None)``.
Every query reads the shared tables (or data Spark derives from them) in full.
Computed doubles are rounded to 6 digits on both sides where summation order or
interpolation could differ in the last bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeboat import config as C
from lifeboat import oracles as O
from lifeboat.functions import columns as X
from lifeboat.functions import text as TX
from lifeboat.operators import binning, encode, impute, metrics, split
from lifeboat.operators.score import alignment, union_tagged
from lifeboat.sources import bindings as B

QUERIES: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def _r(c, digits: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def _subjects(spark, sf):
    return B.subjects(spark, sf)


# =============================================================================
# Minimum slice: grouped-median age, fixed bins, survival rate per bin
# =============================================================================

_AGE_FILLED_SQL = O.W(
    f"t AS (SELECT *, {O.title_regex()} AS title FROM subjects)",
    "g AS (SELECT title, pclass, median(age) AS gm FROM t WHERE age IS NOT NULL GROUP BY title, pclass)",
    "a1 AS (SELECT t.*, coalesce(t.age, g.gm) AS age1 FROM t LEFT JOIN g ON t.title = g.title AND t.pclass = g.pclass)",
    "m AS (SELECT median(age1) AS mm FROM a1)",
    "a2 AS (SELECT a1.*, coalesce(age1, mm) AS age2 FROM a1, m)",
)


def _age_filled(spark, sf) -> DataFrame:
    s = _subjects(spark, sf).withColumn("title", TX.title_regex("name"))
    return impute.fill_median_by_group(s, "age", ["title", "pclass"])


@query("age_bin_survival", _AGE_FILLED_SQL + f"""
SELECT {O.bin_fixed('age2', C.AGE_EDGES, C.DEFAULT_BIN)} AS age_bin, count(*) AS n,
       round(avg(label), 6) AS survival_rate
FROM a2 WHERE is_train GROUP BY 1""")
def age_bin_survival(spark: SparkSession, sf: str) -> DataFrame:
    d = binning.bin_fixed(_age_filled(spark, sf), "age", C.AGE_EDGES, "age_bin", C.DEFAULT_BIN)
    return (d.where("is_train").groupBy("age_bin")
            .agg(F.count(F.lit(1)).alias("n"), _r(F.avg("label")).alias("survival_rate")))


# =============================================================================
# P: projections, filters and scalar rules
# =============================================================================

@query("label_project", O.W() + "SELECT id, label FROM subjects WHERE is_train")
def label_project(spark, sf):
    lab, _ = B.labelled_unlabelled(spark, sf)
    return lab.select(F.col("id").cast("long"), F.col("label").cast("int"))


@query("drop_columns", O.W() + """SELECT id, label, CAST(is_train AS INTEGER) AS is_train, pclass, sex, age,
 sibsp, parch, fare, embarked FROM subjects""")
def drop_columns(spark, sf):
    s = _subjects(spark, sf).withColumn("is_train", F.col("is_train").cast("int"))
    return s.drop("name", "ticket", "cabin", "no_such_column")


@query("select_features", O.W() + "SELECT age, fare, pclass, sibsp, parch FROM subjects")
def select_features(spark, sf):
    return _subjects(spark, sf).select("age", "fare", "pclass", "sibsp", "parch")


@query("null_partition", O.W() + """SELECT CAST(age IS NOT NULL AS INTEGER) AS age_known,
 CAST(is_train AS INTEGER) AS is_train, count(*) AS n FROM subjects GROUP BY 1, 2""")
def null_partition(spark, sf):
    s = _subjects(spark, sf)
    known = s.where(F.col("age").isNotNull()).withColumn("age_known", F.lit(1))
    unknown = s.where(F.col("age").isNull()).withColumn("age_known", F.lit(0))
    both = known.unionByName(unknown)
    return both.groupBy("age_known", F.col("is_train").cast("int").alias("is_train")).agg(
        F.count(F.lit(1)).alias("n"))


@query("fill_constant", O.W() + f"""SELECT id, coalesce(embarked, 'S') AS embarked,
 {O.deck('cabin', 'N')} AS cabin_deck, coalesce(fare, 0.0) AS fare,
 {O.bin_fixed('age', C.AGE_EDGES, C.DEFAULT_BIN)} AS age_bin FROM subjects""")
def fill_constant(spark, sf):
    s = _subjects(spark, sf).na.fill({"embarked": C.EMBARKED_FALLBACK, "fare": 0.0})
    s = s.withColumn("cabin_deck", TX.deck_letter("cabin", C.NO_CABIN_MLP))
    s = binning.bin_fixed(s, "age", C.AGE_EDGES, "age_bin", C.DEFAULT_BIN)
    return s.select("id", "embarked", "cabin_deck", "fare", "age_bin")


@query("title_regex", O.W() + f"SELECT id, {O.title_regex()} AS title FROM subjects")
def title_regex(spark, sf):
    return _subjects(spark, sf).select("id", TX.title_regex("name").alias("title"))


@query("title_split_rf", O.W(f"t AS (SELECT id, {O.title1()} AS title1 FROM subjects)")
       + f"SELECT id, title1, {O.title_rf('title1')} AS title2 FROM t")
def title_split_rf(spark, sf):
    s = _subjects(spark, sf).select("id", TX.title_split("name").alias("title1"))
    return s.withColumn("title2", TX.title_rf("title1"))


@query("title_split_xgb", O.W(f"t AS (SELECT id, {O.title1()} AS title1 FROM subjects)")
       + f"SELECT id, title1, {O.title_xgb('title1')} AS title2 FROM t")
def title_split_xgb(spark, sf):
    s = _subjects(spark, sf).select("id", TX.title_split("name").alias("title1"))
    return s.withColumn("title2", TX.title_xgb("title1"))


@query("ticket_token", O.W() + f"SELECT id, ticket, {O.ticket_token()} AS ticket_info FROM subjects")
def ticket_token(spark, sf):
    return _subjects(spark, sf).select("id", "ticket", TX.ticket_token("ticket").alias("ticket_info"))


@query("deck_letter", O.W() + f"""SELECT id, {O.deck('cabin', C.NO_CABIN_RF)} AS deck_rf,
 {O.deck('cabin', C.NO_CABIN_MLP)} AS deck_mlp FROM subjects""")
def deck_letter(spark, sf):
    return _subjects(spark, sf).select(
        "id", TX.deck_letter("cabin", C.NO_CABIN_RF).alias("deck_rf"),
        TX.deck_letter("cabin", C.NO_CABIN_MLP).alias("deck_mlp"))


@query("presence_flags", O.W() + """SELECT id, CAST(cabin IS NOT NULL AS INTEGER) AS has_cabin,
 CAST(coalesce(sibsp + parch + 1 = 1, false) AS INTEGER) AS is_alone,
 CAST(coalesce(sex = 'female', false) AS INTEGER) AS sex_female FROM subjects""")
def presence_flags(spark, sf):
    s = _subjects(spark, sf)
    return s.select("id", X.has_value("cabin").alias("has_cabin"),
                    X.is_alone(X.family_size("sibsp", "parch")).alias("is_alone"),
                    X.is_female("sex").alias("sex_female"))


@query("family_size", O.W() + """SELECT id, sibsp + parch + 1 AS family_size,
 sibsp + parch AS family_size_rf FROM subjects""")
def family_size(spark, sf):
    s = _subjects(spark, sf)
    return s.select("id", X.family_size("sibsp", "parch").alias("family_size"),
                    X.family_size("sibsp", "parch", include_self=False).alias("family_size_rf"))


@query("interactions", O.W(
    f"c AS (SELECT *, {O.codes('sex', 'subjects')} AS sex_code FROM subjects)")
    + f"""SELECT id, sex_code * pclass AS sex_pclass,
 pclass * {O.bin_fixed('age', C.AGE_EDGES, C.DEFAULT_BIN)} AS pclass_age_bin FROM c""")
def interactions(spark, sf):
    s = encode.category_codes(_subjects(spark, sf), "sex", "sex_code")
    s = binning.bin_fixed(s, "age", C.AGE_EDGES, "age_bin", C.DEFAULT_BIN)
    return s.select("id", X.product("sex_code", "pclass").alias("sex_pclass"),
                    X.product("pclass", "age_bin").alias("pclass_age_bin"))


_TICKET_GROUP_SQL = O.W(
    "tc AS (SELECT ticket, count(*) AS c FROM subjects WHERE ticket IS NOT NULL GROUP BY ticket)"
) + """SELECT id, CASE WHEN tc.c IS NOT NULL THEN least(greatest(tc.c, 0), 4) END AS ticket_group
FROM subjects s LEFT JOIN tc ON s.ticket = tc.ticket"""


@query("clip_count", _TICKET_GROUP_SQL)
def clip_count(spark, sf):
    d = impute.group_size(_subjects(spark, sf), "ticket", "ticket_group")
    return d.select("id", X.clip("ticket_group", *C.TICKET_GROUP_CLIP).alias("ticket_group"))


# =============================================================================
# A: imputation and group statistics
# =============================================================================

@query("impute_mode_global", O.W(
    "m AS (SELECT embarked AS v FROM subjects WHERE embarked IS NOT NULL GROUP BY embarked "
    "ORDER BY count(*) DESC, embarked LIMIT 1)")
    + "SELECT id, coalesce(embarked, (SELECT v FROM m), 'S') AS embarked FROM subjects")
def impute_mode_global(spark, sf):
    d = impute.fill_mode(_subjects(spark, sf), "embarked", default=C.EMBARKED_FALLBACK)
    return d.select("id", "embarked")


@query("impute_mode_by_group", O.W(
    "gc AS (SELECT pclass, embarked, count(*) AS c FROM subjects WHERE embarked IS NOT NULL GROUP BY 1, 2)",
    "gm AS (SELECT pclass, embarked AS gmode FROM (SELECT *, row_number() OVER "
    "(PARTITION BY pclass ORDER BY c DESC, embarked) AS r FROM gc) WHERE r = 1)",
    "f1 AS (SELECT s.id, coalesce(s.embarked, gm.gmode) AS e1 FROM subjects s LEFT JOIN gm ON s.pclass = gm.pclass)",
    "m AS (SELECT e1 AS v FROM f1 WHERE e1 IS NOT NULL GROUP BY e1 ORDER BY count(*) DESC, e1 LIMIT 1)")
    + "SELECT id, coalesce(e1, (SELECT v FROM m), 'S') AS embarked FROM f1")
def impute_mode_by_group(spark, sf):
    d = impute.fill_mode_by_group(_subjects(spark, sf), "embarked", ["pclass"], default=C.EMBARKED_FALLBACK)
    return d.select("id", "embarked")


@query("impute_median_global", O.W("m AS (SELECT median(fare) AS v FROM subjects)")
       + "SELECT id, round(coalesce(fare, (SELECT v FROM m)), 9) AS fare FROM subjects")
def impute_median_global(spark, sf):
    d = impute.fill_median(_subjects(spark, sf), "fare")
    return d.select("id", _r("fare", 9).alias("fare"))


@query("impute_mean_global", O.W("m AS (SELECT avg(fare) AS v FROM subjects)")
       + "SELECT id, round(coalesce(fare, (SELECT v FROM m)), 9) AS fare FROM subjects")
def impute_mean_global(spark, sf):
    d = impute.fill_mean(_subjects(spark, sf), "fare")
    return d.select("id", _r("fare", 9).alias("fare"))


@query("impute_median_by_group", _AGE_FILLED_SQL + "SELECT id, round(age2, 6) AS age FROM a2")
def impute_median_by_group(spark, sf):
    return _age_filled(spark, sf).select("id", _r("age").alias("age"))


@query("ticket_group_size", _TICKET_GROUP_SQL)
def ticket_group_size(spark, sf):
    d = impute.group_size(_subjects(spark, sf), "ticket", "ticket_group", *C.TICKET_GROUP_CLIP)
    return d.select("id", "ticket_group")


@query("frequency_encode", O.W(
    f"t AS (SELECT id, {O.ticket_token()} AS ti, {O.deck('cabin', C.NO_CABIN_RF)} AS cb FROM subjects)",
    "ft AS (SELECT ti, count(*) AS c FROM t WHERE ti IS NOT NULL GROUP BY ti)",
    "fc AS (SELECT cb, count(*) AS c FROM t WHERE cb IS NOT NULL GROUP BY cb)")
    + """SELECT id, CAST(coalesce(ft.c, 0) AS DOUBLE) AS ticket_info_freq,
 CAST(coalesce(fc.c, 0) AS DOUBLE) AS cabin_freq
FROM t LEFT JOIN ft ON t.ti = ft.ti LEFT JOIN fc ON t.cb = fc.cb""")
def frequency_encode(spark, sf):
    s = _subjects(spark, sf).select(
        "id", TX.ticket_token("ticket").alias("ticket_info"),
        TX.deck_letter("cabin", C.NO_CABIN_RF).alias("cabin"))
    s = impute.frequency_encode(s, "ticket_info", "ticket_info_freq")
    s = impute.frequency_encode(s, "cabin", "cabin_freq")
    return s.select("id", "ticket_info_freq", "cabin_freq")


@query("outlier_trim", O.W(
    "k AS (SELECT id, coalesce(fare, 0.0) AS fare, sibsp + parch AS fs FROM subjects WHERE age IS NOT NULL)",
    "st AS (SELECT avg(fare) AS mf, stddev_samp(fare) AS sf, avg(fs) AS mfs, stddev_samp(fs) AS sfs FROM k)")
    + f"""SELECT id FROM k, st
WHERE NOT (coalesce(abs(fare - mf) > {C.OUTLIER_SIGMAS} * sf, false)
        OR coalesce(abs(fs - mfs) > {C.OUTLIER_SIGMAS} * sfs, false))""")
def outlier_trim(spark, sf):
    s = _subjects(spark, sf).where(F.col("age").isNotNull()).select(
        "id", F.coalesce("fare", F.lit(0.0)).alias("fare"),
        X.family_size("sibsp", "parch", include_self=False).alias("family_size"))
    return impute.trim_outliers(s, ["fare", "family_size"], C.OUTLIER_SIGMAS).select("id")


# =============================================================================
# B: binning and encoding
# =============================================================================

@query("bin_fixed", O.W() + f"""SELECT id, {O.bin_fixed('age', C.AGE_EDGES, C.DEFAULT_BIN)} AS age_bin,
 {O.bin_fixed('fare * 40', C.FARE_EDGES, C.DEFAULT_BIN)} AS fare_bin FROM subjects""")
def bin_fixed(spark, sf):
    # fare * 40 spreads the bound fares (0..~100) over every fare edge, up to 100+
    s = _subjects(spark, sf).withColumn("fare40", F.col("fare") * 40)
    s = binning.bin_fixed(s, "age", C.AGE_EDGES, "age_bin", C.DEFAULT_BIN)
    s = binning.bin_fixed(s, "fare40", C.FARE_EDGES, "fare_bin", C.DEFAULT_BIN)
    return s.select("id", "age_bin", "fare_bin")


@query("bin_equal_width", O.W(
    "mm AS (SELECT min(age) AS lo, max(age) AS hi FROM subjects)")
    + f"""SELECT id, CASE WHEN age IS NULL THEN NULL WHEN lo = hi THEN 2 ELSE CAST(
 {' + '.join(f"CAST(age > ({i} * ((hi - lo) / {C.EQUAL_WIDTH_BINS})) + lo AS INTEGER)"
             for i in range(1, C.EQUAL_WIDTH_BINS))} AS INTEGER) END AS age_bin FROM subjects, mm""")
def bin_equal_width(spark, sf):
    s = binning.bin_equal_width(_subjects(spark, sf), "age", "age_bin", C.EQUAL_WIDTH_BINS)
    return s.select("id", "age_bin")


@query("bin_quantile", O.W(
    "fm AS (SELECT avg(fare) AS m FROM subjects)",
    "f AS (SELECT id, coalesce(fare, (SELECT m FROM fm)) AS fare FROM subjects)",
    "q AS (SELECT quantile_cont(fare, 0.25) AS q1, quantile_cont(fare, 0.5) AS q2, "
    "quantile_cont(fare, 0.75) AS q3 FROM f)")
    + """SELECT id, CAST(fare > q1 AS INTEGER) + CAST(fare > q2 AS INTEGER) + CAST(fare > q3 AS INTEGER)
 AS fare_bin FROM f, q""")
def bin_quantile(spark, sf):
    s = impute.fill_mean(_subjects(spark, sf), "fare")
    return binning.bin_quantile(s, "fare", "fare_bin", C.FARE_QUANTILES).select("id", "fare_bin")


_RF_PRE = (f"p AS (SELECT id, sex, coalesce(embarked, 'S') AS embarked, pclass, {O.title1()} AS title1, "
           f"{O.deck('cabin', C.NO_CABIN_RF)} AS cabin, {O.ticket_token()} AS ticket_info FROM subjects)",
           f"p2 AS (SELECT *, {O.title_rf('title1')} AS title2 FROM p)")
_CODE_COLS = ("sex", "embarked", "pclass", "title1", "title2", "cabin", "ticket_info")


@query("category_codes", O.W(*_RF_PRE) + "SELECT id, "
       + ", ".join(f"{O.codes(c, 'p2')} AS {c}" for c in _CODE_COLS) + " FROM p2")
def category_codes(spark, sf):
    s = _subjects(spark, sf)
    s = s.withColumn("embarked", F.coalesce("embarked", F.lit(C.EMBARKED_FALLBACK)))
    s = s.withColumn("title1", TX.title_split("name")).withColumn("title2", TX.title_rf("title1"))
    s = s.withColumn("cabin", TX.deck_letter("cabin", C.NO_CABIN_RF))
    s = s.withColumn("ticket_info", TX.ticket_token("ticket"))
    s = encode.category_codes_many(s, _CODE_COLS)
    return s.select("id", *_CODE_COLS)


@query("category_codes_distributed", O.W(*_RF_PRE) + f"SELECT id, {O.codes('ticket_info', 'p2')} AS ticket_info FROM p2")
def category_codes_distributed(spark, sf):
    # The large-domain path (range partition + offsets), forced by a zero literal limit.
    s = _subjects(spark, sf).withColumn("ticket_info", TX.ticket_token("ticket"))
    return encode.category_codes(s, "ticket_info", map_values=0).select("id", "ticket_info")


_EMB = ("B", "F", "H", "M")


@query("one_hot_drop_first", O.W() + "SELECT id, "
       + ", ".join(f"CAST(coalesce(embarked = '{v}', false) AS INTEGER) AS embarked_{v}" for v in _EMB)
       + ", " + ", ".join(f"CAST(pclass = {v} AS INTEGER) AS pclass_{v}" for v in (2, 3))
       + " FROM subjects")
def one_hot_drop_first(spark, sf):
    s = _subjects(spark, sf).select("id", "embarked", "pclass")
    s, _ = encode.one_hot_drop_first(s, "embarked")
    s, _ = encode.one_hot_drop_first(s, "pclass")
    return s


_SCALE_COLS = ("pclass", "sibsp", "parch")


@query("standard_scale", O.W(
    "st AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALE_COLS)
    + " FROM subjects WHERE is_train)") + "SELECT id, "
    + ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}"
                for c in _SCALE_COLS) + " FROM subjects, st")
def standard_scale(spark, sf):
    s = _subjects(spark, sf)
    params = encode.fit_scaler(s.where("is_train"), _SCALE_COLS)
    out = encode.apply_scaler(s.select("id", *_SCALE_COLS), params)
    return out.select("id", *[_r(c).alias(c) for c in _SCALE_COLS])


# =============================================================================
# J / O / V: stacking, scoring, ordering, splitting
# =============================================================================

@query("union_tagged", O.W() + """SELECT id, CASE WHEN is_train THEN label END AS label,
 CAST(is_train AS INTEGER) AS is_train FROM subjects""")
def union_tagged_q(spark, sf):
    lab, unl = B.labelled_unlabelled(spark, sf)
    u = union_tagged(lab, unl)
    return u.select("id", F.col("label"), F.col("is_train").cast("int").alias("is_train"))


_GENDER = "CAST(coalesce(sex = 'female', false) AS INTEGER)"


@query("score_align", O.W() + f"""SELECT count(*) AS total_truth, count(*) AS total_pred,
 CAST(0 AS BIGINT) AS only_truth, CAST(0 AS BIGINT) AS only_pred, CAST(0 AS BIGINT) AS dup_keys,
 CAST(sum(CAST(label = {_GENDER} AS INTEGER)) AS BIGINT) AS matches,
 round(sum(CAST(label = {_GENDER} AS INTEGER)) / count(*), 6) AS accuracy
FROM subjects WHERE is_train""")
def score_align(spark, sf):
    lab, _ = B.labelled_unlabelled(spark, sf)
    truth = lab.select("id", "label")
    pred = lab.select("id", X.is_female("sex").alias("label"))
    a = alignment(truth, pred)
    return a.select("total_truth", "total_pred", "only_truth", "only_pred", "dup_keys",
                    F.col("matches").cast("long").alias("matches"), _r("accuracy").alias("accuracy"))


@query("stratified_split", O.W(O.split_cte(45, 0.2)) + "SELECT id, label, is_val FROM sp")
def stratified_split(spark, sf):
    lab, _ = B.labelled_unlabelled(spark, sf)
    return split.stratified_split(lab.select("id", "label"), seed=45, ratio=0.2)


@query("stratified_folds", O.W(
    f"k AS (SELECT id, label, {O.U.format(seed=7)} AS u FROM subjects WHERE is_train)",
    "r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY u, id) - 1 AS rn, "
    "count(*) OVER (PARTITION BY label) AS n FROM k)",
    "b AS (SELECT *, n // 3 + CASE WHEN n % 3 > 0 THEN 1 ELSE 0 END AS b1, "
    "2 * (n // 3) + CASE WHEN n % 3 > 1 THEN 2 WHEN n % 3 > 0 THEN 1 ELSE 0 END AS b2 FROM r)")
    + "SELECT id, label, CAST(CAST(rn >= b1 AS INTEGER) + CAST(rn >= b2 AS INTEGER) AS INTEGER) AS fold FROM b")
def stratified_folds(spark, sf):
    lab, _ = B.labelled_unlabelled(spark, sf)
    return split.stratified_folds(lab.select("id", "label"), seed=7, folds=3)


@query("class_weights", O.W(
    "c AS (SELECT label, count(*) AS n FROM subjects WHERE is_train GROUP BY label)",
    "t AS (SELECT sum(n) AS total, count(*) AS k FROM c)")
    + """SELECT s.id, s.label, round(t.total / (t.k * c.n), 6) AS weight
FROM subjects s JOIN c ON s.label = c.label, t WHERE s.is_train""")
def class_weights(spark, sf):
    lab, _ = B.labelled_unlabelled(spark, sf)
    w = split.class_weights(lab.select("id", "label"))
    return w.select("id", "label", _r("weight").alias("weight"))


# =============================================================================
# E: metrics on the labels table (quality = actual, toxic = predicted)
# =============================================================================

@query("accuracy", """SELECT round(avg(CAST(quality = toxic AS DOUBLE)) * 100, 6) AS accuracy,
 CAST(sum(CAST(quality = toxic AS INTEGER)) AS BIGINT) AS matches, count(*) AS total FROM labels""")
def accuracy_q(spark, sf):
    lab = B.table(spark, sf, "labels")
    a = metrics.accuracy(lab, "quality", "toxic")
    return a.select(_r("accuracy").alias("accuracy"), F.col("matches").cast("long"), "total")


@query("confusion_matrix", """SELECT quality AS actual,
 CAST(sum(CAST(toxic = 0 AS INTEGER)) AS BIGINT) AS pred_0,
 CAST(sum(CAST(toxic = 1 AS INTEGER)) AS BIGINT) AS pred_1 FROM labels GROUP BY quality""")
def confusion_matrix_q(spark, sf):
    return metrics.confusion_matrix(B.table(spark, sf, "labels"), "quality", "toxic")


_REPORT_SQL = """WITH cm AS (SELECT quality AS a, toxic AS p, count(*) AS n FROM labels GROUP BY 1, 2),
cls AS (SELECT a AS c FROM cm UNION SELECT p AS c FROM cm),
per AS (SELECT c,
   coalesce((SELECT sum(n) FROM cm WHERE a = c AND p = c), 0) AS tp,
   coalesce((SELECT sum(n) FROM cm WHERE a = c), 0) AS support,
   coalesce((SELECT sum(n) FROM cm WHERE p = c), 0) AS npred FROM cls),
m AS (SELECT c, support, CASE WHEN npred = 0 THEN 0.0 ELSE tp / npred END AS pr,
   CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS rc FROM per),
m2 AS (SELECT *, CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END AS f1 FROM m)
SELECT CAST(c AS VARCHAR) AS row_name, round(pr, 4) AS precision, round(rc, 4) AS recall, round(f1, 4) AS f1,
  CAST(support AS BIGINT) AS support FROM m2
UNION ALL SELECT 'accuracy', NULL, NULL, round((SELECT sum(n) FROM cm WHERE a = p) / (SELECT sum(n) FROM cm), 4),
  CAST((SELECT sum(n) FROM cm) AS BIGINT)
UNION ALL SELECT 'macro avg', round(avg(pr), 4), round(avg(rc), 4), round(avg(f1), 4), CAST(sum(support) AS BIGINT) FROM m2
UNION ALL SELECT 'weighted avg', round(sum(pr * support) / sum(support), 4), round(sum(rc * support) / sum(support), 4),
  round(sum(f1 * support) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM m2"""


@query("classification_report", _REPORT_SQL)
def classification_report_q(spark, sf):
    return metrics.classification_report(B.table(spark, sf, "labels"), "quality", "toxic")


_P_DOC = "1.0 / (1.0 + exp(-(ln(CAST(d.n_chars AS DOUBLE) + 1.0) - 7.0)))"


@query("log_loss", f"""SELECT round(avg(CASE WHEN l.quality = 1 THEN -ln(least(greatest({_P_DOC}, 1e-15), 1 - 1e-15))
 ELSE -ln(1 - least(greatest({_P_DOC}, 1e-15), 1 - 1e-15)) END), 6) AS log_loss, count(*) AS total
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")
def log_loss_q(spark, sf):
    lab = B.table(spark, sf, "labels")
    docs = B.table(spark, sf, "documents").select("doc_id", "n_chars")
    p = 1.0 / (1.0 + F.exp(-(F.ln(F.col("n_chars").cast("double") + 1.0) - 7.0)))
    j = lab.join(docs, "doc_id").select(F.col("quality").alias("label"), p.alias("p1"))
    return metrics.log_loss(j).select(_r("log_loss").alias("log_loss"), "total")
