"""Profiling, label and sampling queries."""

from pyspark.sql import functions as F

from bandlore.functions import scalar as S
from bandlore.operators import profile as P
from bandlore.operators import sampling as SA
from bandlore.operators import scaling as SC
from bandlore.plans.registry import FITTED, LINES, LONG, SIGNALS, SPLIT, query, rounded


@query("a1_dataset_summary", f"""WITH {LONG} SELECT count(*)//60 AS num_rows, 61 AS num_cols, 60 AS num_features,
60 AS double_cols, 1 AS string_cols, round(min(x), 6) AS global_min, round(max(x), 6) AS global_max,
round(avg(x), 6) AS global_mean, round(stddev_pop(x), 6) AS global_std FROM long""")
def _(t):
    return rounded(P.dataset_summary(t.signals()))


@query("a1_dataset_summary_lineitem", f"""WITH {LINES} SELECT count(*)//4 AS num_rows, 5 AS num_cols, 4 AS num_features,
4 AS double_cols, 1 AS string_cols, round(min(x), 4) AS global_min, round(max(x), 4) AS global_max,
round(avg(x), 4) AS global_mean, round(stddev_pop(x), 4) AS global_std FROM long""")
def _(t):
    return rounded(P.dataset_summary(t.lines()), 4)


@query("a1_dataset_summary_gaps", f"""WITH {SIGNALS}, g AS (SELECT id, CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 = 1 THEN features[1:10]
ELSE features END AS f FROM sig), l AS (SELECT unnest(f) AS x FROM g)
SELECT (SELECT count(*) FROM g) AS num_rows, (SELECT max(len(f)) FROM g) + 1 AS num_cols, (SELECT max(len(f)) FROM g) AS num_features,
(SELECT max(len(f)) FROM g) AS double_cols, 1 AS string_cols, round(min(x), 6) AS global_min, round(max(x), 6) AS global_max,
round(avg(x), 6) AS global_mean, round(stddev_pop(x), 6) AS global_std FROM l""")
def _(t):
    return rounded(P.dataset_summary(_shortened(t.signals())))


@query("a2_missing_audit_short", f"""WITH {SIGNALS}, g AS (SELECT label, CASE WHEN id % 5 = 0 THEN [] WHEN id % 5 = 1 THEN features[1:10]
ELSE features END AS f FROM sig), c AS (SELECT 'freq_' || b AS column_name, count(*) FILTER (WHERE len(f) < b) AS missing
FROM g, (SELECT unnest(range(1, 61)) AS b) GROUP BY b UNION ALL SELECT 'label', count(*) FILTER (WHERE label IS NULL) FROM g)
SELECT column_name, missing, sum(missing) OVER ()::BIGINT AS total_missing, sum(missing) OVER () > 0 AS has_missing FROM c""")
def _(t):
    return P.missing_audit(_shortened(t.signals()))


def _shortened(df):
    """The same table with null arrays and arrays of ten values."""
    short = F.when(F.col("id") % 5 == 1, F.slice("features", 1, 10)).otherwise(F.col("features"))
    return df.withColumn("features", F.when(F.col("id") % 5 != 0, short))


@query("a2_missing_audit", f"""WITH {LONG}, c AS (SELECT 'freq_' || band AS column_name,
count(*) FILTER (WHERE x IS NULL OR isnan(x)) AS missing FROM long GROUP BY band
UNION ALL SELECT 'label', count(*) FILTER (WHERE label IS NULL) FROM sig)
SELECT column_name, missing, sum(missing) OVER ()::BIGINT AS total_missing, sum(missing) OVER () > 0 AS has_missing FROM c""")
def _(t):
    return P.missing_audit(t.signals())


@query("a2_missing_audit_gaps", f"""WITH {LONG}, g AS (SELECT id, band, CASE WHEN (id + band) % 7 = 0 THEN NULL
WHEN (id + band) % 11 = 0 THEN 'nan'::DOUBLE ELSE x END AS x FROM long),
gl AS (SELECT CASE WHEN id % 13 = 0 THEN NULL ELSE label END AS label FROM sig),
c AS (SELECT 'freq_' || band AS column_name, count(*) FILTER (WHERE x IS NULL OR isnan(x)) AS missing FROM g GROUP BY band
UNION ALL SELECT 'label', count(*) FILTER (WHERE label IS NULL) FROM gl)
SELECT column_name, missing, sum(missing) OVER ()::BIGINT AS total_missing, sum(missing) OVER () > 0 AS has_missing FROM c""")
def _(t):
    return P.missing_audit(_with_gaps(t.signals()))


def _with_gaps(df):
    """The same table with nulls and NaNs at fixed places."""
    at = lambda x, i: (
        F.when((F.col("id") + i + 1) % 7 == 0, F.lit(None).cast("double"))
        .when((F.col("id") + i + 1) % 11 == 0, F.lit(float("nan"))).otherwise(x)
    )
    return df.withColumn("features", F.transform("features", at)).withColumn(
        "label", F.when(F.col("id") % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("label"))
    )


_COPIES = """dup AS (SELECT id, features, label FROM sig UNION ALL
SELECT id + 1000000000, features, label FROM sig WHERE label = 'M'
UNION ALL SELECT s.id + 2000000000, f.features, f.label FROM sig s, (SELECT features, label FROM sig ORDER BY id LIMIT 1) f)"""


def _with_copies(t):
    """Signals, a copy of every positive one, and one signal repeated as often as there are rows."""
    s = t.signals()
    first = s.where(F.col("id") == s.agg(F.min("id")).scalar()).select(F.struct("features", "label"))
    hot = s.select((F.col("id") + 2000000000).alias("id")).withColumn("f", first.scalar()).select("id", "f.*")
    again = s.where("label = 'M'").withColumn("id", F.col("id") + 1000000000)
    return s.unionByName(again).unionByName(hot)


@query("a3_duplicate_rows", f"""WITH {SIGNALS}, {_COPIES} SELECT id FROM
(SELECT id, row_number() OVER (PARTITION BY features, label ORDER BY id) AS rn FROM dup) WHERE rn > 1""")
def _(t):
    return P.duplicate_rows(_with_copies(t))


@query("a3_duplicate_audit", f"""WITH {SIGNALS}, {_COPIES} SELECT (SELECT count(*) FROM dup) -
(SELECT count(*) FROM (SELECT DISTINCT features, label FROM dup)) AS num_duplicates,
(SELECT count(*) FROM dup) > (SELECT count(*) FROM (SELECT DISTINCT features, label FROM dup)) AS has_duplicates""")
def _(t):
    return P.duplicate_audit(_with_copies(t))


def _distribution(source, label, category):
    return f"""c AS (SELECT {label} AS label, count(*) AS count FROM {source} WHERE {label} IS NOT NULL GROUP BY 1)
SELECT label, count, round(count*100.0::DOUBLE/sum(count) OVER (), 2) AS pct, (sum(count) OVER ())::BIGINT AS total_records,
round(max(count) OVER ()/(min(count) OVER ())::DOUBLE, 2) AS imbalance_ratio,
round(max(count) OVER ()/(min(count) OVER ())::DOUBLE, 2) < 1.5 AS is_balanced, {category} AS category FROM c"""


_CATEGORY = """CASE label WHEN 'M' THEN 'Mine (Underwater Explosive Threat)'
WHEN 'R' THEN 'Rock (Benign Geological Formation)' ELSE 'Unknown' END"""


@query("a4_class_distribution", f"WITH {SIGNALS}, " + _distribution("sig", "label", _CATEGORY))
def _(t):
    return P.class_distribution(t.signals())


@query("a4_class_distribution_lineitem", "WITH " + _distribution("lineitem", "l_returnflag", _CATEGORY))
def _(t):
    return P.class_distribution(t.table("lineitem"), "l_returnflag")


def _describe(d):
    return f"""SELECT band, count(x) AS count, round(avg(x), {d}) AS mean, round(stddev_samp(x), {d}) AS std,
round(min(x), {d}) AS min, round(quantile_cont(x, 0.25), {d}) AS q25, round(quantile_cont(x, 0.5), {d}) AS q50,
round(quantile_cont(x, 0.75), {d}) AS q75, round(max(x), {d}) AS max FROM long GROUP BY band"""


@query("a5_describe_bands", f"WITH {LONG} " + _describe(6))
def _(t):
    return rounded(P.describe_bands(t.signals()))


@query("a5_describe_bands_lineitem", f"WITH {LINES} " + _describe(4))
def _(t):
    return rounded(P.describe_bands(t.lines()), 4)


@query("a5_describe_bands_selected", f"WITH {LINES} " + _describe(4))
def _(t):
    # the path for groups too large for one task, forced by a low bound
    return rounded(P.describe_bands(t.lines(), ranges=7), 4)


@query("a6_variance_extremes", f"""WITH {LONG}, v AS (SELECT band, var_samp(x) AS variance FROM long GROUP BY band),
r AS (SELECT band, variance, row_number() OVER (ORDER BY variance DESC, band) AS rank FROM v)
SELECT CASE WHEN rank <= 5 THEN 'top' ELSE 'lowest' END AS side, rank, band, round(variance, 8) AS variance
FROM r WHERE rank <= 5 OR rank > 55""")
def _(t):
    return rounded(P.variance_extremes(t.signals()), 8)


_CLASS = """SELECT band, label, count(x) AS count, round(avg(x), {d}) AS mean, round(stddev_samp(x), {d}) AS std
FROM long GROUP BY band, label"""


@query("a7_class_stats", f"WITH {LONG} " + _CLASS.format(d=6))
def _(t):
    return rounded(P.class_stats(t.signals()))


@query("a7_class_stats_lineitem", f"WITH {LINES} " + _CLASS.format(d=4))
def _(t):
    return rounded(P.class_stats(t.lines()), 4)


def _contrast(a, b, d):
    return f"""c AS (SELECT band, avg(x) FILTER (WHERE label = '{a}') AS p, avg(x) FILTER (WHERE label = '{b}') AS n
FROM long GROUP BY band) SELECT band, round(p, {d}) AS mean_pos, round(n, {d}) AS mean_neg, round(abs(p - n), {d}) AS diff
FROM c ORDER BY abs(p - n) DESC, band LIMIT 5"""


@query("a8_class_contrast", f"WITH {LONG}, " + _contrast("M", "R", 6))
def _(t):
    return rounded(P.top_contrast(t.signals()))


@query("a8_class_contrast_lineitem", f"WITH {LINES}, " + _contrast("A", "R", 4))
def _(t):
    return rounded(P.top_contrast(t.lines(), positive="A", negative="R"), 4)


@query("a9_mean_signature", f"""WITH {LONG} SELECT band, label, round(avg(x), 6) AS mean,
round(avg(x) - 0.5*stddev_samp(x), 6) AS lower, round(avg(x) + 0.5*stddev_samp(x), 6) AS upper FROM long GROUP BY band, label""")
def _(t):
    return rounded(P.mean_signature(t.signals()))


@query("a10_reference_profiles", f"""WITH {LONG}, m AS (SELECT label, band, round(avg(x), 4) AS v FROM long GROUP BY label, band)
SELECT label, band, v AS value FROM m""")
def _(t):
    return P.reference_profiles(t.signals()).select("label", F.posexplode("profile").alias("p", "value")).select(
        "label", (F.col("p") + 1).alias("band"), "value"
    )


_HIST = """b AS (SELECT band, label, x FROM long WHERE band IN ({bands})),
r AS (SELECT band, min(x) AS lo, (max(x) - min(x))/15 AS w FROM b GROUP BY band),
h AS (SELECT band, label, lo, w, least(floor((x - lo)/w), 14)::BIGINT AS bin, count(*) AS count
  FROM b JOIN r USING (band) GROUP BY ALL)
SELECT band, label, bin, round(lo + bin*w, {d}) AS left_edge, count,
round(count/(sum(count) OVER (PARTITION BY band, label)*w), {e}) AS density FROM h"""


@query("a11_class_histogram", f"WITH {LONG}, " + _HIST.format(bands="10, 20, 35, 48", d=6, e=6))
def _(t):
    return rounded(P.class_histogram(t.signals()))


@query("a11_class_histogram_lineitem", f"WITH {LINES}, " + _HIST.format(bands="1, 2", d=6, e=6))
def _(t):
    return rounded(P.class_histogram(t.lines(), [1, 2]))


@query("a12_class_density", f"""WITH {LONG}, b AS (SELECT band, label, x FROM long WHERE band IN (10, 20, 35, 48)),
r AS (SELECT band, min(x) AS lo, max(x) AS hi FROM b GROUP BY band),
s AS (SELECT band, label, count(*) AS n, stddev_samp(x)*power(count(*), -0.2) AS h FROM b GROUP BY band, label),
g AS (SELECT unnest(range(200)) AS point),
d AS (SELECT band, label, point, lo + point*(hi - lo)/199 AS value, n, h, x FROM b JOIN r USING (band) JOIN s USING (band, label), g)
SELECT band, label, point, round(value, 6) AS value, round(sum(exp(-0.5*((x - value)/h)*((x - value)/h)))/(n*h*sqrt(2*pi())), 6) AS density
FROM d GROUP BY band, label, point, value, n, h""")
def _(t):
    return rounded(P.class_density(t.signals()))


_BOX = """b AS (SELECT band, label, x FROM long WHERE band IN ({bands})),
q AS (SELECT band, label, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q75
  FROM b GROUP BY band, label),
f AS (SELECT *, x >= q25 - 1.5*(q75 - q25) AND x <= q75 + 1.5*(q75 - q25) AS inside FROM b JOIN q USING (band, label))"""
_BOXES = """SELECT band, label, round(q25, {d}) AS q25, round(median, {d}) AS median, round(q75, {d}) AS q75,
round(min(x) FILTER (WHERE inside), {d}) AS whisker_lo, round(max(x) FILTER (WHERE inside), {d}) AS whisker_hi,
count(*) FILTER (WHERE NOT inside) AS outliers FROM f GROUP BY band, label, f.q25, f.median, f.q75"""


@query("a13_box_stats", f"WITH {LONG}, " + _BOX.format(bands="11, 21, 28, 36") + _BOXES.format(d=6))
def _(t):
    return rounded(P.box_stats(t.signals()))


@query("a13_box_stats_lineitem", f"WITH {LINES}, " + _BOX.format(bands="1, 2, 3, 4") + _BOXES.format(d=4))
def _(t):
    return rounded(P.box_stats(t.lines(), [1, 2, 3, 4]), 4)


@query("a13_box_outliers", f"WITH {LONG}, " + _BOX.format(bands="11, 21, 28, 36") +
       "SELECT band, label, round(x, 6) AS x, CASE WHEN x > median THEN 'high' ELSE 'low' END AS side FROM f WHERE NOT inside")
def _(t):
    return rounded(P.box_outliers(t.signals()))


_CORR = """SELECT a.band AS band_a, b.band AS band_b, round(corr(a.x, b.x), 6) AS corr
FROM {s} a JOIN {s} b USING (id) WHERE a.band % 2 = 1 AND b.band % 2 = 1 {w} GROUP BY a.band, b.band"""


@query("a14_correlation_matrix", f"WITH {LONG} " + _CORR.format(s="long", w=""))
def _(t):
    return rounded(P.correlation_matrix(t.signals()))


@query("a14_correlation_matrix_gaps", f"""WITH {LONG}, g AS (SELECT id, band, CASE WHEN (id + band) % 7 = 0 THEN NULL
WHEN (id + band) % 11 = 0 THEN NULL ELSE x END AS x FROM long) """ + _CORR.format(s="g", w=""))
def _(t):
    return rounded(P.correlation_matrix(_with_gaps(t.signals())))


@query("a14_correlation_matrix_lineitem", """WITH v AS (SELECT unnest([1,2,3,4]) AS band_a, 1 AS one FROM region LIMIT 4),
c AS (SELECT corr(l_quantity, l_quantity) AS c11, corr(l_quantity, l_extendedprice) AS c12, corr(l_quantity, l_discount) AS c13,
corr(l_quantity, l_tax) AS c14, corr(l_extendedprice, l_extendedprice) AS c22, corr(l_extendedprice, l_discount) AS c23,
corr(l_extendedprice, l_tax) AS c24, corr(l_discount, l_discount) AS c33, corr(l_discount, l_tax) AS c34,
corr(l_tax, l_tax) AS c44 FROM lineitem)
SELECT unnest([1,1,1,1,2,2,2,2,3,3,3,3,4,4,4,4]) AS band_a, unnest([1,2,3,4,1,2,3,4,1,2,3,4,1,2,3,4]) AS band_b,
unnest([round(c11, 6), round(c12, 6), round(c13, 6), round(c14, 6), round(c12, 6), round(c22, 6), round(c23, 6), round(c24, 6),
round(c13, 6), round(c23, 6), round(c33, 6), round(c34, 6), round(c14, 6), round(c24, 6), round(c34, 6), round(c44, 6)]) AS corr FROM c""")
def _(t):
    return rounded(P.correlation_matrix(t.lines(), [1, 2, 3, 4]))


@query("a28_raw_table_check", f"""WITH {SIGNALS}, g AS (SELECT label, CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 = 1 THEN features[1:10]
ELSE features END AS f FROM sig) SELECT count(*) AS num_rows, max(len(f)) + 1 AS num_cols,
count(*) FILTER (WHERE coalesce(len(f), 0) <> 60) AS bad_width, count(*) FILTER (WHERE label = 'M') AS positives,
count(*) FILTER (WHERE label = 'R') AS negatives FROM g""")
def _(t):
    return P.raw_table_check(_shortened(t.signals()))


@query("p2_class_filter", f"""WITH {SIGNALS} SELECT id, round(features[1], 6) AS first FROM sig WHERE label = 'M'""")
def _(t):
    return rounded(t.signals().where("label = 'M'").select("id", F.col("features")[0].alias("first")))


@query("p3_head_preview", f"""WITH {SIGNALS} SELECT id, round(features[1], 6) AS freq_1, round(features[2], 6) AS freq_2,
round(features[3], 6) AS freq_3, round(features[4], 6) AS freq_4, round(features[5], 6) AS freq_5,
round(features[59], 6) AS freq_59, round(features[60], 6) AS freq_60, label FROM sig ORDER BY id LIMIT 5""")
def _(t):
    return rounded(P.head_preview(t.signals()))


@query("p5_odd_bands", f"""WITH {LONG} SELECT band, count(*) AS n, round(avg(x), 6) AS mean FROM long WHERE band % 2 = 1 GROUP BY band""")
def _(t):
    from bandlore.sources.signals import bands

    odd = bands(t.signals()).where("band % 2 = 1")
    return rounded(odd.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean")))


@query("p6_representative_bands", f"""WITH {LONG} SELECT id, band, round(x, 6) AS x FROM long
WHERE band IN (10, 20, 35, 48, 11, 21, 28, 36)""")
def _(t):
    from bandlore import constants as K
    from bandlore.sources.signals import bands

    wanted = K.HISTOGRAM_BANDS + K.BOX_BANDS
    return rounded(bands(t.signals()).where(F.col("band").isin(wanted)).select("id", "band", "x"))


@query("p7_encode_labels", f"""WITH {SIGNALS} SELECT id, CASE label WHEN 'M' THEN 1 ELSE 0 END AS y FROM sig""")
def _(t):
    return t.signals().select("id", S.encode_label("label").alias("y"))


@query("p7_encode_labels_lineitem", """SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 END AS code, count(*) AS n
FROM lineitem GROUP BY 1""")
def _(t):
    # 'R' is unknown to this mapping and comes out as null, for quarantine
    code = S.encode_label("l_returnflag", {"A": 0, "N": 1}, on_unknown="null")
    return t.table("lineitem").groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query("p8_decode_labels", """SELECT doc_id, CASE toxic WHEN 1 THEN 'M' WHEN 0 THEN 'R' END AS label,
CASE toxic WHEN 1 THEN 'Mine (Underwater Threat)' WHEN 0 THEN 'Rock (Non-threat)' END AS description FROM labels""")
def _(t):
    return t.table("labels").select(
        "doc_id", S.decode_label("toxic").alias("label"), S.describe_class("toxic").alias("description"))


@query("p13_band_names", f"""WITH {LONG} SELECT band, 'Freq_' || lpad(band::VARCHAR, 2, '0') AS feature, count(*) AS n FROM long GROUP BY band""")
def _(t):
    from bandlore.sources.signals import bands

    return bands(t.signals()).groupBy("band", S.band_name("band").alias("feature")).agg(F.count(F.lit(1)).alias("n"))


@query("p14_label_domain", f"""WITH {SIGNALS} SELECT 2 - count(DISTINCT label) FILTER (WHERE label IN ('M', 'R')) AS absent,
count(DISTINCT label) FILTER (WHERE label NOT IN ('M', 'R')) AS unexpected,
count(DISTINCT label) FILTER (WHERE label IN ('M', 'R')) = 2 AND count(DISTINCT label) FILTER (WHERE label NOT IN ('M', 'R')) = 0 AS equal FROM sig""")
def _(t):
    return P.label_domain_check(t.signals())


@query("u1_unknown_labels", """SELECT DISTINCT l_returnflag AS label FROM lineitem WHERE l_returnflag NOT IN ('M', 'R')""")
def _(t):
    return P.unknown_labels(t.lines())


@query("u2_label_sets", """WITH s AS (SELECT DISTINCT l_returnflag AS f FROM lineitem),
k AS (SELECT unnest(['M', 'R']) AS f) SELECT (SELECT count(*) FROM k WHERE f NOT IN (SELECT f FROM s)) AS absent,
(SELECT count(*) FROM s WHERE f IS NULL OR f NOT IN (SELECT f FROM k)) AS unexpected,
(SELECT count(*) FROM k WHERE f NOT IN (SELECT f FROM s)) = 0 AND (SELECT count(*) FROM s WHERE f NOT IN (SELECT f FROM k)) = 0 AS equal""")
def _(t):
    return P.label_domain_check(t.lines())


@query("f14_band_zones", f"""WITH {LONG} SELECT CASE WHEN band <= 15 THEN 'Low' WHEN band <= 35 THEN 'Mid' ELSE 'High' END AS zone,
label, count(*) AS n, round(avg(x), 6) AS mean FROM long GROUP BY 1, 2""")
def _(t):
    from bandlore.sources.signals import bands

    return rounded(bands(t.signals()).groupBy(S.band_zone("band").alias("zone"), "label").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean")))


@query("w10_first_of_class", f"""WITH {SIGNALS} SELECT label, id, round(features[1], 6) AS first FROM sig
QUALIFY row_number() OVER (PARTITION BY label ORDER BY id) = 1""")
def _(t):
    return rounded(P.first_of_class(t.signals()).select("label", "id", F.col("features")[0].alias("first")))


@query("m1_stratified_split", f"WITH {SPLIT} SELECT id, label, split FROM sp")
def _(t):
    return SA.split_rows(t.signals()).select("id", "label", "split")


@query("m1_plain_split", f"""WITH {SIGNALS} SELECT id, CASE WHEN row_number() OVER (ORDER BY h, id) <=
count(*) OVER () - ceil(0.2::DOUBLE*count(*) OVER ()) THEN 'train' ELSE 'test' END AS split FROM sig""")
def _(t):
    return SA.split_rows(t.signals(), stratify=False).select("id", "split")


@query("m1_split_lineitem_orders", """WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS label, md5('42:' || o_orderkey::VARCHAR) AS h FROM orders),
cls AS (SELECT label, count(*) AS c, sum(count(*)) OVER () AS n FROM o GROUP BY label),
sh AS (SELECT label, n - ceil(0.2::DOUBLE*n) AS t, (n - ceil(0.2::DOUBLE*n))*c::DOUBLE/n AS share FROM cls),
qt AS (SELECT label, floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, label)
  <= t - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS q FROM sh),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, id) AS rn FROM o)
SELECT id, label, CASE WHEN rn <= q THEN 'train' ELSE 'test' END AS split FROM rk JOIN qt USING (label)""")
def _(t):
    rows = t.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("label"))
    return SA.split_rows(rows)


@query("m1b_approximate_split", """SELECT o_orderkey AS id, CASE WHEN ('0x' || substr(md5('42:' || o_orderkey::VARCHAR), 1, 8))::UBIGINT/4294967296.0::DOUBLE
< 0.2 THEN 'test' ELSE 'train' END AS split FROM orders""")
def _(t):
    return SA.split_rows_approx(t.table("orders").select(F.col("o_orderkey").alias("id")))


_FOLDS = SPLIT + """,
tr AS (SELECT id, y, features, label, row_number() OVER (PARTITION BY y ORDER BY h, id) AS r FROM sp WHERE split = 'train'),
cc AS (SELECT y, count(*) AS c FROM tr GROUP BY y),
ab AS (SELECT y, sum(c) OVER (ORDER BY y) - c AS a, sum(c) OVER (ORDER BY y) AS b FROM cc),
ends AS (SELECT y, i, sum((b + 4 - i)//5 - (a + 4 - i)//5) OVER (PARTITION BY y ORDER BY i) AS upto
  FROM ab, (SELECT unnest(range(5)) AS i)),
fd AS (SELECT tr.id, tr.y, tr.features, tr.label, (SELECT count(*) FROM ends WHERE ends.y = tr.y AND upto < r) AS fold FROM tr)"""


@query("m12_stratified_folds", f"WITH {_FOLDS} SELECT id, y, fold FROM fd")
def _(t):
    return SA.stratified_folds(t.parts()[0].select("id", "y"))


@query("m12_fold_sizes", f"WITH {_FOLDS} SELECT fold, y, count(*) AS rows FROM fd GROUP BY fold, y")
def _(t):
    folds = SA.stratified_folds(t.parts()[0].select("id", "y"))
    return folds.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("rows"))


@query("m15_learning_prefixes", f"""WITH {_FOLDS},
n0 AS (SELECT count(*) AS n FROM fd WHERE fold <> 0),
cp AS (SELECT id, fold, held, row_number() OVER (PARTITION BY held ORDER BY md5('43:' || id::VARCHAR), id) AS r
  FROM fd, (SELECT unnest(range(5)) AS held) WHERE fold <> held)
SELECT held, step, count(*) AS rows FROM cp, n0, (SELECT unnest(range(5)) AS step)
WHERE r <= floor(([0.2::DOUBLE, 0.4::DOUBLE, 0.6::DOUBLE, 0.8::DOUBLE, 1.0::DOUBLE])[step + 1]*n) GROUP BY held, step""")
def _(t):
    from bandlore.operators.training import learning_curve_sizes

    return learning_curve_sizes(t.folded().select("id", "y", "fold"))


@query("a15_split_audit", f"""WITH {SPLIT}, c AS (SELECT split, label, count(*) AS rows FROM sp GROUP BY split, label),
p AS (SELECT *, (sum(rows) OVER (PARTITION BY split))::BIGINT AS split_rows, rows*100.0::DOUBLE/sum(rows) OVER (PARTITION BY split) AS pct,
sum(rows) OVER (PARTITION BY label)*100.0::DOUBLE/sum(rows) OVER () AS pct_full FROM c)
SELECT split, label, rows, split_rows, round(pct, 6) AS pct, round(pct_full, 6) AS pct_full, round(abs(pct - pct_full), 6) AS drift,
abs(pct - pct_full) <= 1 AS within_tolerance FROM p""")
def _(t):
    return rounded(SA.split_audit(t.split()))


_SCALES = FITTED + """,
sc AS (SELECT band, {shift} AS shift, CASE WHEN min(x) < max(x) THEN {scale} ELSE 1 END AS scale
  FROM slong WHERE split = 'train' GROUP BY band)"""
_STANDARD = _SCALES.format(shift="avg(x)", scale="stddev_pop(x)")
_MINMAX = _SCALES.format(shift="min(x)", scale="max(x) - min(x)")


@query("m2_standard_scaler", f"WITH {_STANDARD} SELECT id, split, band, round((x - shift)/scale, 6) AS z FROM slong JOIN sc USING (band)")
def _(t):
    return _scaled(t, "standard")


@query("m3_minmax_scaler", f"WITH {_MINMAX} SELECT id, split, band, round((x - shift)/scale, 6) AS z FROM slong JOIN sc USING (band)")
def _(t):
    return _scaled(t, "minmax")


def _scaled(t, kind):
    rows = t.split()
    out = SC.scale_features(rows, SC.band_scales(rows.where("split = 'train'"), kind))
    return rounded(out.select("id", "split", F.posexplode("scaled").alias("p", "z")).select(
        "id", "split", (F.col("p") + 1).alias("band"), "z"))


@query("m2_fitted_scales", f"WITH {_STANDARD} SELECT band, round(shift, 6) AS shift, round(scale, 6) AS scale FROM sc")
def _(t):
    return rounded(SC.band_scales(t.parts()[0]))


@query("m2_standard_scaler_lineitem", f"""WITH {LINES}, sc AS (SELECT band, avg(x) AS shift, stddev_pop(x) AS scale FROM long GROUP BY band)
SELECT band, label, round(avg((x - shift)/scale), 6) AS mean_z, round(min((x - shift)/scale), 6) AS min_z,
round(max((x - shift)/scale), 6) AS max_z FROM long JOIN sc USING (band) GROUP BY band, label""")
def _(t):
    rows = t.lines()
    z = SC.scale_features(rows, SC.band_scales(rows)).select("label", F.posexplode("scaled").alias("p", "z"))
    return rounded(z.groupBy((F.col("p") + 1).alias("band"), "label").agg(
        F.avg("z").alias("mean_z"), F.min("z").alias("min_z"), F.max("z").alias("max_z")))


@query("f10_inverse_scaling", f"WITH {LONG} SELECT id, band, round(x, 6) AS x FROM long")
def _(t):
    rows = t.split()
    scales = SC.band_scales(rows.where("split = 'train'"))
    back = SC.unscale_features(SC.scale_features(rows, scales).drop("features"), scales)
    return rounded(back.select("id", F.posexplode("features").alias("p", "x")).select(
        "id", (F.col("p") + 1).alias("band"), "x"))


@query("a16_scaling_audit", f"""WITH {_STANDARD}, z AS (SELECT split, band, avg((x - shift)/scale) AS m, stddev_samp((x - shift)/scale) AS s
FROM slong JOIN sc USING (band) GROUP BY split, band)
SELECT split, round(min(m), 6) AS mean_min, round(max(m), 6) AS mean_max, round(min(s), 6) AS std_min, round(max(s), 6) AS std_max
FROM z GROUP BY split""")
def _(t):
    rows = t.split()
    return rounded(SC.scaling_audit(SC.scale_features(rows, SC.band_scales(rows.where("split = 'train'")))))


@query("m17_preprocessing", f"WITH {_STANDARD} SELECT id, y, split, round(sum((x - shift)/scale), 6) AS total FROM slong JOIN sc USING (band) GROUP BY id, y, split")
def _(t):
    from bandlore.plans.preprocess import SignalPreprocessor

    prepared = SignalPreprocessor().fit(t.signals())
    total = F.aggregate("scaled_array", F.lit(0.0), lambda a, v: a + v)
    return rounded(prepared.select("id", "y", "split", total.alias("total")))
