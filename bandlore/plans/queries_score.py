"""Source, sink, parsing, scoring, streaming and attribution queries."""

from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.functions import scalar as S
from bandlore.operators import evaluate as E
from bandlore.operators import explain as X
from bandlore.operators import linear as L
from bandlore.operators import profile as P
from bandlore.operators import sampling as SA
from bandlore.operators import score as SC
from bandlore.plans.queries_evaluate import _COUNTS, _sweep
from bandlore.plans.registry import FITTED, LONG, METRICS, SCORED, SIGNALS, SPLIT, ZONES, query, rounded
from bandlore.session import scratch_path
from bandlore.sources import signals as G
from bandlore.sources import sinks
from bandlore.streaming import score_stream as ST


def _csv(t, header=False, label=True):
    """The signal table written out as CSV, the form it arrives in."""
    path = scratch_path(t.spark, "signals-csv")
    keep = ("label",) if label else ()
    wide = G.to_columns(t.signals(), keep=keep)
    wide.select(*[c for c in wide.columns if c != "label"], *keep).write.option("header", header).csv(path)
    return path


_CSV_SQL = """SELECT round(features[1], 6) AS freq_1, round(features[30], 6) AS freq_30, round(features[60], 6) AS freq_60, label FROM sig"""


@query("s1_csv_scan", f"WITH {SIGNALS} {_CSV_SQL}")
def _(t):
    rows = G.read_signal_csv(t.spark, _csv(t))
    return rounded(rows.select("freq_1", "freq_30", "freq_60", "label"))


def _text_lines(t, label):
    """Signals as lines of text: a word among the values, one value or 15 too many, one too few, by the id's remainder."""
    path = scratch_path(t.spark, "signals-text")
    kind = F.col("id") % 7
    values = F.transform("features", lambda x, i: F.when((kind == 0) & (i == 5), F.lit("abc")).otherwise(x.cast("string")))
    values = F.when(kind == 3, F.slice(values, 1, K.N_BANDS - 1)).otherwise(values)
    more = F.when(kind == 1, F.lit("0.5")).when(kind == 2, F.lit(",".join(["0.5"] * 15)))
    t.signals().select(F.concat_ws(",", values, more, *(["label"] if label else []))).write.text(path)
    return path


@query("s1_csv_quarantine", f"""WITH {SIGNALS} SELECT CASE id % 7 WHEN 0 THEN 'non-numeric feature' WHEN 1 THEN 'expected 61 columns, got 62'
WHEN 2 THEN 'expected 61 columns, got 76' WHEN 3 THEN 'expected 61 columns, got 60' END AS reason, count(*) AS rows FROM sig GROUP BY 1""")
def _(t):
    path = _text_lines(t, label=True)
    return G.read_checked_csv(t.spark, path).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query("s2_csv_scan_positional", f"""WITH {SIGNALS} SELECT round(features[1], 6) AS _c0, round(features[60], 6) AS _c59, label AS _c60 FROM sig""")
def _(t):
    return rounded(G.read_signal_csv(t.spark, _csv(t), named=False).select("_c0", "_c59", "_c60"))


@query("s3_split_scan", f"WITH {SPLIT} SELECT id, label, y FROM sp WHERE split = 'train'")
def _(t):
    path = sinks.write_splits(t.split(), scratch_path(t.spark, "splits"))
    return sinks.read_split(t.spark, path, "train").select("id", "label", "y")


@query("s4_batch_quarantine", f"""WITH {SIGNALS} SELECT CASE id % 7 WHEN 0 THEN 'non-numeric feature'
WHEN 2 THEN 'expected 60 features, got 75' WHEN 3 THEN 'expected 60 features, got 59' END AS reason, count(*) AS rows FROM sig GROUP BY 1""")
def _(t):
    return G.read_batch_csv(t.spark, _text_lines(t, label=False)).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query("s6_json_quarantine", f"""WITH {SIGNALS} SELECT CASE id % 4 WHEN 0 THEN 'non-numeric feature' WHEN 1 THEN 'expected 60 features, got 61'
WHEN 2 THEN 'no features' END AS reason, count(*) AS rows FROM sig GROUP BY 1""")
def _(t):
    path = scratch_path(t.spark, "signals-json")
    kind, text = F.col("id") % 4, F.transform("features", lambda x, i: x.cast("string"))
    odd = F.when(kind == 0, F.concat(F.array(F.lit("abc")), F.slice(text, 2, K.N_BANDS - 1))).when(
        kind == 1, F.concat(text, F.array(F.lit("0.5")))).when(kind == 3, text)
    # to_json leaves nulls out; a null inner array is written as it is
    body = F.coalesce(F.to_json(odd), F.lit("null"))
    t.signals().select(F.concat(F.lit('{"signals": ['), body, F.lit("]}"))).write.text(path)
    return G.read_checked_json(t.spark, path).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query("s4_batch_csv", f"""WITH {LONG} SELECT band, count(*) AS n, round(avg(x), 6) AS mean FROM long GROUP BY band""")
def _(t):
    rows = G.read_batch_csv(t.spark, _csv(t))
    return rounded(G.bands(rows).groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean")))


@query("s5_batch_csv_header", f"""WITH {LONG} SELECT band, count(*) AS n, round(avg(x), 6) AS mean FROM long GROUP BY band""")
def _(t):
    rows = G.read_batch_csv(t.spark, _csv(t, header=True, label=False), header=True)
    return rounded(G.bands(rows).groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean")))


@query("s6_json_signals", f"""WITH {SIGNALS} SELECT row_number() OVER (PARTITION BY id // 50 ORDER BY id) - 1 AS position,
round(features[1], 6) AS first, round(features[60], 6) AS last, len(features) AS width FROM sig""")
def _(t):
    path = scratch_path(t.spark, "signals-json")
    docs = t.signals().groupBy(F.floor(F.col("id") / 50).alias("doc")).agg(  # 50 signals per document
        F.array_sort(F.collect_list(F.struct("id", "features"))).alias("s"))
    docs.select(F.to_json(F.struct(F.col("s.features").alias("signals")))).write.text(path)
    rows = G.read_signal_json(t.spark, path)
    return rounded(rows.select("position", F.col("features")[0].alias("first"), F.col("features")[59].alias("last"),
                               F.size("features").alias("width")))


_CELLS = f"""cf AS (SELECT model, {_COUNTS.format(p="pred_label = 1")} FROM scored GROUP BY model), m AS (SELECT *, {METRICS} FROM cf)"""


@query("s7_json_report", f"""WITH {ZONES}, {_CELLS} SELECT model, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy, round(f1 - coalesce(b_f1, f1), 6) AS delta_f1
FROM m LEFT JOIN (SELECT model AS bm, 2*count(*) FILTER (WHERE y = 1 AND prob >= 0.43)/nullif(count(*) FILTER (WHERE y = 1) +
count(*) FILTER (WHERE prob >= 0.43), 0)::DOUBLE AS b_f1 FROM scored GROUP BY model) ON bm = model""")
def _(t):
    # the report of the safe threshold is read back as the baseline of a comparison
    metrics = E.classification_metrics(t.zones())
    earlier = E.classification_metrics(E.apply_tau(t.zones(), K.SAFE_TAU))
    path = sinks.write_report_json(
        earlier.agg(F.collect_list(F.struct("model", "f1", "accuracy")).alias("results")),  # one entry per model
        scratch_path(t.spark, "report"))
    schema = "results array<struct<model string, f1 double, accuracy double>>"
    baseline = G.read_json_report(t.spark, path, schema).select(F.inline("results"))
    return rounded(E.compare_to_baseline(metrics, baseline).select("model", "f1", "accuracy", "delta_f1"))


@query("s8_stored_threshold", f"""WITH {_sweep(ZONES)}, f AS (SELECT model, step FROM sw WHERE total_cost < 1000000
QUALIFY row_number() OVER (PARTITION BY model ORDER BY recall < 0.999, CASE WHEN recall >= 0.999 THEN "precision" ELSE recall END DESC, step) = 1)
SELECT model, CASE WHEN model = 'low' THEN 0.43 ELSE round(step::DOUBLE/100, 6) END AS tau FROM f""")
def _(t):
    points = E.operating_points(E.threshold_sweep(t.zones())).where("point = 'high_recall_safe'")
    key = F.when(F.col("model") == "low", "other").otherwise("high_recall_safe")
    doc = points.select("model", F.to_json(F.struct(
        F.create_map(key, F.struct("threshold")).alias("operating_points"))).alias("doc"))
    return rounded(doc.select("model", S.json_number(
        "doc", "$.operating_points.high_recall_safe.threshold", K.SAFE_TAU).alias("tau")))


@query("s9_written_splits", f"WITH {SPLIT} SELECT split, label, count(*) AS rows FROM sp GROUP BY split, label")
def _(t):
    path = sinks.write_splits(t.split(), scratch_path(t.spark, "splits"))
    return t.spark.read.parquet(path).groupBy("split", "label").agg(F.count(F.lit(1)).alias("rows"))


@query("s10_split_metadata", f"""WITH {SPLIT} SELECT count(*) FILTER (WHERE split = 'train') AS train_samples,
count(*) FILTER (WHERE split = 'test') AS test_samples, count(*) AS total_samples, 60 AS n_features, 60 AS named, 'StandardScaler' AS scaler_type,
count(*) FILTER (WHERE split = 'train' AND y = 1) AS train_1, count(*) FILTER (WHERE split = 'train' AND y = 0) AS train_0,
count(*) FILTER (WHERE split = 'test' AND y = 1) AS test_1, count(*) FILTER (WHERE split = 'test' AND y = 0) AS test_0 FROM sp""")
def _(t):
    meta = SA.split_metadata(t.split())
    return meta.select(
        "train_samples", "test_samples", "total_samples", "n_features", F.size("feature_names").alias("named"), "scaler_type",
        *[F.col(f"{s}_class_distribution.{c}").alias(f"{s}_{c}") for s in ("train", "test") for c in (1, 0)])


@query("s11_metric_table_csv", f"""WITH {ZONES}, {_CELLS} SELECT model, tp, fp, tn, fn, round(accuracy, 4) AS accuracy,
round("precision", 4) AS "precision", round(recall, 4) AS recall, round(f1, 4) AS f1 FROM m""")
def _(t):
    table = sinks.rounded(E.classification_metrics(t.zones()))
    path = sinks.write_table_csv(table, scratch_path(t.spark, "metrics"))
    return t.spark.read.schema(table.schema).option("header", True).csv(path)


@query("s12_report_json")
def _(t):
    audit = E.safety_audit(t.scored())
    path = sinks.write_report_json(audit, scratch_path(t.spark, "report"))
    return G.read_json_report(t.spark, path).drop("timestamp")


_BATCH = """SELECT id, round(prob, 6) AS "Probability_Mine", round(1 - prob, 6) AS "Probability_Rock",
CASE WHEN prob >= 0.43 THEN 'Mine' ELSE 'Rock' END AS "Prediction" FROM scored"""


@query("s13_scored_csv", f"WITH {SCORED} {_BATCH}")
def _(t):
    out = SC.batch_columns(t.scored().select("id", "prob"), K.SAFE_TAU).drop("prob")
    path = sinks.write_scored(out, scratch_path(t.spark, "scored"))
    return rounded(t.spark.read.schema(out.schema).option("header", True).csv(path))


@query("k1_batch_scoring", f"WITH {SCORED} {_BATCH}")
def _(t):
    rows = t.scored_wide().select("id", "prob")
    return rounded(SC.batch_columns(rows, K.SAFE_TAU).drop("prob"))


@query("p1_features_and_target", f"""WITH {SIGNALS} SELECT label, len(features) AS width, round(features[60], 6) AS last FROM sig""")
def _(t):
    wide = G.to_columns(t.signals(), keep=("label",))
    out = G.features_and_target(wide)
    return rounded(out.select("label", F.size("features").alias("width"), F.col("features")[59].alias("last")))


@query("p4_batch_preview", f"""WITH {SCORED}, o AS (SELECT * FROM scored ORDER BY id LIMIT 50)
SELECT row_number() OVER (ORDER BY id) AS signal_index, round(prob, 4) AS probability_mine, round(1 - prob, 4) AS probability_rock,
CASE WHEN prob >= 0.43 THEN 'Mine' ELSE 'Rock' END AS classification, prob >= 0.43 AS is_threat FROM o""")
def _(t):
    return SC.batch_preview(t.scored(), K.SAFE_TAU)


def _spoiled(t):
    """Signals as they may arrive: some too short, some with a word or a NaN among the values."""
    text = F.transform("features", lambda x: x.cast("string"))
    word = lambda v: F.transform(text, lambda x, i: F.when(i == 7, F.lit(v)).otherwise(x))
    kind = F.col("id") % 5
    return t.signals().select(
        "id", F.when(kind == 0, F.slice(text, 1, 59)).when(kind == 1, word("abc")).when(kind == 2, word("NaN")).otherwise(text).alias("features"))


@query("p9_p10_validation", f"""WITH {SIGNALS} SELECT id, CASE id % 5 WHEN 0 THEN 'expected 60 features, got 59'
WHEN 1 THEN 'non-numeric feature' WHEN 2 THEN 'non-numeric feature' END AS reason FROM sig""")
def _(t):
    return G.validate(_spoiled(t)).select("id", "reason")


@query("p9_p10_quarantine", f"""WITH {LONG} SELECT id, round(sum(x), 6) AS total FROM long WHERE id % 5 > 2 GROUP BY id""")
def _(t):
    good, _ = G.split_quarantine(G.validate(_spoiled(t)))
    return rounded(good.select("id", F.aggregate("features", F.lit(0.0), lambda a, v: a + v).alias("total")))


@query("p11_threshold_validation", f"""WITH {SCORED} SELECT id, prob*1.4::DOUBLE - 0.2::DOUBLE > 0 AND prob*1.4::DOUBLE - 0.2::DOUBLE < 1 AS valid FROM scored""")
def _(t):
    return t.scored().select("id", S.is_valid_tau(F.col("prob") * 1.4 - 0.2).alias("valid"))


@query("p12_threshold_rule", f"WITH {SCORED} SELECT id, prob >= 0.43 AS safe, prob >= 0.5 AS usual FROM scored")
def _(t):
    return t.scored().select("id", S.is_threat("prob", K.SAFE_TAU).alias("safe"), S.is_threat("prob", K.DEFAULT_TAU).alias("usual"))


_TEXT_SQL = f"""WITH {LONG}, v AS (SELECT id, sum(x) AS total FROM long GROUP BY id)
SELECT id, id % 4 <> 3 AS lenient, id % 4 = 0 AS strict, CASE WHEN id % 4 <> 3 THEN round(total, 6) END AS total FROM v"""


@query("f1_f2_parse_text", _TEXT_SQL)
def _(t):
    # typed in with commas, with blanks, with a stray word, and one value short
    text = F.transform("features", lambda x: x.cast("string"))
    kind = F.col("id") % 4
    typed = F.when(kind == 0, F.concat_ws(", ", text)).when(kind == 1, F.concat_ws("  ", text)).when(
        kind == 2, F.concat(F.lit("depth, "), F.concat_ws(",", text))).otherwise(F.concat_ws(",", F.slice(text, 1, 59)))
    rows = t.signals().select("id", typed.alias("typed")).select(
        "id", S.parse_signal("typed").alias("v"), S.parse_signal_strict("typed").alias("w"))
    return rounded(rows.select(
        "id", F.col("v").isNotNull().alias("lenient"), F.col("w").isNotNull().alias("strict"),
        F.when(F.col("v").isNotNull(), F.aggregate("v", F.lit(0.0), lambda a, x: a + x)).alias("total")))


def _confidence(tau):
    return f"""round(CASE WHEN prob >= {tau} THEN (prob - {tau})/(1 - {tau})*100 ELSE ({tau} - prob)/{tau}*100 END, 6)"""


def _level(tau):
    return f"CASE WHEN prob >= 0.75 THEN 'DEFCON-1' WHEN prob >= {tau} THEN 'DEFCON-2' WHEN prob >= 0.25 THEN 'DEFCON-3' ELSE 'DEFCON-4' END"


def _decision(tau):
    t = f"{tau}::DOUBLE"
    return f"""SELECT id, prob >= {t} AS is_threat, CASE WHEN prob >= {t} THEN 'Mine (Threat Detected)' ELSE 'Rock (Benign Object)' END AS classification,
round(prob, 6) AS probability_mine, round(1 - prob, 6) AS probability_rock, {t} AS applied_threshold, {_confidence(t)} AS confidence_percent,
round(prob - {t}, 6) AS margin, {_level(t)} AS code FROM scored"""


def _decided(rows, tau):
    out = SC.decide(rows.select("id", "prob"), tau)
    return rounded(out.withColumn("code", F.col("threat.code")).drop("prob", "threat"))


@query("k2_signal_decisions", f"WITH {SCORED} {_decision(0.43)}")
def _(t):
    return _decided(t.scored_wide(), 0.43)


@query("f8_rethreshold", f"WITH {SCORED} {_decision(0.9)}")
def _(t):
    # another threshold over the stored probabilities; nothing is scored again
    return _decided(t.scored(), 0.9)


@query("f3_confidence", f"WITH {ZONES} SELECT model, id, {_confidence('0.5::DOUBLE')} AS confidence FROM scored")
def _(t):
    return rounded(t.zones().select("model", "id", S.confidence_percent("prob", 0.5).alias("confidence")))


@query("f4_threat_levels", f"""WITH {ZONES}, l AS (SELECT model, {_level('0.43')} AS code FROM scored)
SELECT model, code, CASE code WHEN 'DEFCON-1' THEN 'CRITICAL THREAT' WHEN 'DEFCON-2' THEN 'ELEVATED THREAT'
WHEN 'DEFCON-3' THEN 'MONITORED - LOW RISK' ELSE 'CLEAR - BENIGN OBJECT' END AS level, count(*) AS rows FROM l GROUP BY model, code""")
def _(t):
    lev = t.zones().select("model", S.threat_level("prob", K.SAFE_TAU).alias("t"))
    return lev.groupBy("model", F.col("t.code").alias("code"), F.col("t.level").alias("level")).agg(F.count(F.lit(1)).alias("rows"))


@query("f5_f7_complement_margin", f"WITH {SCORED} SELECT id, round(1 - prob, 6) AS rock, round(prob - 0.43, 6) AS margin FROM scored")
def _(t):
    return rounded(t.scored().select("id", S.complement("prob").alias("rock"), S.signed_margin("prob", K.SAFE_TAU).alias("margin")))


@query("f16_output_rounding", f"WITH {SCORED} SELECT id, round(prob, 2) AS p2, round(prob, 4) AS p4, round(prob, 5) AS p5 FROM scored")
def _(t):
    return t.scored().select("id", *[F.round("prob", d).alias(f"p{d}") for d in (2, 4, 5)])


@query("k5_threshold_source", f"""WITH {SCORED} SELECT id, coalesce(CASE WHEN id % 3 = 0 THEN 0.6 END, CASE WHEN id % 2 = 0 THEN 0.43 END, 0.5)::DOUBLE AS tau FROM scored""")
def _(t):
    explicit = F.when(F.col("id") % 3 == 0, F.lit(0.6))
    stored = F.when(F.col("id") % 2 == 0, F.lit(0.43))
    return t.scored().select("id", S.choose_tau(explicit, stored).alias("tau"))


def _streamed(t):
    rows = t.signals().select("id", "features")
    path = scratch_path(t.spark, "arrivals")
    short = F.when(F.col("id") % 9 == 0, F.slice("features", 1, 40)).otherwise(F.col("features"))
    rows.withColumn("features", short).repartition(4).write.parquet(path)
    source = ST.read_vector_stream(t.spark, path, "id bigint, features array<double>", files_per_trigger=2)
    return ST.run_available(source, ST.linear_scorer(t.fitted(), L.SLOPE), K.SAFE_TAU, scratch_path(t.spark, "stream"))


_STREAM = f"""WITH {FITTED}, mg AS (SELECT id, sum((x - (mm + mr)/2)*(mm - mr)) AS m FROM slong JOIN mu USING (band) WHERE id % 9 <> 0 GROUP BY id),
scored AS (SELECT id, 1/(1 + exp(-40*m)) AS prob FROM mg)"""


@query("k3_stream_scoring", f"{_STREAM} SELECT id, round(prob, 6) AS prob, prob >= 0.43 AS is_threat, {_level('0.43')} AS code FROM scored")
def _(t):
    out = t.spark.read.parquet(_streamed(t)[0])
    return rounded(out.select("id", "prob", "is_threat", F.col("threat.code").alias("code")))


@query("k3_stream_quarantine", f"WITH {SIGNALS} SELECT id, 'expected 60 features, got 40' AS reason FROM sig WHERE id % 9 = 0")
def _(t):
    return t.spark.read.parquet(_streamed(t)[1]).select("id", "reason")


@query("k3_stream_rows_read", f"""WITH {SIGNALS} SELECT count(*) AS rows_read, count(*) FILTER (WHERE id % 9 <> 0) AS scored,
count(*) FILTER (WHERE id % 9 = 0) AS quarantined, true AS more_batches FROM sig""")
def _(t):
    """Rows that the stream read by its progress metrics, and where they went: each file is read once."""
    scored, bad, read = _streamed(t)
    both = [t.spark.read.parquet(p).groupBy("batch").agg(F.count(F.lit(1)).alias("n")) for p in (scored, bad)]
    sums = [b.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("batches")) for b in both]
    return sums[0].join(sums[1].select(F.col("n").alias("bad"))).select(
        F.lit(read).cast("bigint").alias("rows_read"), F.col("n").alias("scored"), F.col("bad").alias("quarantined"),
        (F.col("batches") > 1).alias("more_batches"))


_PHI = f"""{SCORED}, bm AS (SELECT band, avg(x) AS m0 FROM slong WHERE split = 'train' GROUP BY band),
phi AS (SELECT id, band, x, (x - m0)*(mm - mr) AS phi FROM slong JOIN mu USING (band) JOIN bm USING (band) WHERE split = 'test')"""


def _phi(t):
    train, test = t.parts()
    return X.linear_shapley(test.select("id", "features"), t.fitted(), train)


@query("x3_linear_shapley", f"WITH {_PHI} SELECT id, band, round(phi, 8) AS phi FROM phi")
def _(t):
    return rounded(_phi(t).select("id", F.posexplode("phi").alias("p", "phi")).select("id", (F.col("p") + 1).alias("band"), "phi"), 8)


@query("a27_global_attribution", f"WITH {_PHI} SELECT band, round(avg(abs(phi)), 8) AS mean_abs_phi FROM phi GROUP BY band")
def _(t):
    return rounded(X.global_attribution(_phi(t)), 8)


@query("w3_top_bands", f"""WITH {_PHI}, g AS (SELECT band, avg(abs(phi)) AS v FROM phi GROUP BY band)
SELECT band, round(v, 8) AS mean_abs_phi, 'Freq_' || lpad(band::VARCHAR, 2, '0') AS feature FROM g ORDER BY v DESC, band LIMIT 15""")
def _(t):
    return rounded(X.top_bands(X.global_attribution(_phi(t)), "mean_abs_phi"), 8)


_DRIVERS = """r AS (SELECT id, CASE WHEN phi > 0 THEN 'mine' ELSE 'rock' END AS side, band, phi, x,
row_number() OVER (PARTITION BY id, phi > 0 ORDER BY abs(phi) DESC, band) AS rank FROM {phi} WHERE phi <> 0),
dr AS (SELECT id, side, rank, band, 'Freq_' || lpad(band::VARCHAR, 2, '0') AS feature, round(phi, 5) AS shap_value, round(x, 4) AS raw_value,
CASE WHEN phi > 0 THEN 'Increases Threat Likelihood' ELSE 'Decreases Threat Likelihood' END AS impact FROM r WHERE rank <= 6)"""


@query("w4_top_drivers", f"WITH {_PHI}, {_DRIVERS.format(phi='phi')} SELECT * FROM dr")
def _(t):
    return X.top_drivers(_phi(t))


@query("f12_differential_attribution", f"""WITH {FITTED}, mp AS (SELECT band, round(avg(x), 4) AS m0 FROM slong WHERE label = 'R' GROUP BY band),
phi AS (SELECT id, band, x, (x - m0)*0.1::DOUBLE AS phi FROM slong JOIN mp USING (band)), {_DRIVERS.format(phi='phi')} SELECT * FROM dr""")
def _(t):
    rock = P.reference_profiles(t.split()).where("label = 'R'")
    return X.top_drivers(X.differential_attribution(t.split().select("id", "features"), rock))


@query("f13_impact_text", f"""WITH {_PHI} SELECT CASE WHEN phi > 0 THEN 'Increases Threat Likelihood' ELSE 'Decreases Threat Likelihood' END AS impact,
count(*) AS n FROM phi WHERE phi <> 0 GROUP BY 1""")
def _(t):
    long = _phi(t).select(F.explode("phi").alias("phi")).where("phi <> 0")
    return long.groupBy(S.impact_text("phi").alias("impact")).agg(F.count(F.lit(1)).alias("n"))


@query("w5_top_absolute", f"""WITH {_PHI}, r AS (SELECT id, band, phi, row_number() OVER (PARTITION BY id ORDER BY abs(phi) DESC, band) AS rank FROM phi)
SELECT id, rank, band, round(phi, 8) AS phi FROM r WHERE rank <= 8""")
def _(t):
    return rounded(X.top_absolute(_phi(t)), 8)


@query("w12_normalised_drivers", f"""WITH {_PHI}, {_DRIVERS.format(phi='phi')}
SELECT id, side, rank, band, round(abs(shap_value)/greatest(max(abs(shap_value)) OVER (PARTITION BY id), 0.001)*100, 6) AS bar_pct FROM dr""")
def _(t):
    return rounded(X.normalised_drivers(X.top_drivers(_phi(t))).select("id", "side", "rank", "band", "bar_pct"))


_PERM = f"""WITH {SCORED},
po AS (SELECT id, y, row_number() OVER (ORDER BY h, id) - 1 AS pos, count(*) OVER () AS n FROM sp WHERE split = 'test'),
rp AS (SELECT po.*, r, CASE WHEN n > 1 THEN (pos + 1 + (r - 1) % (n - 1)) % n ELSE 0 END AS dpos FROM po, (SELECT unnest(range(1, 16)) AS r)),
dn AS (SELECT rp.id, rp.y, rp.r, d.id AS donor FROM rp JOIN po d ON d.pos = rp.dpos),
ms AS (SELECT dn.y, dn.r, a.band, sc.m + (b.x - a.x)*(mm - mr) AS m FROM dn JOIN scored sc ON sc.id = dn.id JOIN slong a ON a.id = dn.id
  JOIN slong b ON b.id = dn.donor AND b.band = a.band JOIN mu ON mu.band = a.band),
fr AS (SELECT band, r, 2*sum(CASE WHEN y = 1 AND m >= 0 THEN 1 ELSE 0 END)/nullif(sum(y) + sum(CASE WHEN m >= 0 THEN 1 ELSE 0 END), 0)::DOUBLE AS f1 FROM ms GROUP BY band, r),
f0 AS (SELECT 2*sum(CASE WHEN y = 1 AND m >= 0 THEN 1 ELSE 0 END)/nullif(sum(y) + sum(CASE WHEN m >= 0 THEN 1 ELSE 0 END), 0)::DOUBLE AS f1 FROM scored)
SELECT band, round((SELECT f1 FROM f0) - avg(f1), 6) AS mean_importance, round(stddev_pop(f1), 6) AS std_importance FROM fr GROUP BY band"""


@query("x2_permutation_importance", _PERM)
def _(t):
    train, test = t.parts()
    return rounded(X.linear_permutation_importance(test, L.fit_mean_difference(train)))
