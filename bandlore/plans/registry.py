"""Registry of runnable queries over the test tables, each beside its SQL counterpart."""

from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.functions import scalar as S
from bandlore.operators import linear as L
from bandlore.operators.sampling import split_rows, stratified_folds
from bandlore.session import scratch_path
from bandlore.sources import signals as G
from bandlore.sources.sinks import write_splits

QUERIES = {}
ORACLE = {}

LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# The signal view, the split and the closed-form scorer in SQL, shared by the queries below.
SIGNALS = """sig AS (SELECT vec_id AS id, CAST(embedding[1:60] AS DOUBLE[]) AS features,
  CASE WHEN embedding[11]::DOUBLE + embedding[12]::DOUBLE + 0.5::DOUBLE*embedding[36]::DOUBLE
    + 0.5::DOUBLE*embedding[61]::DOUBLE > 0 THEN 'M' ELSE 'R' END AS label,
  md5('42:' || vec_id::VARCHAR) AS h FROM embeddings)"""
LONG = SIGNALS + """,
long AS (SELECT id, label, generate_subscripts(features, 1) AS band, unnest(features) AS x FROM sig)"""
SPLIT = SIGNALS + """,
cls AS (SELECT label, count(*) AS c, sum(count(*)) OVER () AS n FROM sig GROUP BY label),
sh AS (SELECT label, n - ceil(0.2::DOUBLE*n) AS t, (n - ceil(0.2::DOUBLE*n))*c::DOUBLE/n AS share FROM cls),
qt AS (SELECT label, floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, label)
  <= t - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS q FROM sh),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, id) AS rn FROM sig),
sp AS (SELECT id, features, label, h, CASE label WHEN 'M' THEN 1 ELSE 0 END AS y,
  CASE WHEN rn <= q THEN 'train' ELSE 'test' END AS split FROM rk JOIN qt USING (label))"""
FITTED = SPLIT + """,
slong AS (SELECT id, y, label, split, generate_subscripts(features, 1) AS band, unnest(features) AS x FROM sp),
mu AS (SELECT band, avg(x) FILTER (WHERE label = 'M') AS mm, avg(x) FILTER (WHERE label = 'R') AS mr
  FROM slong WHERE split = 'train' GROUP BY band)"""
SCORED = FITTED + """,
mg AS (SELECT id, y, sum((x - (mm + mr)/2)*(mm - mr)) AS m FROM slong JOIN mu USING (band)
  WHERE split = 'test' GROUP BY id, y),
scored AS (SELECT 'mean_difference' AS model, id, y, m, 1/(1 + exp(-40*m)) AS prob,
  CASE WHEN 1/(1 + exp(-40*m)) >= 0.5 THEN 1 ELSE 0 END AS pred_label FROM mg)"""
ZONES = FITTED + """,
zn(model, a, b) AS (VALUES ('all', 1, 60), ('low', 1, 15), ('mid', 16, 35), ('high', 36, 60)),
mg AS (SELECT model, id, y, sum((x - (mm + mr)/2)*(mm - mr)) AS m FROM slong JOIN mu USING (band)
  JOIN zn ON band BETWEEN a AND b WHERE split = 'test' GROUP BY model, id, y),
scored AS (SELECT model, id, y, 1/(1 + exp(-40*m)) AS prob,
  CASE WHEN 1/(1 + exp(-40*m)) >= 0.5 THEN 1 ELSE 0 END AS pred_label FROM mg)"""
METRICS = """(tp + tn)/(tp + fp + tn + fn)::DOUBLE AS accuracy,
  coalesce(tp/nullif(tp + fp, 0)::DOUBLE, 0) AS "precision", coalesce(tp/nullif(tp + fn, 0)::DOUBLE, 0) AS recall,
  coalesce(2*tp/nullif(2*tp + fp + fn, 0)::DOUBLE, 0) AS f1"""
LINES = """long AS (SELECT l_returnflag AS label, unnest([1, 2, 3, 4]) AS band,
  unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS x FROM lineitem)"""

_kept = {}
_stages = {}


def forget():
    """Drop what queries of this session share: kept score relations and written stages."""
    for frame in _kept.values():
        frame.unpersist()
    _kept.clear()
    _stages.clear()


class Tables:
    """The test tables as signal frames. Score relations are kept for the queries that share them."""

    def __init__(self, spark, sf_dir):
        self.spark, self.dir = spark, sf_dir

    def table(self, name):
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def signals(self):
        return G.embedding_signals(self.spark, f"{self.dir}/embeddings.parquet")

    def lines(self):
        return G.numeric_signals(self.table("lineitem"), LINE_COLUMNS, "l_returnflag")

    def _written(self, name, build):
        """A stage result as a table in the shared folder, written once per session."""
        key = (self.spark.sparkContext.applicationId, self.dir, name)
        if key not in _stages:
            path = scratch_path(self.spark, name)
            frame = build()
            write_splits(frame, path)
            _stages[key] = (path, frame.schema)
        path, schema = _stages[key]
        return self.spark.read.schema(schema).parquet(path)

    def split(self):
        """The preprocessed table, partitioned by split: reading one split prunes the other."""
        return self._written(
            "splits", lambda: split_rows(self.signals()).withColumn("y", S.encode_label("label")))

    def folded(self):
        return self._written("folds", lambda: stratified_folds(self.parts()[0]))

    def parts(self):
        rows = self.split()
        return rows.where("split = 'train'"), rows.where("split = 'test'")

    def fitted(self):
        return L.fit_mean_difference(self.parts()[0])

    def scored_wide(self):
        train, test = self.parts()
        return L.score_mean_difference(test, L.fit_mean_difference(train))

    def _keep(self, name, build):
        key = (self.spark.sparkContext.applicationId, self.dir, name)
        if key not in _kept:
            _kept[key] = build().persist()
        return _kept[key]

    def scored(self):
        return self._keep("scored", lambda: self.scored_wide().select("model", "id", "y", "prob", "pred_label"))

    def zones(self):
        def build():
            train, test = self.parts()
            return L.score_zones(test.select("id", "y", "features"), L.fit_mean_difference(train)).select(
                "model", "id", "y", "prob", "pred_label"
            )

        return self._keep("zones", build)


def query(name, sql=None):
    def register(build):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql:
            ORACLE[name] = sql
        return build

    return register


def rounded(df, digits=6):
    """Fractional columns rounded, so that sums in another order compare equal."""
    return df.select(*[
        F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes
    ])


__all__ = ["FITTED", "K", "LINES", "LONG", "METRICS", "ORACLE", "QUERIES", "SCORED", "SIGNALS", "SPLIT",
           "Tables", "ZONES", "query", "rounded"]
