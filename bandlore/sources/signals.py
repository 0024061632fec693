"""Readers for signal tables, and the two shapes the operators use.

wide: (id, features array<double>, label)     models, scaling, scoring
long: (id, label, band, x)                    statistics per band
"""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandlore import constants as K
from bandlore.functions import scalar as S

CORRUPT = "_corrupt_record"


def signal_schema(named=True, label=True):
    """Explicit schema: 60 doubles and an optional label, by name or by position."""
    names = K.FEATURE_COLUMNS if named else [f"_c{i}" for i in range(K.N_BANDS)]
    fields = [T.StructField(n, T.DoubleType()) for n in names]
    if label:
        fields.append(T.StructField(K.LABEL_COLUMN if named else f"_c{K.N_BANDS}", T.StringType()))
    return T.StructType(fields)


def _csv(reader, path):
    """A missing path is an error at once."""
    try:
        return reader.csv(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            raise FileNotFoundError(f"signal table not found at {path!r}") from err
        raise


def read_signal_csv(spark, path, named=True, header=False, label=True):
    """CSV scan with a fixed schema, nothing inferred."""
    reader = spark.read.schema(signal_schema(named, label)).option("header", header)
    return _csv(reader.option("enforceSchema", True), path)


#: A value of a CSV line behind its comma: quoted, with doubled quotes inside, or anything up to the next comma.
_VALUE = r',("[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+)'


def _unquoted(value):
    inner = F.regexp_replace(F.substring(value, F.lit(2), F.length(value) - 2), '""', '"')
    return F.when(value.rlike('^"[^"]*+(?:""[^"]*+)*+"$'), inner).otherwise(value)


def _lines(spark, path, header):
    """Every line of CSV files as its values, all as text: a line of any width stays visible. Quoted values lose their
    quotes; a quote that is not closed stays, and its value is no number."""
    reader = spark.read.schema("raw string").option("header", header).option("sep", "\u0001").option("quote", "")
    values = F.regexp_extract_all(F.concat(F.lit(","), F.col("raw")), F.lit(_VALUE), F.lit(1))
    quoted = F.transform(values, lambda v: _unquoted(F.trim(v)))
    values = F.when(F.contains("raw", F.lit('"')), quoted).otherwise(F.split("raw", ","))
    return _csv(reader.option("enforceSchema", True), path).select("raw", values.alias("values"))


def _place(values, i):
    return F.nullif(F.trim(F.get(values, F.lit(i))), F.lit(""))


def read_checked_csv(spark, path, header=False):
    """CSV scan for input that may be bad: (features, label, raw line if malformed, reason).

    A line of another width than features and label goes to quarantine under the width found.
    """
    lines = _lines(spark, path, header)
    width = F.size("values")
    rows = lines.select(
        F.transform(F.slice("values", 1, K.N_BANDS), lambda v: F.trim(v)).alias("features"),
        F.when(width == K.N_BANDS + 1, _place("values", K.N_BANDS)).alias("label"),
        F.when(width != K.N_BANDS + 1, F.col("raw")).alias("raw"), width.alias("_found"))
    wrong = F.concat(F.lit(f"expected {K.N_BANDS + 1} columns, got "), F.col("_found").cast("string"))
    checked = validate(rows)
    return checked.withColumn("reason", F.when(F.col("_found") != K.N_BANDS + 1, wrong).otherwise(F.col("reason"))).drop("_found")


def read_batch_csv(spark, path, header=False):
    """Unlabelled batch scan: (features, raw line if malformed, reason).

    A 61st value (the label) is dropped. A line of any other width than 60 or 61 is rejected, wherever in the file it
    stands, as is one with a value that is no number.
    """
    lines = _lines(spark, path, header)
    width = F.size("values")
    fits = width.isin(K.N_BANDS, K.N_BANDS + 1)
    rows = lines.select(
        F.transform(F.slice("values", 1, K.N_BANDS), lambda v: F.trim(v)).alias("features"),
        F.when(~fits, F.col("raw")).alias("raw"), fits.alias("_fits"), width.alias("_found"))
    wrong = F.concat(F.lit(f"expected {K.N_BANDS} features, got "), F.col("_found").cast("string"))
    return validate(rows).withColumn("reason", F.when(~F.col("_fits"), wrong).otherwise(F.col("reason"))).drop("_fits", "_found")


def read_checked_json(spark, path, width=K.N_BANDS):
    """JSON documents {"signals": [[...], ...]}, one row per inner array: (position, features, raw, reason).

    Values are read as text, so a word among them is seen; a document that is no JSON or has no signals is one row with
    its text in ``raw``.
    """
    schema = f"signals array<array<string>>, {CORRUPT} string"
    docs = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    rows = docs.select(CORRUPT, F.posexplode_outer("signals").alias("position", "features"))
    checked = validate(rows.select("position", "features", F.col(CORRUPT).alias("raw")), width)
    return checked.withColumn("reason", F.when(F.col("raw").isNotNull(), F.lit("malformed document")).otherwise(F.col("reason")))


def read_signal_json(spark, path):
    """JSON documents {"signals": [[...], ...]} to one row per inner array."""
    schema = "signals array<array<double>>"
    docs = spark.read.schema(schema).json(path)
    return docs.select(F.posexplode("signals").alias("position", "features"))


def read_json_report(spark, path, schema=None):
    """A report document that may span lines."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def to_features(df, feature_columns=None, keep=()):
    """Named scalar columns to one feature array."""
    names = feature_columns or K.FEATURE_COLUMNS
    return df.select(*keep, F.array(*[F.col(c) for c in names]).alias("features"))


def features_and_target(df, label=K.LABEL_COLUMN, keep=()):
    """Feature array and target side by side; KeyError if the target is absent."""
    if label not in df.columns:
        raise KeyError(f"target column {label!r} not found")
    names = [c for c in df.columns if c != label and c not in keep]
    return df.select(*keep, F.array(*[F.col(c) for c in names]).alias("features"), F.col(label))


def to_columns(df, keep=("id", "label"), width=K.N_BANDS):
    """Feature array back to freq_1..freq_n scalar columns."""
    present = [c for c in keep if c in df.columns]
    return df.select(*present, *[F.col("features")[i].alias(f"freq_{i + 1}") for i in range(width)])


def bands(df, keep=("id", "label"), width=None):
    """Long form: one row per (signal, band), band counted from 1.

    With ``width`` (a number or a column) every signal has that many rows; places that its array lacks, or all of a null array, hold null.
    """
    present = [c for c in keep if c in df.columns]
    values = F.col("features")
    if width is not None:
        width = F.lit(width) if isinstance(width, int) else width
        places = F.when(width > 0, F.sequence(F.lit(0), width - 1))
        values = F.transform(places, lambda i: F.get("features", i))
    return df.select(*present, F.posexplode(values).alias("pos", "x")).select(
        *present, (F.col("pos") + 1).alias("band"), "x"
    )


def present_values(long):
    """Long rows that hold a value."""
    return long.where(~S.missing("x"))


def embedding_signals(spark, path):
    """Signal view of a vector table: 60 features, a label from a fixed linear rule."""
    e = F.col("embedding").cast("array<double>")
    rule = e[10] + e[11] + 0.5 * e[35] + 0.5 * e[60]
    return spark.read.parquet(path).select(
        F.col("vec_id").alias("id"),
        F.slice(e, 1, K.N_BANDS).alias("features"),
        F.when(rule > 0, F.lit("M")).otherwise(F.lit("R")).alias("label"),
    )


def numeric_signals(df, columns, label, key=()):
    """Any table's numeric columns as a feature array with a class column."""
    return df.select(
        *key, F.array(*[F.col(c).cast("double") for c in columns]).alias("features"),
        F.col(label).alias("label"),
    )


def validate(df, width=K.N_BANDS):
    """Add ``reason``: null for a good row, else why it goes to quarantine.

    ``features`` may hold strings or doubles; it comes back as doubles.
    """
    raw = F.col("features")
    cast = F.transform(raw, lambda v: v.try_cast("double"))
    reason = (
        F.when(raw.isNull(), F.lit("no features"))
        .when(F.size(raw) != width,
              F.concat(F.lit(f"expected {width} features, got "), F.size(raw).cast("string")))
        .when(F.exists(cast, lambda v: v.isNull() | F.isnan(v)), F.lit("non-numeric feature"))
    )
    return df.withColumn("reason", reason).withColumn("features", cast)


def split_quarantine(df):
    """(good rows, rejected rows with their reason) of a validated frame."""
    return df.where(F.col("reason").isNull()).drop("reason"), df.where(F.col("reason").isNotNull())
