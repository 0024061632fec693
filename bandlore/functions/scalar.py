"""Column expressions: labels, thresholds, threat levels, parsing, formatting."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from bandlore import constants as K


def col(c):
    return F.col(c) if isinstance(c, str) else c


def tau_column(tau):
    """A fixed threshold, or a column that holds one."""
    return tau if isinstance(tau, Column) else F.lit(float(tau))


def missing(c):
    """Null and NaN count alike as missing."""
    c = col(c)
    return c.isNull() | F.isnan(c)


def ratio(numerator, denominator):
    """Division that gives 0 where the denominator is 0."""
    top, bottom = col(numerator).cast("double"), col(denominator).cast("double")
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def _lookup(mapping):
    return F.create_map(*[F.lit(v) for pair in mapping.items() for v in pair])


def encode_label(label, mapping=None, on_unknown="error"):
    """Label to integer. Unknown labels fail the job, or become null for quarantine."""
    mapping = mapping or K.LABEL_MAPPING
    label = col(label)
    code = F.try_element_at(_lookup(mapping), label)
    if on_unknown == "null":
        return code
    if on_unknown != "error":
        raise ValueError(f"on_unknown must be 'error' or 'null', got {on_unknown!r}")
    message = F.concat(
        F.lit("unexpected class label: "), F.coalesce(label, F.lit("<null>")),
        F.lit(f"; expected one of {sorted(mapping)}"),
    )
    return F.when(code.isNull(), F.raise_error(message).cast("int")).otherwise(code)


def decode_label(y, mapping=None):
    mapping = mapping or K.LABEL_MAPPING
    return F.try_element_at(_lookup({v: k for k, v in mapping.items()}), col(y).cast("int"))


def describe_class(y):
    return F.try_element_at(_lookup(K.CLASS_DESCRIPTIONS), col(y).cast("int"))


def class_category(label):
    return F.coalesce(F.try_element_at(_lookup(K.CLASS_CATEGORIES), col(label)), F.lit("Unknown"))


def class_meaning(label):
    return F.coalesce(F.try_element_at(_lookup(K.CLASS_MEANINGS), col(label)), F.lit("Unknown"))


def check_tau(tau):
    """A decision threshold lies strictly between 0 and 1."""
    value = float(tau)
    if not 0.0 < value < 1.0:
        raise ValueError(f"threshold must be between 0 and 1, got {tau}")
    return value


def is_valid_tau(c):
    value = col(c)
    return F.coalesce((value > 0.0) & (value < 1.0), F.lit(False))


def choose_tau(explicit, operating_point=None, default=K.DEFAULT_TAU):
    """Explicit threshold, else the stored operating point, else the default."""
    choices = [col(explicit)]
    if operating_point is not None:
        choices.append(col(operating_point))
    return F.coalesce(*choices, F.lit(default))


def is_threat(prob, tau):
    return col(prob) >= tau_column(tau)


def classification(prob, tau):
    return F.when(is_threat(prob, tau), F.lit(K.THREAT_CLASS)).otherwise(F.lit(K.BENIGN_CLASS))


def batch_class(prob, tau):
    return F.when(is_threat(prob, tau), F.lit("Mine")).otherwise(F.lit("Rock"))


def complement(prob):
    return F.lit(1.0) - col(prob)


def confidence_percent(prob, tau):
    """Distance from the threshold as a share of the room on that side, in percent."""
    p, t = col(prob), tau_column(tau)
    above = F.when(t < 1.0, F.try_divide(p - t, 1.0 - t) * 100.0).otherwise(F.lit(100.0))
    below = F.when(t > 0.0, F.try_divide(t - p, t) * 100.0).otherwise(F.lit(100.0))
    return F.when(p >= t, above).otherwise(below)


def threat_level(prob, tau):
    """Struct of level, code, badge class and message; the order of the tests matters."""
    p = col(prob)

    def entry(i):
        code, level, badge, message = K.THREAT_LEVELS[i]
        return F.struct(
            F.lit(level).alias("level"), F.lit(code).alias("code"),
            F.lit(badge).alias("badge_class"), F.lit(message).alias("message"),
        )

    return (
        F.when(p >= K.CRITICAL_AT, entry(0))
        .when(p >= tau_column(tau), entry(1))
        .when(p >= K.MONITORED_AT, entry(2))
        .otherwise(entry(3))
    )


def signed_margin(prob, tau):
    return col(prob) - tau_column(tau)


def outcome(y, pred):
    hit = col(y) == col(pred)
    return (
        F.when(hit & (col(y) == 1), "TP")
        .when(hit, "TN")
        .when(col(pred) == 1, "FP")
        .otherwise("FN")
    )


def error_text(kind):
    return F.when(col(kind) == "FP", F.lit(K.FALSE_POSITIVE_TEXT)).when(
        col(kind) == "FN", F.lit(K.FALSE_NEGATIVE_TEXT)
    )


def error_margin(kind, prob, tau):
    """Distance by which an error row lies on the wrong side of the threshold."""
    margin = signed_margin(prob, tau)
    return F.when(col(kind) == "FP", margin).when(col(kind) == "FN", -margin)


def weighted_cost(fn, fp, fn_cost=K.FN_COST, fp_cost=K.FP_COST):
    return col(fn) * F.lit(float(fn_cost)) + col(fp) * F.lit(float(fp_cost))


def band_name(band):
    return F.format_string("Freq_%02d", col(band).cast("int"))


def band_zone(band):
    b = col(band)
    expr = None
    for name, first, last in K.ZONES:
        inside = b.between(first, last)
        expr = F.when(inside, name) if expr is None else expr.when(inside, name)
    return expr


def impact_text(phi):
    return F.when(col(phi) > 0, F.lit(K.RAISES_THREAT)).when(
        col(phi) < 0, F.lit(K.LOWERS_THREAT)
    )


def rescale(value, low, high):
    """Map a margin to 0..1 by the observed range."""
    return (col(value) - col(low)) / (col(high) - col(low) + F.lit(1e-9))


def _numbers(text, pattern):
    tokens = F.split(F.trim(col(text)), pattern)
    return F.transform(tokens, lambda t: F.trim(t).try_cast("double"))


def parse_signal(text, width=K.N_BANDS):
    """Numbers split on blanks or commas; other tokens are dropped; null unless ``width`` remain."""
    values = F.filter(_numbers(text, r"[\s,]+"), lambda v: v.isNotNull() & ~F.isnan(v))
    return F.when(F.size(values) == width, values)


def parse_signal_strict(text, width=K.N_BANDS):
    """Comma separated numbers; one bad token rejects the row."""
    values = _numbers(text, ",")
    bad = F.exists(values, lambda v: v.isNull())
    return F.when((F.size(values) == width) & ~bad, values)


def json_number(text, path, default):
    """Number at a JSON path, or the default where it is absent."""
    return F.coalesce(F.get_json_object(col(text), path).try_cast("double"), F.lit(float(default)))
