"""Profiling job: every audit and plotted distribution of a signal table, as lazy DataFrames."""

from bandlore.operators import profile as P


def run_profiling(df):
    """Name to DataFrame. Nothing runs until a frame is used, except sketches that size the work."""
    return {
        "summary": P.dataset_summary(df),
        "missing": P.missing_audit(df),
        "duplicates": P.duplicate_audit(df),
        "duplicate_rows": P.duplicate_rows(df),
        "class_distribution": P.class_distribution(df),
        "describe": P.describe_bands(df),
        "variance_extremes": P.variance_extremes(df),
        "class_stats": P.class_stats(df),
        "top_contrast": P.top_contrast(df),
        "mean_signature": P.mean_signature(df),
        "reference_profiles": P.reference_profiles(df),
        "histogram": P.class_histogram(df),
        "density": P.class_density(df),
        "boxes": P.box_stats(df),
        "box_outliers": P.box_outliers(df),
        "correlation": P.correlation_matrix(df),
    }
