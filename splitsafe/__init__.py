"""splitsafe — a Spark-native audit of labelled tables for train/test leakage.

Typical use::

    from splitsafe import Roles, read_table, scan_with_score, stratified_split, experiment_2
    df = read_table(spark, "/data/applications.csv")               # or spark.read.parquet(...)
    report, summary = scan_with_score(df, Roles("label", id="customer_id"))
"""

from .roles import Roles  # noqa: F401
from .sources.csv import read_table, infer_types, write_report, preview  # noqa: F401
from .operators.detector import scan, score, scan_with_score, severity_chart  # noqa: F401
from .operators.profile import (long_profile, null_profile, class_counts, distinct_counts,  # noqa: F401
                                group_sizes, category_rates, target_correlations)
from .operators.eda import sanity_check, eda, missing_tiers, top_missing, correlation_hunt  # noqa: F401
from .operators.clean import clean  # noqa: F401
from .operators.duplicates import duplicate_count, drop_duplicates  # noqa: F401
from .operators.split import (stratified_split, random_split, hash_split, group_kfold,  # noqa: F401
                              temporal_split, sample_rows, split_stats, group_overlap, compare_splits,
                              with_row_key)
from .operators.rank import select_kth, medians  # noqa: F401
from .operators.metrics import roc_auc, roc_points  # noqa: F401
from .operators.encode import target_encode, target_encode_oof  # noqa: F401
from .operators.fit import fit_stats, apply_fit, fit_drift  # noqa: F401
from .operators.inject import inject_duplicates, inject_group_overlap, inject_target_feature  # noqa: F401
from .operators.model import train_and_evaluate  # noqa: F401
from .operators.experiments import (experiment_1, experiment_2, experiment_3, experiment_4,  # noqa: F401
                                    experiment_5)
from .operators.chartdata import histogram, experiment_table, worst_experiment  # noqa: F401

__version__ = "0.1.0"
