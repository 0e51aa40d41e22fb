"""Preparing, modelling and evaluating coded survey-style tables on Spark."""

from tallyframe.operators.cleaning import (
    Rule,
    apply_rules,
    below,
    drop,
    keep,
    make_label,
    recode,
    rule_audit,
)
from tallyframe.operators.codebook import (
    code_counts,
    codebook_join,
    feature_details,
    feature_rows,
    label_codes,
    unmatched_codes,
)
from tallyframe.operators.correlation import (
    corr_matrix,
    independent_features,
    prune_redundant,
    select_by_corr,
    target_corr,
    top_corr,
    wide_matrix,
)
from tallyframe.operators.evaluation import (
    auc_roc,
    classification_metrics,
    compare_models,
    confusion_matrix,
    f_measure_by_threshold,
    metric_rows,
    metrics_table,
    pr_curve,
    precision_by_threshold,
    recall_by_threshold,
    roc_curve,
    threshold_counts,
    threshold_curves,
    weighted_f1,
)
from tallyframe.operators.features import (
    assemble,
    fit_features,
    linear_features,
    one_hot,
    one_hot_observed,
    tree_features,
    vector_columns,
)
from tallyframe.operators.models import (
    best_point,
    classifier,
    fit_classifier,
    linear_score,
    predict,
    tune,
)
from tallyframe.operators.logistic_search import fold_features, search_logistic
from tallyframe.operators.search import search_ensemble
from tallyframe.operators.profiling import (
    class_balance,
    drop_null_rows,
    group_count,
    histogram,
    missing_profile,
    prune_columns,
    summary_stats,
    summary_table,
    summary_texts,
    transpose,
    well_filled_columns,
)
from tallyframe.operators.sampling import (
    balance_fractions,
    fold_column,
    split_column,
    stratified_sample,
    stratified_sample_native,
)
from tallyframe.plans import (
    FeatureSelection,
    Modelling,
    join_models,
    prepare_training_set,
    run_models,
    select_features,
)
from tallyframe.sources import (
    preview,
    read_folds,
    read_table,
    schema_rows,
    table_sizes,
    write_folds,
    write_table,
)

__all__ = [name for name in dir() if not name.startswith("_")]
