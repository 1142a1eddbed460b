"""Distributed model fits, scoring, search and storage."""

from flowlab.models.base import FlowModel, predict  # noqa: F401
from flowlab.models.classifiers import (  # noqa: F401
    fit_calibrated_svm,
    fit_gaussian_nb,
    fit_gbt,
    fit_leafwise_gbt,
    fit_logistic,
    fit_random_forest,
    gaussian_nb_parameters,
)
from flowlab.models.isolation_forest import (  # noqa: F401
    fit_isolation_forest,
    load_forest,
    save_forest,
    score_isolation_forest,
)
from flowlab.models.perceptron import fit_perceptron as fit_mlp  # noqa: F401
from flowlab.models.search import feature_importance, train_grid, tune, tune_by_halving  # noqa: F401
from flowlab.models.store import load_model, log_run, model_info, read_runs, save_model  # noqa: F401
