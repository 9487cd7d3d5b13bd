"""The registered queries and the command line run the whole searches."""

import inspect

import pytest

from attrix.__main__ import main
from attrix.functions import constants as K
from attrix.models import train as T
from attrix.plans import q_models as Q


def test_searches_are_whole_by_default():
    whole = {name: {n: p.default for n, p in inspect.signature(getattr(T, name)).parameters.items()} for name in ("search_lr", "search_rf", "search_gbt")}
    assert whole["search_lr"]["c_grid"] == K.LR_C_GRID and len(K.LR_C_GRID) == 6
    assert whole["search_rf"]["n_iter"] == 20 and whole["search_rf"]["space"] == K.RF_SPACE
    assert whole["search_gbt"]["n_iter"] == 50 and whole["search_gbt"]["space"] == K.GBT_SPACE
    assert all(w["folds"] == K.CV_FOLDS == 5 for w in whole.values())
    assert set(K.GBT_SPACE) == {"n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "min_child_weight", "gamma", "reg_alpha", "reg_lambda"}


def test_registered_queries_ask_for_the_defaults(spark, monkeypatch):
    asked = {}

    class Rows:
        def where(self, _):
            return self

    def search(name):
        return lambda *args, **given: asked.update({name: given})

    for name in ("search_lr", "search_rf", "search_gbt"):
        monkeypatch.setattr(T, name, search(name))
    monkeypatch.setattr(T, "folded", lambda rows, roles, **given: asked.update(folded=given) or rows)
    monkeypatch.setattr(Q, "split_rows", lambda *a: Rows())
    monkeypatch.setattr(Q, "model_roles", lambda df: None)
    monkeypatch.setattr(Q, "_once", lambda _spark, _key, make: make())
    for fit in (Q.trained_lr, Q.trained_rf, Q.trained_gbt):
        fit(spark, "nowhere")
    assert asked == {"folded": {}, "search_lr": {}, "search_rf": {}, "search_gbt": {}}


def test_command_line_has_no_small_search():
    with pytest.raises(SystemExit):
        main(["run", "--sf-dir", "nowhere", "--quick"])
