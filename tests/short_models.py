"""Boosted models of few rounds, for tests that only ask whether a query over them holds together."""

from __future__ import annotations

from dataclasses import replace

import pytest

from lendmill.operators import boosting

ROUNDS = 6


@pytest.fixture(scope="module")
def short_models():
    whole = boosting.fit_all

    def few(data, wanted, halving=None):
        if halving is not None:
            halving = replace(halving, first=2, most=ROUNDS)
        return whole(data, [(replace(p, rounds=min(p.rounds, ROUNDS)), held) for p, held in wanted], halving)

    boosting.fit_all = few
    yield
    boosting.fit_all = whole
