"""Customers made up for tests."""

from __future__ import annotations

import numpy as np

SCHEMA = (
    "CustomerID long, Churn int, Gender string, PreferredLoginDevice string, PreferredPaymentMode string, "
    "PreferedOrderCat string, Tenure double, SatisfactionScore int, Complain int, CashbackAmount double"
)


def customer_rows(n: int, seed: int = 17):
    """(rows, schema): customers who leave with a chance that grows with complaints and falls with tenure and contentment.

    One tenure in nine is unknown; a quarter leave in expectation, with little noise.
    """
    rng = np.random.default_rng(seed)
    rows = []
    for key in range(n):
        score, complaint, tenure = int(rng.integers(1, 6)), int(rng.random() < 0.3), float(np.round(rng.gamma(2.0, 7.0), 1))
        pull = 4.0 * complaint + 1.8 * (2.4 - score) - 0.08 * tenure
        rows.append((
            1001 + key, int(pull + rng.logistic(scale=0.25) > 0), str(rng.choice(["Female", "Male"])),
            str(rng.choice(["App", "Phone", "Web"], p=[0.5, 0.3, 0.2])), str(rng.choice(["Card", "Transfer", "Wallet"])),
            str(rng.choice(["Books", "Garden", "Grocery", "Toys"])), None if rng.random() < 1 / 9 else tenure,
            score, complaint, float(np.round(rng.normal(150, 20), 2)),
        ))
    return rows, SCHEMA
