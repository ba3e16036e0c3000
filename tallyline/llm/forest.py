"""Union of rows by vectorised label hooking."""

from __future__ import annotations

import numpy as np


def absorb(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of rows ``a[k]`` and ``b[k]``, in place.

    Every label is a row that labels itself, and stays so; a group is named by its
    smallest row.
    """
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            deeper = labels[labels]
            if np.array_equal(deeper, labels):
                break
            labels[:] = deeper
