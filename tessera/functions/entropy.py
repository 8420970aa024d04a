"""Information-measure terms as SQL expressions over one contingency cell.

A cell row carries its count ``c`` and the marginal counts of its feature
group: ``n`` (all rows), ``c_v``, ``c_z``, ``c_y``, ``c_vz``, ``c_vy``, ``c_zy``.
Summing a term over all cells of a feature gives the measure (log base 2):

* relevance   I(X;Y)   = sum c/n log2(c_vy n / (c_v c_y))
* redundancy  I(X;Z)   = sum c/n log2(c_vz n / (c_v c_z))
* conditional I(X;Z|Y) = sum c/n log2(c c_y / (c_vy c_zy))

(Summing over full cells with marginal logs gives exactly the marginal sums.)
"""

# (marginal name, partition columns beyond the feature keys, order columns).  Ordering the whole
# frame by the rest of a chain's columns changes no sum, but one sort then serves the whole
# chain: three sorts for seven sums.
MARGINALS = (("c_vz", "v, z", ""), ("c_v", "v", "z"), ("n", "", "v, z"),
             ("c_vy", "y, v", ""), ("c_y", "y", "v"),
             ("c_zy", "z, y", ""), ("c_z", "z", "y"))

RELEVANCE_TERM = "c / n * log2(c_vy * n / (c_v * c_y))"
REDUNDANCY_TERM = "c / n * log2(c_vz * n / (c_v * c_z))"
CONDITIONAL_TERM = "c / n * log2(c * c_y / (c_vy * c_zy))"


def marginal_windows(keys: tuple[str, ...]) -> list[tuple[str, str]]:
    """(name, window sum of ``c``) of every marginal within the feature keys, to be added in this order."""
    out = []
    for name, cols, order in MARGINALS:
        over = "PARTITION BY " + ", ".join([*keys, *([cols] if cols else [])])
        if order:
            over += f" ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
        out.append((name, f"sum(c) OVER ({over})"))
    return out
