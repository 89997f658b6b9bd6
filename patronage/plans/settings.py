"""Parameters that a query and its SQL counterpart share."""

import math

from ..operators.loyalty import HIDDEN, OBSERVABLE, HiddenMarkov

SITE = 1
LAST_SITE = 2
START = "1996-01-01"
END = "2000-01-01"
VISIT_START = "2024-01-05"
VISIT_END = "2024-01-25"

# centres for the parts of the geo operators that need no fit: two belts of five
CENTERS = [(lat, lon) for lat in (-45.0, 45.0) for lon in (-144.0, -72.0, 0.0, 72.0, 144.0)]
WIDTH, HEIGHT = 72, 36
# an image on which transforms are the cheaper way
FINE_WIDTH, FINE_HEIGHT = 180, 90

ITEMSET_SUPPORT = 0.001
RULE_CONFIDENCE = 0.12
CATEGORY_SUPPORT = 0.01
CATEGORY_CONFIDENCE = 0.8
PAGE_SUPPORT = 0.001
PAGE_CONFIDENCE = 0.04
TOP_RULES = 10
# how long after its window a view of a stream may still arrive
LATE = "1 day"
# the sliding windows of visitors
WINDOW = "15 seconds"
SEQUENCE_SUPPORT = 0.25
SIMILARITY = 0.03
# what a user would ask for; the one above lets the comparison see many pairs
CLOSE = 0.3
PART_SUPPORT = 0.0005
TOP_SIMILAR = 10

RANK = 10
# rank at which SQL can solve the normal equations, and their regularization
FOLD_RANK, FOLD_LAMBDA = 2, 0.01
# orders before this make the first version of a dictionary
FIRST_VERSION = "1998-01-01"
# ranks of learned bins are off by at most rows / ACCURACY
ACCURACY = 100_000
TOP_N = 10

# a fixed, lopsided model, so that no two paths have the same probability by symmetry
_weights = [[3, 5, 7, 2, 4, 6, 9, 8, 1], [5, 4, 3, 8, 7, 6, 2, 3, 4], [2, 3, 11, 1, 4, 9, 1, 2, 6]]
MODEL = HiddenMarkov(
    (0.35, 0.4, 0.25),
    ((0.61, 0.27, 0.12), (0.19, 0.57, 0.24), (0.09, 0.28, 0.63)),
    tuple(tuple(w / sum(row) for w in row) for row in _weights),
)
assert len(MODEL.emit) == len(HIDDEN) and len(MODEL.emit[0]) == len(OBSERVABLE)


def log(p: float) -> float:
    return math.log(p)
