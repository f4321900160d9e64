"""Default parameters of the train and score plans.

Fixed values: a run with no arguments must mean the same thing everywhere.
"""

TEST_FRACTION = 0.2
SPLIT_SEED = 7
FP_RADIUS = 2
FP_BITS = 2048
MODEL_KIND = "dummy"
MIN_SAMPLES = 1000
MARGIN = 0.5
N_BOOT = 1000
GATE_SEED = 7
SHORTLIST_SIZE = 100
RANK_ASCENDING = True
CHAMPION_ALIAS = "champion"
POLL_SECONDS = 10
