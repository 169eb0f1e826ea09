"""Default parameters of the library.

Fixed values: these equal the reference's defaults and constants, so that a
call without arguments behaves like the reference did.
"""

# prepare stage
NUM_FOLDS = 5            # folds written by the preparation step
MIN_SUPPORT = 5          # a name is kept when it has more than this many reviews
HISTOGRAM_BINS = 10      # equal-width bins of the rating histogram

# explore stage
TOP_SIMILAR = 15         # closest items / categories shown per probe

# gradient-descent trainer
GD_GAIN = 0.001
GD_POWER = 0.2
GD_EPSILON = 1e-99
GD_LAM = 1.0
GD_MU = 1.0
GD_D = 10
GD_MAXITER = 20
GD_SEED = 1234567

# alternating least squares
ALS_REG = 1.0
ALS_RANK = 10
ALS_MAXITER = 20
