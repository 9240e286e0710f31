"""Fixed values that results depend on."""

# Numerics.
LOGIT_CLIP = 500.0
PROBABILITY_EPS = 1e-15
DOUBLE_EPS = 2.0**-52
LEAKY_SLOPE = 0.01

# Update rules.
MOMENTUM = 0.9
RMSPROP_DECAY = 0.9
ADAM_BETA1 = 0.9
ADAM_BETA2 = 0.999
OPTIMIZER_EPS = 1e-8

# Learning-rate schedules.
STEP_EVERY = 10
STEP_FACTOR = 0.5

# Starting points and batches.
START_SCALE = 0.01
SMALL_BATCH = 32

# Stored models.
MODEL_SCHEMA_VERSION = 1

# Sizes of this implementation. They steer plans, not results; only MAX_CLASSES also refuses fits.
MAX_CLASSES = 100_000  # labels that a fit takes, and up to which class tables are broadcast
SQL_WIDTH = 32  # features kept as separate columns up to this width
COMPILED_WIDTH = 128  # array features scored as one compiled sum up to this width
SQL_PARAMETERS = 64  # gradients are compiled SQL sums up to this many parameters and ...
SQL_UNITS = 8  # ... outputs; longer generated code is no longer optimised by the JVM
GRAM_SQL_WIDTH = 10  # Gram sums written as SQL expressions up to this many features
BUCKET_ROWS = 100_000  # rows aimed at per bucket of an ordered pass, while ...
MAX_BUCKETS = 20_000  # ... there are at most this many buckets
SAMPLES_PER_BUCKET = 50  # sampled values per bucket that place the bucket bounds
BROADCAST_ROWS = 1_000_000  # bucket offsets are broadcast up to this many rows
LEAF_ROWS = 200_000  # an order-statistic search sorts about this many rows per target at most
HISTOGRAM_BITS = 10  # each search pass narrows the key range by this many bits
