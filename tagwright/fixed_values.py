"""Values that results depend on."""

# They must stay as they are for results to agree.
HASH_SLOTS = 20000
SMOOTHING = 1.0
TRAIN_SHARE = 0.7
BASELINE_ACCURACY = 0.6023699978752843
ABSENT = "NA"
TRIGGER = "10 seconds"
REFRESH_SECONDS = 3600
POST_TOPIC = "posts"
TAGGED_TOPIC = "tagged_posts"
WHITESPACE = " \t\n\x0b\f\r"

# Limit of what is sent to every executor. Larger tables are joined by shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024
# Limit of a hashed model, which driver and executors hold whole.
MODEL_BYTES = 256 * 1024 * 1024
