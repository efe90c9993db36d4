"""Fixed values that decide results: sentinels, thresholds, grids, languages."""

import string

# What an empty field becomes. They count as ordinary tokens.
EMPTY_LOCATION = "empty_location"
EMPTY_HASHTAG = "empty_hashtag"
EMPTY_MENTION = "empty_mention"
EMPTY_TERM = "empty_tweet"
LOCATION_PREFIX = "loc_"

# ASCII classes used by the byte-wise cleaning rules.
PUNCTUATION = string.punctuation
ASCII_UPPER = string.ascii_uppercase
ASCII_LOWER = string.ascii_lowercase

# Raw lines of at most this many characters are broken posts.
MIN_LINE_LENGTH = 1000

# Fixed values: `created_at` after its weekday, e.g. "Mar 05 07:08:09 +0000 2019".
CREATED_AT_PATTERN = "MMM d HH:mm:ss Z yyyy"

# Block name -> column it is tokenised from, in assembly order.
BLOCKS = {
    "term": "term",
    "hashtag": "hashtag",
    "mention": "mention",
    "user": "from_user",
    "loc": "location",
}

# Least number of posts a token must occur in, per block.
MIN_DF = {"term": 50, "hashtag": 159, "mention": 159, "user": 159, "loc": 50}

# Default vocabulary cap of pyspark.ml's CountVectorizer.
VOCAB_SIZE = 1 << 18

# Shares of the topic's hashtags (by birthday) that close the
# train and the valid period.
TRAIN_SHARE = 0.75
VALID_SHARE = 0.85

# Sampling fraction per label.
TRAIN_FRACTIONS = {0.0: 0.001, 1.0: 1.0}
VALID_FRACTIONS = {0.0: 0.0001, 1.0: 1.0}

# Columns whose equality makes two test posts the same.
DEDUP_BLOCKS = ["term", "hashtag", "mention", "user"]

# Tuning grid and number of folds.
GRID_NUM_TOP_FEATURES = [100, 1000, 10000, 100000]
GRID_REG_PARAM = [0.01, 0.1, 1.0, 10.0]
GRID_MAX_ITER = [2, 20, 100, 200, 500]
NUM_FOLDS = 5

# Languages the second-level filter tells apart.
LANGUAGES = ["de", "fr", "it", "en", "zh", "ar", "ja", "ko", "es", "ms", "tr", "hi", "bn", "pa"]
