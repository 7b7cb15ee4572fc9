"""Values that other systems rely on. All of them are fixed; none is tuned here."""

# Shop names that prefix titles, in removal order.
SHOP_WORDS = ["ah", "plus", "jumbo", "aldi"]

# Words that carry no product meaning.
STOP_WORDS = ["van", "de", "het", "een", "met", "voor"]

# Substrings that mark reduced-sugar and organic products.
DIET_WORDS = ["zero", "light", "diet", "sugarfree"]
BIO_WORDS = ["biologisch", "bio", "organic"]

# Accepted pair labels (English and Dutch) and the score stored for each class.
LABEL_SYNONYMS = {
    "identical": "identical",
    "identiek": "identical",
    "similar": "similar",
    "vergelijkbaar": "similar",
    "alternative": "alternative",
    "alternatief": "alternative",
}
LABEL_SCORES = {"identical": 0.95, "similar": 0.75, "alternative": 0.55}

# Line grammar of a pair answer; start of an answer in a run log, and the word of a line that follows one.
PAIR_PATTERN = r"(?U)\[?(\d+)\]?\s*=\s*\[?(\d+)\]?\s*\((\w+)\)"
LOG_MARK, LOG_HEAD, LOG_LEVEL = "LLM response (", r"^\d+ chars\): ", "INFO"

# Rule score weights and class thresholds.
WEIGHT_BRAND, WEIGHT_TERMS, WEIGHT_SIZE, WEIGHT_FEATURES = 0.4, 0.3, 0.2, 0.1
IDENTICAL_BRAND, IDENTICAL_SCORE, IDENTICAL_SIZE = 0.95, 0.7, 0.9
SIMILAR_BRAND, SIMILAR_SCORE, SIMILAR_SCORE_ALONE = 0.8, 0.6, 0.8
ALTERNATIVE_SCORE, ALTERNATIVE_TERMS = 0.5, 0.3

# Title-overlap thresholds used to label evaluation pairs.
EXPECTED_IDENTICAL, EXPECTED_SIMILAR, EXPECTED_ALTERNATIVE = 0.6, 0.3, 0.25
EVALUATION_PER_SHOP, EVALUATION_MIN_PAIRS, EVALUATION_FILL, EVALUATION_MAX_PAIRS = 4, 5, 10, 15
EVALUATION_MIN_PRODUCTS = 5

# Stage scores and thresholds of the staged matcher.
EXACT_CONFIDENCE, NEIGHBOURS, NEIGHBOUR_THRESHOLD = 0.98, 10, 0.75
CLUSTERING_SIZE = 50

# Batch sizes for pair prompts and label prompts.
PAIR_BATCH, PAIR_BATCH_RUN, LABEL_BATCH, LABEL_BATCH_MANUAL = 15, 10, 15, 25

# Label confidence rules.
LABEL_BASE_CONFIDENCE, LABEL_UNKNOWN_CONFIDENCE, LABEL_MIN_CONFIDENCE = 0.95, 0.3, 0.1
LEAKED_BRANDS = ["nivea", "dove", "ah", "jumbo"]
LEAKED_UNITS = ["ml", "kg", "gram", "pack"]
MAX_LABEL_WORDS = 4

# Confidence bands that decide what happens to a match.
ACTION_APPROVE, ACTION_LOG, ACTION_REVIEW = 0.95, 0.85, 0.70

# Unit -> (base unit, factor) for quantity normalisation.
UNIT_BASE = {
    "l": ("ml", 1000.0),
    "cl": ("ml", 10.0),
    "dl": ("ml", 100.0),
    "ml": ("ml", 1.0),
    "kg": ("g", 1000.0),
    "g": ("g", 1.0),
}

# Columns an uploaded catalogue must have.
REQUIRED_COLUMNS = ["main_category", "normalized_quantity_unit", "title", "shop_type"]
