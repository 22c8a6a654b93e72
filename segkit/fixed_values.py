"""Fixed values.

These must equal the reference's values for the same results; they are stated
here once, plainly, and imported by the modules that use them.
"""

# Buyer table: required columns, in table order.
REQUIRED_COLUMNS = ["client_id", "cohort_label", "client_type", "gender", "country", "region",
                    "date_of_birth", "acquisition_purpose", "loan_applied", "referral_channel",
                    "satisfaction_score"]

# Cleaning.
DEDUP_KEYS = ["client_id", "date_of_birth"]
GENDER_RULE_TYPE = "Corporate"            # null gender of this client type ...
GENDER_RULE_VALUE = "Not Applicable"      # ... becomes this value
GENDER_MODE_TYPE = "Individual"           # null gender of this type takes the mode within the type
MODE_COLUMNS = ["region", "referral_channel", "acquisition_purpose", "loan_applied"]
REFERENCE_DATE = "2024-01-01"             # ages are whole years at this date
DAYS_PER_YEAR = 365.25

# Features.
NUMERIC_FEATURES = ["age", "satisfaction_score"]
CATEGORICAL_FEATURES = ["client_type", "acquisition_purpose", "loan_applied", "gender", "country", "region",
                        "referral_channel"]

# Model choice and training.
K_RANGE = range(2, 9)
DEFAULT_K = 4
AMBIGUITY_GAP = 0.02
SWEEP_RESTARTS = 10
SWEEP_MAX_ITER = 300
FINAL_RESTARTS = 20
FINAL_MAX_ITER = 500
RANDOM_SEED = 42

# Dashboard panels.
TOP_N = 10
SAMPLE_ROWS = 1500
SCORE_THRESHOLD = 3.5
AGE_SCALE = (20, 75)                      # radar: (age - 20) / 55
SCORE_SCALE = (0, 5)                      # radar: score / 5
HISTOGRAM_BINS = 5
