"""Fixed values that must equal the reference's for the same results."""

# Neighbourhood sizes, ALS settings, error bands, output header.
ITEM_NEIGHBOURS = 10          # item-based CF keeps the 10 most similar items
USER_NEIGHBOURS = 1           # user-based CF keeps the single most similar rater
ALS_RANK = 5
ALS_ITERATIONS = 4
ALS_LAMBDA = 0.01             # the default of the RDD-based ALS.train the reference calls
ERROR_BANDS = [               # half-open [lo, hi); the last band is [4, infinity)
    ("band_0_1", 0.0, 1.0),
    ("band_1_2", 1.0, 2.0),
    ("band_2_3", 2.0, 3.0),
    ("band_3_4", 3.0, 4.0),
    ("band_4_up", 4.0, None),
]
PREDICTION_HEADER = ["UserId", "MovieId", "Pred_rating"]
