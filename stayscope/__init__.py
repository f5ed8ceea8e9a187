"""stayscope — cohort and outcome analytics on Spark.

Subject / episode / stay / measurement star schemas go in; first-stay cohorts,
time-windowed measurement features, imputation, class-weighted models, exact
ranking metrics, tree explanations and grouped reporting tables come out.
Every operator is a DataFrame plan; column names are passed by the caller.
"""

__version__ = "0.1.0"
