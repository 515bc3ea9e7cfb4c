"""tagpulse: hashtag summaries, lexicon sentiment and positive-run intervals on Spark.

Every operator is a DataFrame / Column expression evaluated by Catalyst; no
Python UDF runs on the data path.
"""

__version__ = "0.1.0"
