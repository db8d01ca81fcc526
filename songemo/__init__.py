"""songemo: a Spark-native song-emotion analytics engine.

Frames and annotations in, mood-tagged and ranked songs out, all as Spark
DataFrame / Spark ML jobs.
"""

__version__ = "0.1.0"
