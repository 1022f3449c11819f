"""labelfold: Spark-native data work around multi-label text classification.

Corpus building and statistics, class weights, batch and streaming scoring,
multi-label evaluation, error analysis and run-log analysis, all expressed as
DataFrame plans.
"""

__version__ = "0.1.0"
