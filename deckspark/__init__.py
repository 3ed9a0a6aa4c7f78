"""deckspark: vocabulary and flashcard-deck operators on Spark DataFrames."""

__version__ = "0.1.0"
